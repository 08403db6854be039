import math
import random
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from assayline.operators import enrich, latest, lookup, report, rules
from assayline.operators.quantiles import exact_quantiles
from assayline.operators.similar import cosine_top_k

SCHEMA = "k int, v int, w string, _source_file string, _ingest_time timestamp"


def rows_with_hot_key(n=3000):
    """A third of the rows share a key and a third of those are copies of one row."""
    rng = random.Random(1)
    rows = []
    for i in range(n):
        key = 7 if i % 3 == 0 else (None if i % 50 == 1 else rng.randrange(400))
        if i % 9 == 0:
            rows.append((7, 1, "copy", "f9", datetime(2024, 1, 9)))
        else:
            rows.append((key, rng.randrange(5), rng.choice("ab") if i % 4 else None,
                         f"f{rng.randrange(3)}", datetime(2024, 1, 1 + rng.randrange(3))))
    return rows


def order_of(r):
    """Sort key that puts the survivor first."""
    k, v, w, f, t = r
    return (-t.timestamp(), tuple(-ord(c) for c in f), v, (w is not None, w or ""))


def test_latest_against_brute_force(spark):
    rows = rows_with_hot_key()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    best = {}
    for r in rows:
        if r[0] is not None and (r[0] not in best or order_of(r) < order_of(best[r[0]])):
            best[r[0]] = r
    want = Counter(best.values()) + Counter(r for r in rows if r[0] is None)
    for salts in (2, 16):
        marked = [tuple(r) for r in latest.mark_latest(df, "k", salts=salts).collect()]
        assert Counter(r[:-1] for r in marked) == Counter(rows)
        assert Counter(r[:-1] for r in marked if r[-1]) == want
    kept, replaced = latest.split_latest(df, "k")
    assert kept.count() + replaced.count() == len(rows)
    assert {r[0] for r in replaced.select("quarantine_reason").distinct().collect()} == {"duplicate k"}
    assert Counter(tuple(r) for r in latest.keep_latest(df, "k").collect()) == want
    only = latest.keep_latest(df, "k", keep_null_keys=False)
    assert Counter(tuple(r) for r in only.collect()) == Counter(best.values())


def test_latest_with_one_exchange_unless_a_key_is_hot(spark):
    rows = rows_with_hot_key()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)

    def exchanges(marked):
        plan = marked._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    cold, hot = latest.mark_latest(df, "k"), latest.mark_latest(df, "k", share=10, hot_rows=100)
    assert exchanges(cold) == 1 and exchanges(hot) == 3
    plan = hot._jdf.queryExecution().optimizedPlan().toString()
    assert "(k#" in plan and "= 7)" in plan  # the rows of key 7 alone go through two rounds
    want = Counter(tuple(r) for r in cold.collect())
    assert want == Counter(tuple(r) for r in hot.collect())
    assert want == Counter(tuple(r) for r in latest.mark_latest(df, "k", share=1000, hot_rows=0).collect())
    assert sum(n for r, n in want.items() if r[0] == 7 and r[-1]) == 1


def test_wide_selects_are_compiled_in_pieces(spark):
    from assayline.plans import silver
    from assayline.session import wide_selects
    limit = "spark.sql.codegen.hugeMethodLimit"
    other = spark.newSession()
    other.conf.set(limit, "65535")
    raw = other.createDataFrame([("1", "f", datetime(2024, 1, 1))], "customer_id string, _source_file string, _ingest_time timestamp")
    silver.ENTITIES["customers"].tagged(raw)
    assert other.conf.get(limit) == "8000"
    other.conf.set(limit, "4000")
    wide_selects(other)
    assert other.conf.get(limit) == "4000"


def test_hot_key_is_spread(spark):
    df = spark.createDataFrame([(1, i, "x", "f", datetime(2024, 1, 1)) for i in range(4000)],
                               SCHEMA).repartition(8)
    salted = df.withColumn("s", F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(8)))
    sizes = [r["count"] for r in salted.groupBy("s").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 4


def test_survivors_are_pruned_before_the_shuffle(spark):
    df = spark.createDataFrame(rows_with_hot_key(50), SCHEMA)
    plan = latest.keep_latest(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
@pytest.mark.parametrize("kind", ["int", "string"])
@pytest.mark.parametrize("split", [False, True])
def test_lookup_equals_left_join(spark, broadcast, kind, split):
    keys = [5] * 700 + [None] * 500 + [999] * 400 + list(range(300)) * 2
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k int")
    dim = spark.createDataFrame([(k, f"d{k}", None if k % 2 else k) for k in range(250)],
                                "dk int, name string, n int")
    fact = fact.withColumn("k", F.col("k").cast(kind))
    dim = dim.withColumn("dk", F.col("dk").cast(kind))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = lookup.lookup(fact, dim, "k", "dk", share=50, split_hot=split)
        want = fact.join(dim, F.col("k") == F.col("dk"), "left").select("i", "k", "name", "n")
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lookup_plans_each_side_once(spark):
    fact = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"))
    dim = spark.range(50).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("n"))
    plan = lookup.lookup(fact, dim, "k", "dk")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 2
    # rows without a key go to as many tasks as the salts allow
    empty = fact.withColumn("k", F.lit(None).cast("bigint"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = lookup.lookup(empty, dim, "k", "dk").withColumn("t", F.spark_partition_id()).groupBy("t").count().collect()
        assert len(got) > 1 and sum(r["count"] for r in got) == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_duplicate_count(spark):
    rows = [("a", 1), ("a", 1), ("a", 2), ("a", None), (None, 3), (None, 3), ("b", None)]
    got = report.duplicate_count(spark.createDataFrame(rows, "g string, k int"), "g", "k").collect()
    assert sorted(map(tuple, got), key=repr) == [("a", 2, 3, 1), ("b", 0, 0, 0), (None, 1, 2, 1)]


def test_spread(spark):
    from assayline.sources.tables import spread
    one, many = spark.range(100).coalesce(1), spark.range(100).repartition(64)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many).rdd.getNumPartitions() == 64 and spread(one).count() == 100


def test_hot_keys_are_few(spark):
    fact = spark.createDataFrame([(k,) for k in [1] * 50 + list(range(100, 150))], "k int")
    assert [r[0] for r in lookup.hot_keys(fact, "k", share=10).collect()] == [1]


def test_quantiles_against_brute_force(spark):
    rng = random.Random(2)
    data = [(round(rng.uniform(-500, 90000), 2), rng.choice([0, 1, 2, None]), i % 7)
            for i in range(1000)] + [(12.5, None, 3)] * 500
    df = spark.createDataFrame(data, "a double, b int, c int")
    wanted = {"a95": ("a", 0.95), "a5": ("a", 0.05), "a0": ("a", 0.0), "a100": ("a", 1.0),
              "b50": ("b", 0.5), "c99": ("c", 0.99), "c20": ("c", 0.2)}
    got = exact_quantiles(df, wanted).collect()[0]
    for name, (c, p) in wanted.items():
        xs = sorted(r["abc".index(c)] for r in data if r["abc".index(c)] is not None)
        rank = max(1, -(-int(p * 100) * len(xs) // 100))
        assert got[name] == pytest.approx(xs[rank - 1]), name
    empty = exact_quantiles(df.filter("a > 1e9"), {"m": ("a", 0.5)}).collect()
    assert [tuple(r) for r in empty] == [(None,)]


@pytest.mark.parametrize("per_pass", [1024, 3])
def test_cosine_against_numpy(spark, per_pass):
    rng = np.random.default_rng(3)
    docs = rng.normal(size=(200, 8))
    docs[50:120] = docs[10]  # copies: the smallest ids must win
    docs[130] = 0
    questions = np.vstack([rng.normal(size=(6, 8)), docs[10:11]])
    d = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(docs)],
                              "doc_id long, vector array<double>").repartition(5)
    q = spark.createDataFrame([(f"q{i}", x.tolist()) for i, x in enumerate(questions)],
                              "query_id string, vector array<double>")
    got = cosine_top_k(q, d, 4, per_pass=per_pass).collect()
    assert len(got) == 28
    norm = np.where(np.linalg.norm(docs, axis=1) == 0, 1, np.linalg.norm(docs, axis=1))
    for i, x in enumerate(questions):
        scores = np.round(docs @ x / norm / np.linalg.norm(x), 9)
        want = sorted(range(200), key=lambda j: (-scores[j], j))[:4]
        have = sorted((r for r in got if r["query_id"] == f"q{i}"), key=lambda r: r["position"])
        assert [r["doc_id"] for r in have] == want
        assert [r["position"] for r in have] == [1, 2, 3, 4]


def test_no_query_gives_no_hit(spark):
    d = spark.createDataFrame([(1, [1.0])], "doc_id long, vector array<double>")
    q = spark.createDataFrame([], "query_id int, vector array<double>")
    assert cosine_top_k(q, d).count() == 0


def test_first_match_and_default(spark):
    df = spark.createDataFrame([(1, None), (None, 5), (3, -1), (3, 1)], "a int, b int")
    got = rules.tag_reason(df, [("a is null", "no a"), ("b < 0", "negative b"), ("b is null", "no b")])
    assert [r["quarantine_reason"] for r in got.collect()] == ["no b", "no a", "negative b", "unknown"]


def test_every_row_lands_on_one_side(spark):
    rows = rows_with_hot_key(600)
    df = spark.createDataFrame(rows, SCHEMA)
    tagged = rules.tag(df, "k", [rules.Rule("no k", F.col("k").isNull()), rules.Rule("v", "v = 2")],
                       F.col("w").isNull())
    ok, bad = rules.passed(tagged), rules.rejected(tagged)
    assert ok.count() + bad.count() == 600
    assert ok.count() == ok.select("k").distinct().count()
    assert bad.filter("quarantine_reason = 'no k'").count() == sum(r[0] is None for r in rows)
    assert bad.filter("quarantine_reason = 'duplicate k' and quarantine_type <> 'drop'").count() == 0
    assert bad.filter("quarantine_type is null").count() == 0
    assert ok.columns == df.columns and bad.columns[-1] == "quarantine_timestamp"


def test_expectations(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (2, None)], "a int, b int")
    seen = Observation("seen")
    got = rules.expect(df, warn={"b_large": "b > 6"}, drop={"a_set": "a is not null"}, observation=seen)
    assert got.count() == 2
    assert seen.get == {"b_large": 3, "a_set": 1}
    counts = rules.expectation_counts(df, warn={"b_set": "b > 0"}, drop={"a_set": "a > 0"}).collect()
    assert [tuple(r) for r in counts] == [("b_set", "warn", 2, 1), ("a_set", "drop", 2, 1)]


def test_union_of_unlike_tables(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    got = rules.union_all([a, b], allow_missing=True)
    assert sorted(map(repr, map(tuple, got.collect()))) == ["(1, None)", "(None, 2)"]


def test_generator_errors_stay_in_their_row(spark):
    def generate(p):
        if p == "bad":
            raise ValueError("no answer")
        return p.upper()
    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "p string")
    got = enrich.with_text(df, "p", "out", generate, "m", tasks=2).collect()
    assert sorted((r["p"], r["out"], r["model_name"], r["generation_status"]) for r in got) == [
        ("a", "A", "m", "success"), ("bad", "[ERROR: no answer]", "m", "error"),
        ("c", "C", "m", "success")]


def test_severity_bands_and_extremes(spark):
    df = spark.createDataFrame([(1001, "b"), (1000, "a"), (101, "c"), (100, "d"), (None, "e")], "n int, s string")
    assert [r[0] for r in df.select(report.severity_band("n")).collect()] == [
        "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert report.extreme(df, "n", ("s",)).collect()[0]["s"] == "b"
    assert report.extreme(df, "n", ("s",), largest=False).collect()[0]["s"] == "d"
    assert [r["s"] for r in report.top(df, "n", ("s",), 2).collect()] == ["b", "a"]


def test_missing_table_is_reported(spark):
    spark.createDataFrame([(1,), (2,)], "x int").createOrReplaceTempView("here")
    got = report.table_counts(spark, ["here", "not_here"]).collect()
    assert [tuple(r) for r in got] == [("here", True, 2), ("not_here", False, None)]


def test_keep_latest_keeps_rows_without_a_key(spark):
    from datetime import datetime as dt
    rows = [(None, 1, "a", "f", dt(2024, 1, 1)), (None, 2, "b", "f", dt(2024, 1, 2)),
            (7, 3, "c", "f", dt(2024, 1, 1)), (7, 4, "d", "f", dt(2024, 1, 2))]
    got = latest.keep_latest(spark.createDataFrame(rows, SCHEMA), "k", keep_null_keys=True)
    assert sorted(r.v for r in got.collect()) == [1, 2, 4] and got.columns == SCHEMA_NAMES


SCHEMA_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def test_damaged_vectors_displace_no_documents(spark):
    nan = float("nan")
    docs = [(k, [1.0, float(k)]) for k in range(4)] + [(10, [nan, 1.0]), (11, [1.0, None]), (12, [float("inf"), 1.0])]
    d = spark.createDataFrame(docs, "doc_id int, v array<double>").coalesce(1)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, v array<double>")
    got = cosine_top_k(q, d, 4, query_id="query_id", query_vector="v", doc_id="doc_id", doc_vector="v").collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 2, 3]


def test_vectors_of_other_lengths_are_no_candidates(spark):
    docs = [(k, [1.0, float(k)]) for k in range(3)] + [(20, [1.0]), (21, [1.0, 0.0, 0.0]), (22, []), (23, None)]
    d = spark.createDataFrame(docs, "doc_id int, vector array<double>").repartition(3)
    q = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [2.0]), ("c", None), ("d", [float("nan")])], "query_id string, vector array<double>")
    got = {(r.query_id, r.doc_id) for r in cosine_top_k(q, d, 5).collect()}
    assert got == {("a", 0), ("a", 1), ("a", 2), ("b", 20)}


def test_more_queries_than_a_block_or_a_task_holds(spark, monkeypatch):
    from assayline.operators import similar
    monkeypatch.setattr(similar, "HELD_QUERIES", 7)
    rng = random.Random(3)
    docs = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(150)]
    queries = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(60)]
    d = spark.createDataFrame(docs, "doc_id int, vector array<double>").repartition(5)
    q = spark.createDataFrame(queries, "query_id int, vector array<double>").repartition(4)
    plan = cosine_top_k(q, d, 4, per_pass=4)

    def cosine(a, b):
        return round(sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b)), 9)
    want = {}
    for i, a in queries:
        best = sorted(((-cosine(a, b), j) for j, b in docs))[:4]
        want.update({(i, n + 1): (j, -s) for n, (s, j) in enumerate(best)})
    got = {(r.query_id, r.position): (r.doc_id, r.confidence) for r in plan.collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-8 for k in want)


def test_outcomes_that_do_not_add_up_are_an_error():
    seen = {"records": 5, "passed": 2, "drop_0": 1, "quarantine_0": 2}
    got = rules.outcome_of("t", ["r"], seen)
    assert got.rejected == {("r", "drop"): 1, ("r", "quarantine"): 2} and got.records == 5
    with pytest.raises(ValueError):
        rules.outcome_of("t", ["r"], {**seen, "records": 6})
