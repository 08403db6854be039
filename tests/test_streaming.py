import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assayline.operators import latest
from assayline.sources import ledger, tables
from assayline.sources.files import SOURCES
from assayline.streaming import jobs
from tests import fixture_files


def test_only_new_files_are_ingested(spark, tmp_path):
    src, out, mark = f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/mark"
    first = dict(list(fixture_files.CUSTOMERS.items())[:2])
    for name, content in first.items():
        Path(src, name).parent.mkdir(parents=True, exist_ok=True)
        Path(src, name).write_text(content)
    jobs.bronze(spark, SOURCES["customers"], src, out, mark, files_per_batch=1).awaitTermination()
    assert jobs.read_bronze(spark, out, mark).count() == 7
    fixture_files.write(src)
    jobs.bronze(spark, SOURCES["customers"], src, out, mark).awaitTermination()
    df = jobs.read_bronze(spark, out, mark)
    assert df.count() == 10 and {"CustomerID", "cust_id", "Edu"} <= set(df.columns)
    assert df.filter("_rescued_data is not null").count() == 1
    jobs.bronze(spark, SOURCES["customers"], src, out, mark).awaitTermination()
    assert jobs.read_bronze(spark, out, mark).count() == 10


def test_json_files_are_followed(spark, tmp_path):
    src = f"{tmp_path}/raw"
    Path(src).mkdir()
    Path(src, "claims_9.json").write_text(json.dumps([fixture_files.claim(ClaimID=i) for i in range(5)]))
    jobs.bronze(spark, SOURCES["claims"], src, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    assert jobs.read_bronze(spark, f"{tmp_path}/out", f"{tmp_path}/mark").count() == 5


def test_stream_keeps_one_row_per_key_across_runs(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("src", "out", "mark"))
    df = spark.createDataFrame([(i % 3, i) for i in range(9)], "k int, v int").coalesce(1)
    df.write.mode("append").parquet(src)
    jobs.run(latest.keep_any(jobs.stream_of(spark, src), ["k"]), out, mark)
    df.union(spark.createDataFrame([(7, 7)], "k int, v int")).write.mode("append").parquet(src)
    jobs.run(latest.keep_any(jobs.stream_of(spark, src), ["k"]), out, mark)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 7]


def test_bounded_state_form(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("src", "out", "mark"))
    df = spark.createDataFrame([(1, 5), (1, 6), (2, 5)], "k int, s int").select(
        "k", F.timestamp_seconds("s").alias("t"))
    df.coalesce(1).write.parquet(src)
    jobs.run(latest.keep_any_within(jobs.stream_of(spark, src), ["k"], "t", "1 hour"), out, mark)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_counts_grow_with_the_stream(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("src", "out", "mark"))
    row = spark.createDataFrame([("/r/Insurance 1/a.csv", "Insurance 1")] * 4, "_source_file string, _source_region string"
                                ).withColumn("_ingest_time", F.lit("2024-01-01").cast("timestamp"))
    for n in (4, 8):
        row.coalesce(1).write.mode("append").parquet(src)
        jobs.run_changes(jobs.file_counts(jobs.stream_of(spark, src), "x"), out, mark)
        got = tables.read_newest(spark, out, ["_source_file"]).collect()
        assert [(r["file_name"], r["row_count"]) for r in got] == [("a.csv", n)]


def test_changes_only_are_written_and_folded(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("src", "out", "mark"))
    keys = ["k"]
    for n, rows in enumerate(([(1, 5), (2, 5)], [(1, 7)], [(3, 1)], [(1, 1)])):
        spark.createDataFrame(rows, "k int, v int").coalesce(1).write.mode("append").parquet(src)
        counts = jobs.stream_of(spark, src).groupBy("k").agg(F.sum("v").alias("total"))
        jobs.run_changes(counts, out, mark, fold_every=3, keys=keys)
        got = {r["k"]: r["total"] for r in tables.read_newest(spark, out, keys).collect()}
        assert got == [{1: 5, 2: 5}, {1: 12, 2: 5}, {1: 12, 2: 5, 3: 1}, {1: 13, 2: 5, 3: 1}][n]
    parts = ledger.committed(spark, out)
    assert [p.rsplit("=")[1] for _, p in parts] == ["folded-2", "batch-3"]
    assert spark.read.parquet(parts[1][1]).count() == 1


def test_an_append_that_is_tried_again_leaves_one_copy(spark, tmp_path):
    out = f"{tmp_path}/out"
    for run, rows in (("day 1/a", [(1, None)]), ("day 1/a", [(1, None)]), ("day 2", [(2, "x")]), ("day 1/a", [(1, None)])):
        tables.append_once(spark.createDataFrame(rows, "a int, b string"), out, run)
    tables.append_once(spark.range(1).select(F.col("id").cast("int").alias("a"), F.lit(True).alias("c")), out, "day 3")
    got = sorted(map(tuple, tables.read_committed(spark, out, "v").collect()))
    assert got == [(0, None, 2, True), (1, None, 0, None), (2, "x", 1, None)] or sorted(
        (r["a"], r["b"], r["c"], r["v"]) for r in tables.read_committed(spark, out, "v").collect()) == [
        (0, None, True, 2), (1, None, None, 0), (2, "x", None, 1)]


def test_rows_of_a_run_without_an_entry_do_not_count(spark, tmp_path):
    out = f"{tmp_path}/out"
    tables.append_once(spark.range(3), out, "a")
    spark.range(5).write.parquet(f"{out}/parts/run=crashed")  # written, but the entry was not
    assert tables.read_committed(spark, out).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_committed(spark, f"{tmp_path}/none")


def test_newest_row_does_not_depend_on_arrival(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice(["a", "ab", "b", "ä", None]), rng.choice([None, 1, 2, 3]),
             rng.choice([None, "x", "y"])) for _ in range(120)]
    schema = "k int, _source_file string, t int, v string"
    df = spark.createDataFrame(rows, schema).withColumn("_ingest_time", F.timestamp_seconds("t")).drop("t")
    want = sorted(map(repr, latest.keep_latest(df, "k", keep_null_keys=False).select("k", "v", "_source_file", "_ingest_time").collect()))
    halves = [df.filter("hash(v, _source_file) % 2 = 0"), df.filter("not coalesce(hash(v, _source_file) % 2 = 0, false)")]
    for turn, order in enumerate((halves, halves[::-1])):
        src, out, mark = (f"{tmp_path}/{n}{turn}" for n in ("src", "out", "mark"))
        for half in order:
            half.coalesce(1).write.mode("append").parquet(src)
            jobs.run_changes(jobs.newest(jobs.stream_of(spark, src), "k"), out, mark)
        got = tables.read_newest(spark, out, ["k"]).select("k", "v", "_source_file", "_ingest_time")
        assert sorted(map(repr, got.collect())) == want
