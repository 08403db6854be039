"""Shingle join, vector links, components and registered queries against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from assayline.llm import quality, shingles, vectors
from assayline.llm.components import components
from assayline.llm.oracle import ORACLE
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


def smallest(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(spark, connect(SF), SF, name) == []


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (230, 2))] + [(k, k + 1) for k in range(1000, 1040)] + \
        [(2000, k) for k in range(2001, 2100)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    assert got == smallest({x for p in real for x in p}, real)


def near_texts():
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for g in range(12):
        base = list(rng.choice(words, int(rng.integers(3, 200))))
        for _ in range(int(rng.integers(1, 9))):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(len(own)))] = str(rng.choice(words))
            rows.append(" ".join(own))
    chain = list(rng.choice(words, 300))
    for k in range(12):
        rows.append(" ".join(chain[k * 6:k * 6 + 200]))
    passage = " ".join(rng.choice(words, 60))
    rows += [passage + " " + " ".join(rng.choice(words, 100)) for _ in range(15)]
    rows += ["a", "A", "a b", "a b c", "A  B\tc", "", " ", None, "a b c d", "a b c d e"]
    return rows


@pytest.mark.parametrize("width, percent, block, side", [(4, 85, 1500, 1 << 24), (5, 80, 6, 1 << 24), (5, 80, 3, 4000)])
def test_shingle_join(spark, monkeypatch, width, percent, block, side):
    monkeypatch.setattr(shingles, "SIDE", side)
    rows = list(enumerate(near_texts(), 7)) + [(3, "a b c"), (3, "a b c")]
    sets = defaultdict(set)
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    ids = list(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = smallest(ids, links)
    assert len(set(want.values())) < len(ids) - 20
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows] + [(None, "a b c", "x", 1)], "doc_id long, text string, hi string, rep int")
    out = shingles.similar_groups(df, width, percent, block).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == \
        Counter([(i, len(sets[i]), want[i]) for i, _ in rows] + [(None, 1, None)])
    assert shingles.similar_groups(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1500, 2])
def test_sets_with_the_same_smallest_id(spark, block):
    """Two sets of one cluster share an id; each has a link that the other has not."""
    words = [f"w{k}" for k in range(100)]
    change = lambda w, a, tag: [f"{tag}{k}" if a <= k < a + 10 else x for k, x in enumerate(w)]
    other = change(words, 0, "o")
    rows = [(1, words), (1, other), (2, change(other, 20, "b")), (3, change(words, 40, "c")), (1, ["alone"])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    out = shingles.similar_groups(df, 1, 80, block).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == Counter(
        {(1, 100, 1): 2, (2, 100, 1): 1, (3, 100, 1): 1, (1, 1, 1): 1})


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_sets_that_link_are_of_neighbouring_size_classes(spark, percent):
    sizes = spark.range(1, 20001).select(F.col("id").alias("n"), F.ceil(F.lit(percent) * F.col("id") / 100).alias("m"))
    step = shingles.size_class(F.col("n"), percent) - shingles.size_class(F.col("m"), percent)
    assert sizes.where(step > 1).isEmpty() and sizes.where(step < 0).isEmpty()


@pytest.mark.parametrize("side", [1 << 24, 900])
def test_every_pair_of_like_size_meets_once_at_least(spark, monkeypatch, side):
    """Sets apart from the main group meet all of their cluster whose size allows a link."""
    monkeypatch.setattr(shingles, "SIDE", side)
    rows = [(1 + i % 2, i, 0 if i % 5 == 0 else i, i % 5 > 0, bytes(8 * (3 + 7 * i % 60))) for i in range(120)]
    frame = spark.createDataFrame(rows, "cluster long, rep long, component long, apart boolean, elements binary")
    frame = frame.withColumn("class", shingles.size_class(F.length("elements") / 8, 80))
    dealt, cells = shingles.meetings(frame)
    met, most = set(), 0
    for key, own in dealt.toPandas().groupby([*shingles.CELL, "block", "turn"]):
        met |= {(int(a), int(b)) for a in own["rep"][own["apart"]] for b in own["rep"]}
        most = max(most, len(own))
    size = {r[1]: len(r[4]) for r in rows}
    want = {(a[1], b[1]) for a in rows if a[3] for b in rows if a[0] == b[0] and a[1] != b[1]
            and 100 * min(size[a[1]], size[b[1]]) >= 80 * max(size[a[1]], size[b[1]])}
    assert all(pair in met or pair[::-1] in met for pair in want) and len(want) > 500
    assert cells.where("blocks > 1 and turns > 1").isEmpty() == (side > 900)


def test_only_sets_without_a_link_go(spark):
    """Near the limit: a set with just enough elements that others have stays, one with fewer goes."""
    made = {1: range(100), 2: [*range(80), *range(1000, 1020)], 3: [*range(79), *range(2000, 2021)],
            4: range(3000, 3050), 5: [*range(40), *range(3000, 3040)], 6: [7]}
    rows = [(0, len(x), rep, np.array(sorted(x), np.uint64).tobytes()) for rep, x in made.items()]
    frame = spark.createDataFrame([*rows, rows[3]], "cluster long, size long, rep long, elements binary")
    kept, counts = shingles.that_may_link(frame, 80)
    assert Counter(r.rep for r in kept.collect()) == Counter({1: 1, 2: 1, 4: 2, 5: 1, 6: 1})
    assert {r.rep: r.alone for r in counts.collect()} == {1: 20, 2: 20, 3: 21, 4: 10}
    assert shingles.that_may_link(frame.limit(0), 80)[0].isEmpty()


@pytest.mark.parametrize("slices", [1, 7])
def test_lone_elements(spark, slices):
    """Elements of a set in no other set are counted once, in however many texts and slices the set occurs."""
    texts = [" ".join(f"w{k}" for k in r) for r in (range(50), range(20, 60), range(200, 220), [3, 300, 301])]
    rows = [texts[0], texts[1], texts[2], texts[2] + " ", texts[3], texts[0].upper(), "", None] * 2
    df = spark.createDataFrame([(t,) for t in rows], "text string").repartition(slices)
    got = {r.key: r.alone for r in shingles.alone_in(df, shingles.sets_in_texts(1)).collect()}
    keys = [shingles.digest(s)[0] for s in shingles.sets_of(pa.array(texts), 1)]
    assert got == dict(zip(keys, [19, 10, 20, 2]))
    assert shingles.alone_in(df.limit(0), shingles.sets_in_texts(1)).isEmpty()


def test_a_common_passage_ties_no_sets(spark, monkeypatch):
    """Texts that share a passage but cannot link are left out before any cluster is formed, so
    none of them is stored as a set of a large one."""
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(i, passage + " " + " ".join(f"d{i}x{k}" for k in range(25))) for i in range(60)]
    rows += [(100 + i, rows[0][1] + f" end{i}") for i in range(3)]
    sizes, stored = {}, shingles.stored

    def seen(df, name, *more):
        out = stored(df, name, *more)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(shingles, "stored", seen)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = shingles.similar_groups(df, 2, 80, 10).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: 0 if i >= 100 else i for i, _ in rows}
    assert sizes["jaccard-left"] <= 4 and "jaccard-sets" not in sizes


def test_near_copies_with_repeated_ids(spark):
    text = lambda tag, end="": " ".join(f"{tag}{k}" for k in range(100)) + end
    rows = [(7, text("p")), (7, text("q")), (3, text("p", " x")), (4, text("r")), (4, text("r", " y")), (5, text("r", " z")),
            (None, text("p")), (8, ""), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = Counter(tuple(r) for r in corpus_pipeline.no_near_copies(spark, df, SF).collect())
    first = out[4, text("r")]
    assert first + out[4, text("r", " y")] == 1
    assert out == Counter([rows[1], rows[2], rows[3 if first else 4], *rows[6:]])


def test_t_occurrence():
    rng = np.random.default_rng(4)
    for _ in range(200):
        lists = [sorted(set(rng.integers(0, 30, rng.integers(1, 20)).tolist())) for _ in range(rng.integers(1, 12))]
        need = int(rng.integers(1, len(lists) + 1))
        count = Counter(x for ids in lists for x in ids)
        assert dict(shingles.merge_skip(lists, need)) == {x: n for x, n in count.items() if n >= need}
        found = {i for i, n, rest in shingles.divide_skip(lists, need) if n + sum(i in ids for ids in rest) >= need}
        assert found == {x for x, n in count.items() if n >= need}


def vector_rows():
    rng = np.random.default_rng(8)
    rows = []
    for g in range(60):
        base = rng.standard_normal(16)
        for k in range(int(rng.integers(1, 8))):
            rows.append((base + rng.standard_normal(16) * 0.06, g % 3))
    rows += [(rows[0][0] * 2, 0), (rows[0][0], 0), (rows[0][0], 1), (-rows[0][0], 0), (np.zeros(16), 0), (np.ones(3), 0), (np.ones(3), 0)]
    out = [(k + 1, [float(x) for x in v], label) for k, (v, label) in enumerate(rows)]
    n = len(out)
    out += [(n + 1, None, 0), (n + 2, [1.0, float("nan")], 0), (n + 3, [None, 1.0], 0), (n + 4, out[0][1], None),
            (n + 5, [float("inf")], 0), (n + 6, [], 0), (n + 7, [1e-200, 0.0], 0), (n + 8, [2e-200, 0.0], 0)]
    return out


def exact_links(rows, cosine):
    good = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v)
            x = x / np.abs(x).max()
            good[i] = (label, x / np.linalg.norm(x))
    return [(a, b) for a in good for b in good if a < b and good[a][0] == good[b][0]
            and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= cosine]


def test_vector_links(spark, monkeypatch):
    rows = vector_rows()
    links = exact_links(rows, 0.98)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, rep string")
    want, number = smallest([r[0] for r in rows], links), Counter(x for p in links for x in p)
    expect = {(r[0], number[r[0]], want[r[0]], want[r[0]] == r[0]) for r in rows}
    assert {tuple(r) for r in vectors.near_duplicates(df).collect()} == expect
    monkeypatch.setattr(vectors, "BLOCK", 20)  # blocks of large buckets
    assert {tuple(r) for r in vectors.near_duplicates(df).collect()} == expect
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vector_recall(spark):
    """Links found through the tables of codes, against all pairs."""
    rng = np.random.default_rng(12)
    base = rng.standard_normal((500, 64))
    rows = [(k, (base[k % 500] + rng.standard_normal(64) * 0.13).tolist(), 1) for k in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    number = Counter(x for p in exact_links(rows, 0.98) for x in p)
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df, bucket=8).collect()}
    assert all(n <= number[i] for i, n in got.items())
    assert sum(got.values()) >= 0.97 * sum(number.values()) > 500


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.roll(x, 1, 0) * 0.5 + x * 0.5
    y /= np.linalg.norm(y, axis=1)[:, None]
    cx, cy = vectors.Codes(x), vectors.Codes(y)
    estimate = (cx.signs * cy.turned).sum(1) / cx.factor
    true = (x * y).sum(1)
    assert abs((estimate - true).mean()) < 0.01
    assert (np.abs(estimate - true) <= vectors.SIGMAS * cx.spread).all()


def test_pipeline(spark):
    """Each stage against what its operator says of its own input, down to packed sequences."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.stored(stage(spark, frames[-1], SF), f"test-{name}"))
    assert all(f.columns == docs.columns for f in frames[:-1])
    ids = [Counter(r.doc_id for r in f.select("doc_id").collect()) for f in frames]
    scored = quality.score(docs, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert ids[1] == Counter(r.doc_id for r in scored.where("predicted = 1").collect())
    seen: dict[str, int] = {}
    for r in frames[1].orderBy("doc_id").collect():
        seen.setdefault(" ".join(f" {r.text} ".split(" ")).replace("\n", " "), r.doc_id)
    texts = {r.doc_id: r.text for r in frames[1].collect()}
    norm = lambda t: __import__("re").sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first: dict[str, int] = {}
    for i in sorted(texts):
        first.setdefault(norm(texts[i]), i)
    assert ids[2] == Counter(first.values())
    groups = shingles.similar_groups(frames[2], 5, 80).collect()
    assert ids[3] == Counter(r.doc_id for r in groups if r.doc_id == r.component_id)
    assert set(ids[4]) == set(ids[3])
    pieces = frames[5].groupBy("doc_id").agg({"length": "sum", "piece": "count"}).collect()
    assert {r.doc_id for r in pieces} == set(ids[4])
    got = corpus_pipeline.run(spark, SF)
    assert sorted(got.columns) == sorted(frames[5].columns) and got.count() == frames[5].count()


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14)) and "pipeline" in entry.queries()
