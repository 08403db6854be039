"""Prefix trie, centroid clustering and the toxicity classifier on small tables."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayline.llm import centroids, toxicity, trie
from assayline.llm.contraction import subtree_sums
from assayline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- contraction -------------------------------------------------------------
def random_forest(n, deep, seed):
    rng = random.Random(seed)
    up = {0: None}
    for i in range(1, n):
        up[i] = None if rng.random() < 0.01 else (i - 1 if rng.random() < deep else rng.randrange(i))
    return up


@pytest.mark.parametrize("deep", [0.0, 0.7, 0.97, 1.0])
def test_subtree_sums(spark, deep):
    up = random_forest(300, deep, int(deep * 100))
    level = {}
    for i, p in up.items():
        level[i] = 0 if p is None else level[p] + 1
    rows = [(i, p, level[i], i % 7 - 2, None if i % 11 == 0 else 1) for i, p in up.items()]
    got = {r.node: (r.a, r.b) for r in subtree_sums(
        spark.createDataFrame(rows, "node long, parent long, level long, a long, b long").withColumn("_n", F.lit("x")), ["a", "b"]).collect()}
    want = {i: [a, b or 0] for i, _, _, a, b in rows}
    for i in sorted(up, key=lambda i: -level[i]):
        if up[i] is not None:
            want[up[i]][0] += want[i][0]
            want[up[i]][1] += want[i][1]
    assert got == {i: tuple(v) for i, v in want.items()}


def test_subtree_sums_of_odd_forests(spark):
    schema = "node long, parent long, level long, a long"
    assert subtree_sums(spark.createDataFrame([], schema), ["a"]).count() == 0
    # Levels that say nothing: the coin alone takes chains apart.
    chain = [(i, i - 1 if i else None, 0, 1) for i in range(40)]
    got = subtree_sums(spark.createDataFrame(chain, schema), ["a"]).collect()
    assert {r.node: r.a for r in got} == {i: 40 - i for i in range(40)}
    star = [(i, 0 if i else None, min(i, 1), i) for i in range(500)]
    got = {r.node: r.a for r in subtree_sums(spark.createDataFrame(star, schema), ["a"]).collect()}
    assert got[0] == sum(range(500)) and got[7] == 7
    with pytest.raises(RuntimeError):
        subtree_sums(spark.createDataFrame([(1, 2, 0, 1), (2, 1, 1, 1)], schema), ["a"], most_rounds=3)


# --- trie --------------------------------------------------------------------
def brute_trie(rows, family=100, shared=6):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            sha = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
            own[c].append(((t is not None, t or 0), sha, (r, x)))
    own = {c: [x for _, _, x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % shared
        whole[c] = own.get(c - int(math.fmod(c, family)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = []
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        sums[p] = (sum(sums[k][0] for k in kids[p]) or 1, saved + sum(sums[k][1] for k in kids[p]))
        ends = ",".join(str(c) for c in sorted(members[p]) if len(whole[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), *sums[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
CONV = "conv_id long, turn long, role string, text string"


def trie_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(df).collect()), key=repr)


def test_trie_of_odd_rows(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", None, ""]), rng.choice(["a", "é", "bb", None, "", "ccc"]))
            for c in [*range(40), 100, 101, 150, 199, 200, 305, -5, -107] for t in range(rng.randrange(1, 9))]
    rows += [(1, 0, "user", "tie"), (1, 0, "user", "tie"), (1, 0, "user", "other"), (2, None, "user", "first"),
             (None, 0, "user", "no id"), (7, 3, "user", "x" * 100_000)]
    rows += [(500, t, "user", f"turn {t}") for t in range(120)] + [(501, t, "user", f"turn {t}") for t in range(120)]
    rows += [(502, 0, "user", "again")] * 30
    df = spark.createDataFrame(rows, CONV).withColumns({c: F.lit("x") for c in ("part", "k1", "depth", "n_convs", "_n")})
    assert trie_rows(df) == brute_trie(rows)


def test_trie_of_one_family_and_of_nothing(spark):
    assert trie.prefix_trie(spark.createDataFrame([], CONV)).count() == 0
    rows = [(c, t, "user", f"{t}") for c in range(100) for t in range(3)]
    assert trie_rows(spark.createDataFrame(rows, CONV)) == brute_trie(rows)


def test_trie_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert trie_rows(df) == brute_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


# --- centroids ---------------------------------------------------------------
def brute_centroids(rows, k=8, rounds=10, width=64):
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows
            if e is not None and len(e) == width and all(x is not None and math.isfinite(x) and math.isfinite(x * 1024) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cent = [v for _, v in order[:k]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cent]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[0]].append(v)
        cent = [[sum(x) // len(own[c]) for x in zip(*own[c])] if own[c] else old for c, old in enumerate(cent)]
    out = [(i, *near(v)) for i, v in kept]
    return out, cent


VEC = "vec_id long, embedding array<double>, cluster string, x string"


def check_centroids(spark, rows, **options):
    df = spark.createDataFrame([(i, e, "x", "x") for i, e in rows], VEC)
    got, found, inertia = centroids.clustered(df, **options)
    want, cent = brute_centroids(rows)
    big = (1 << 63) - 1
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, c, min(d, big)) for i, c, d in want), key=repr)
    assert found == cent
    assert inertia == [sum(min(d, big) for _, c, d in want if c == j) for j in range(len(cent))]


def test_centroids(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=64) + 2 * (i % 5)).tolist()) for i in range(300)]
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [math.nan] + [1.0] * 63),
           (905, [math.inf] + [1.0] * 63), (None, [0.5] * 64), (7, [0.5] * 64), (8, [0.5] * 64), (8, [0.5] * 64), (9, [0.0] * 64)]
    check_centroids(spark, rows + odd)
    check_centroids(spark, rows + odd, block=7)


def test_centroids_beyond_64_bits(spark):
    rows = [(i, [(-1) ** (i + j) * 10.0 ** (i % 20) for j in range(64)]) for i in range(40)]
    check_centroids(spark, rows + [(99, [1e308] * 64)])


def test_few_centroids(spark):
    check_centroids(spark, [])
    check_centroids(spark, [(1, [1.0] * 64), (2, [2.0] * 64)])
    check_centroids(spark, [(i, [1.0] * 64) for i in range(20)])


# --- toxicity ----------------------------------------------------------------
LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, score string, held_out string"


def test_toxicity_holds_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = QUERIES["op13_toxicity"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in out)
    toxic = [r for r in out if r.toxic == 1]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in out if r.toxic == 0) <= 0.01 * len(out)


def test_toxicity_of_odd_rows(spark):
    rows = [(i, f"calm words number {i} here" if i % 2 else f"vile insult {i} again", "x", "x") for i in range(200)]
    odd = [(1000, None, "x", "x"), (1001, "", "x", "x"), (None, "vile insult", "x", "x"), (3, "calm words", "x", "x"),
           (3, "calm words", "x", "x"), (1002, "vile " * 200_000, "x", "x"), (1003, " .,! ", "x", "x")]
    labels = [(i, 0, 1 - i % 2) for i in range(200)] + [(5, 0, None), (None, 0, 1), (9999, 0, 1), (7, 0, 0), (7, 0, 1)]
    docs, marks = spark.createDataFrame(rows + odd, DOCS), spark.createDataFrame(labels, LABELS)
    out = toxicity.toxicity(docs, marks).collect()
    assert len(out) == len(rows + odd)
    assert all(0 <= r.score <= 1 and (r.held_out or r.doc_id is not None) for r in out)
    score = {r.doc_id: r.score for r in out}
    assert score[1000] == score[1001] == score[1003] and score[4] > 0.5 > score[11] and score[None] > 0.5
    assert toxicity.toxicity(docs.limit(0), marks).count() == 0
    assert {r.predicted for r in toxicity.toxicity(docs, marks.limit(0)).collect()} == {0}
    assert {r.predicted for r in toxicity.toxicity(docs, marks.where("toxic = 1")).collect()} == {1}


def test_slots_of_a_text_do_not_depend_on_its_neighbours():
    import pyarrow as pa
    from assayline.llm.common import utf8
    texts = ["Idiot!clown", "", "clown", " é-É lowei", "x", "clown idiot"]
    found, at = toxicity.slots(*utf8(pa.array(texts)))
    for i, t in enumerate(texts):
        alone, _ = toxicity.slots(*utf8(pa.array([t])))
        assert found[at[i]:at[i + 1]].tolist() == alone.tolist()
    assert set(toxicity.slots(*utf8(pa.array(["CLOWN"])))[0]) == set(toxicity.slots(*utf8(pa.array(["clown"])))[0])


def test_swaps():
    swap = toxicity.Swaps()
    assert swap.of("A Muslim woman and two womens", 1) == "A jewish man and two womens"
    assert not swap.has("womens") and swap.has("(WOMEN)")
    for line in toxicity.IDENTITY_TERMS:
        assert all(swap.of(t, by) != t and swap.of(t, by) in line for t in line for by in (1, 2, 3))
    assert not toxicity.Swaps(()).has("woman")


def test_counterfactual_cost_clears_neutral_mentions(spark):
    """Identity terms stand in toxic rows alone, so that a plain fit takes them for toxic."""
    rng = random.Random(1)
    filler = "the of and it was by for with on at from this that have not are".split()
    bad = "scum vermin filth garbage disgusting worthless".split()
    names = ["muslims", "jews", "immigrants", "women"]

    def text(*extra):
        words = [rng.choice(filler) for _ in range(12)] + list(extra)
        rng.shuffle(words)
        return " ".join(words)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 2
        rows.append((i, text(*([rng.choice(bad), rng.choice(names)] if toxic else [])), "x", "x"))
        labels.append((i, 0, toxic))
    neutral = [(10_000 + i, text(n), "x", "x") for i, n in enumerate(names * 5)]
    docs, marks = spark.createDataFrame(rows + neutral, DOCS), spark.createDataFrame(labels, LABELS)

    def taken(cost):
        out = {r.doc_id: r for r in toxicity.toxicity(docs, marks, counterfactual=cost).collect()}
        caught = [out[i].predicted for i in range(600) if i % 2 and out[i].held_out]
        return np.mean([out[n[0]].score for n in neutral]), np.mean(caught)
    plain, fair = taken(0.0), taken(toxicity.COUNTERFACTUAL)
    assert fair[0] < plain[0] - 0.05 and fair[1] >= 0.95


def test_fit_is_the_minimum():
    """No direction tried lowers the loss that `fit_model` minimises, computed here with dense rows."""
    rng = np.random.default_rng(2)
    size = 30
    rows = [np.unique(rng.integers(0, size, 6)).astype(np.int32) for _ in range(80)]
    y = np.array([1.0 if 3 in r or 5 in r else -1.0 for r in rows])
    other = [[np.unique(rng.integers(0, size, 6)).astype(np.int32)] for _ in range(10)]
    pairs = toxicity.changes(rows[:10], other)
    weight = np.where(y > 0, 2.0, 1.0)
    sparse = toxicity.Rows(rows)
    w = toxicity.fit_model(sparse, y, weight, pairs, size, l2=0.05, counterfactual=1.0, steps=300)
    dense = np.array([np.isin(np.arange(size), r) for r in rows], float)
    change = dense[:10] - np.array([np.isin(np.arange(size), o[0]) for o in other], float)
    scale = np.array([math.log((dense[y > 0, j].sum() + 1) / ((y > 0).sum() + 2)) - math.log((dense[y < 0, j].sum() + 1) / ((y < 0).sum() + 2))
                      for j in range(size)])
    assert np.allclose(scale, toxicity.ratios(sparse, y, size))

    def loss(w):
        v = np.divide(w[:-1], scale, out=np.zeros(size), where=scale != 0)
        return (weight / weight.sum() * np.logaddexp(0, -y * (dense @ w[:-1] + w[-1]))).sum() \
            + 0.05 / 2 * v @ v + 1.0 / 2 * ((change @ w[:-1]) ** 2).mean()
    best = loss(w)
    for _ in range(300):
        step = rng.normal(size=size + 1) * np.append(np.abs(scale), 1)
        assert loss(w + 1e-2 * step) > best - 1e-6
