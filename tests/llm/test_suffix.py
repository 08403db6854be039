"""Suffix order and removal of repeated passages against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assayline.llm import suffix
from assayline.llm.induced import suffixes

SCHEMA = "doc_id long, text string, kept string"


def ordered(text, limit, depth, folder):
    out = list(suffixes(text, str(folder), limit, depth))[::-1]
    return np.concatenate([x["pos"] for x in out]), np.concatenate([x["lcp"] for x in out])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=120), st.integers(1, 4), st.sampled_from([100, 700, 10**9]),
       st.sampled_from([5, 50]))
def test_suffixes(tmp_path_factory, chars, times, limit, depth):
    text = np.array(chars * times + [0], np.int64)
    pos, lcp = ordered(text, limit, depth, tmp_path_factory.mktemp("s"))
    assert sorted(pos.tolist()) == list(range(len(text)))
    keys = [tuple(text[p:p + depth].tolist()) for p in pos]
    assert keys == sorted(keys)
    for k in range(1, len(keys)):
        same = 0
        while same < min(map(len, keys[k - 1:k + 1])) and keys[k - 1][same] == keys[k][same]:
            same += 1
        assert min(lcp[k], depth) == same


def brute(rows, window=50):
    texts = [(i, (t or "").encode()) for i, t in rows]
    least: dict[bytes, float] = {}
    for i, t in texts:
        key = float("inf") if i is None else i
        for s in range(len(t) - window + 1):
            w = t[s:s + window]
            least[w] = min(least.get(w, key), key)
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for s in range(len(t) - window + 1):
            if least[t[s:s + window]] < (float("inf") if i is None else i):
                gone[s:s + window] = [True] * window
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    return sorted((tuple(r[:4]) + (r.kept.decode(),) for r in suffix.without_repeats(df, with_text=False, **options).collect()), key=str)


def corpus():
    rng = np.random.default_rng(5)
    words = ["alpha", "beta", "gämma", "delta", "ep", "zêta", "the", "of"]
    text = lambda n: " ".join(rng.choice(words, n))
    passage, line = text(40), "x" * 49
    rows = [(i, text(int(rng.integers(0, 120)))) for i in range(40)]
    rows += [(100 + i, text(20) + passage + text(15)) for i in range(12)]
    rows += [(200 + i, passage) for i in range(5)] + [(50, passage[:49]), (51, passage[3:53])]
    rows += [(300, line), (301, line), (302, line + "x"), (303, "x" * 400), (304, "y" * 300 + "x" * 60)]
    rows += [(400, None), (401, ""), (None, passage), (None, passage + "z"), (100, rows[40][1]), (100, "q" + rows[40][1])]
    return rows


@pytest.mark.parametrize("sort_bytes", [2000, 1 << 28])
def test_without_repeats(spark, sort_bytes):
    rows = corpus()
    assert got(spark, rows, sort_bytes=sort_bytes) == brute(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_text_left(spark):
    a = "".join(chr(97 + k * 7 % 26) for k in range(30)) + "0123456789" * 3
    df = spark.createDataFrame([(1, a), (2, "head " + a + " tail")], "doc_id long, text string")
    left = {r.doc_id: bytes(r.kept) for r in suffix.without_repeats(df).collect()}
    assert left == {1: a.encode(), 2: b"head  tail"}
