"""Filters before exchanges, word hashes, and clashing names in the stages of the pipeline."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assayline.llm import exact, mixing, shingles
from assayline.llm.common import free, may_have, utf8, word_hashes


def test_filter_keeps_all_wanted_rows_and_few_others(spark):
    df = spark.range(20_000).select(F.col("id").alias("a"), (F.col("id") % 7).cast("string").alias("b"), F.lit("x").alias("key_word"))
    keys = df.where("a % 20 = 3").select("a", "b")
    kept = may_have(df, keys, "a", "b")
    assert kept.columns == df.columns
    assert kept.join(keys, ["a", "b"]).count() == keys.count()
    assert kept.count() - keys.count() < 20_000 / 16
    assert may_have(df, keys.limit(0), "a").count() == 0
    twice = df.limit(10).unionByName(df.limit(10))
    assert may_have(twice, df.limit(10), "a", "b").count() == 20


def test_filter_reads_every_bit(spark):
    df = spark.range(3000).select(F.col("id").alias("a"))
    for k in range(0, 3000, 371):
        assert k in {r.a for r in may_have(df, df.where(F.col("a") == k), "a").collect()}


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_at int, __AT int, x int")
    assert free(df, "_at", "x", "y", "y") == ["___at", "_x", "y", "_y"]


def thue_morse(n, first):
    word = first
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


@pytest.mark.parametrize("n", [64, 128, 1024, 4096])
def test_complementary_words_have_different_hashes(n):
    found, _ = word_hashes(*utf8(pa.array([thue_morse(n, "a"), thue_morse(n, "b"), thue_morse(n, "a").upper()])))
    assert found[0] != found[1] and found[0] == found[2]
    sets = shingles.sets_of(pa.array([thue_morse(n, "a"), thue_morse(n, "b")]), 4)
    assert not np.array_equal(*sets)


def test_documents_of_such_words_do_not_link(spark):
    df = spark.createDataFrame([(1, thue_morse(1024, "a")), (2, thue_morse(1024, "b"))], "doc_id long, text string")
    assert sorted(map(tuple, shingles.similar_groups(df).collect())) == [(1, 1, 1), (2, 1, 2)]


CLASH = ["_at", "_sha", "_kept", "_n", "_id", "_hash", "_last", "_source", "_epoch", "last", "text_hash", "key_place", "epoch", "rep", "cluster", "score"]


@pytest.fixture
def clashing(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()
    rows = [(1, " ".join(words), "s"), (2, " ".join(words), "s"), (3, " ".join(words[:-1] + ["rho"]), "t"), (4, None, "empty"),
            (5, "", "empty"), (None, "no id", None), (6, "something else entirely here", "t"), (6, "something else entirely here", "t")]
    df = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASH})


@pytest.mark.parametrize("stage, ids", [
    (corpus_pipeline.no_copies, [1, 3, 4, 6, None]), (corpus_pipeline.no_near_copies, [1, 4, 5, 6, 6, None]), (corpus_pipeline.mixture, None)])
def test_stages_keep_columns_with_clashing_names(spark, clashing, stage, ids):
    out = stage(spark, clashing, "")
    assert out.columns == clashing.columns
    rows = out.collect()
    assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASH)
    got = sorted((r.doc_id for r in rows), key=lambda i: (i is None, i))
    if ids is not None:
        assert got == ids
    else:
        assert set(got) == {1, 2, 3, 4, 5, 6, None}
    assert stage(spark, clashing.limit(0), "").count() == 0


def test_mixture_keeps_sources_without_tokens(spark):
    rows = [(1, "a b", "s"), (2, "c d", "s"), (3, None, "none"), (4, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in corpus_pipeline.mixture(spark, df, "").collect()) == [1, 2, 3, 4]
    assert mixing.mixed(df).count() == 2


def test_pairs_of_texts_with_one_digest_are_told_apart(spark):
    df = spark.createDataFrame([(i, f"text {i % 4}") for i in range(40)], "doc_id long, text string")
    one = exact.exact_groups(df, digest=lambda t: F.lit("same"))
    assert sorted(map(tuple, one.select("doc_id", "keep_id", "group_size", "kept").collect())) == [
        (i, i % 4, 10, i < 4) for i in range(40)]
