"""From raw documents to packed sequences: five stages, each one of the operators in
`assayline/llm`. A stage takes what the one before kept; all but the last return documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm import exact, mixing, packing, quality, shingles
from assayline.llm.common import free, stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It scores the rows in place, so rows
    that share an id are judged each by its own text. Null and empty texts are scored by the
    bias; without labels all rows stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.keep_first(docs, stored(exact.exact_groups(docs), "kept"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that links by shingles, the one with the smallest id (of several
    with this id, one by its text); rows without an id stay, and so does a row whose id stands
    at a near copy too. Five words a shingle and four fifths in common, as is usual here."""
    return shingles.keep_first(docs, width=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at the target weights of their sources: every source is read once at least,
    so none of its documents goes, and small ones up to MAX_EPOCHS times. Rows of a source
    without a single token have no weight and stay as they are."""
    last, own, source, epoch = free(docs, "_last", "_id", "_source", "_epoch")
    taken = mixing.mixed(docs).groupBy(F.col("doc_id").alias(own), F.col("source").alias(source)).agg(F.max("epoch").alias(last))
    same = docs["doc_id"].eqNullSafe(F.col(own)) & docs["source"].eqNullSafe(F.col(source))
    times = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(last), F.lit(0)).cast("long"))
    return docs.join(taken, same, "left").withColumn(epoch, F.explode(times)).select(*[docs[c] for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 1024 tokens. Null and empty texts are
    one token, the end mark; repeated rows are packed as often as they occur."""
    return packing.pack(docs)


STAGES = [("quality", good_quality), ("exact_dedup", no_copies), ("ngram_jaccard", no_near_copies),
          ("mixing", mixture), ("packing", sequences)]

#: Scores and tokens cannot be had in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
