"""Registered queries: each operator with its production parameters on its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm import centroids, exact, licenses, lines, mixing, packing, pii, quality, shingles, suffix, toxicity, trie, vectors
from assayline.llm.common import table


def hex256(c: Column | str) -> Column:
    return F.sha2(F.col(c).cast("binary") if isinstance(c, str) else c.cast("binary"), 256)


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document and epoch that the mixture takes."""
    return mixing.mixed(table(spark, folder, "documents")).select(
        "doc_id", "source", "n_tokens", "epoch", "block", "block_start", F.round("weight", 9).alias("weight"))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix.without_repeats(table(spark, folder, "documents"), with_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").cast("string").alias("kept_sha256"))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(table(spark, folder, "documents"))

    def joined(c: str) -> Column:
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), hex256(joined("base")).alias("base_sha256"), joined("spans").alias("spans"))


def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_notices(table(spark, folder, "documents"))
    base, every = F.transform("base", lambda b: b["label"]), F.transform("hits", lambda h: h["label"])
    word = F.transform("base", lambda b: b["word"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(word).cast("long").alias("first_word"), F.array_max(word).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, every))), ",").alias("labels"), "score")


def op9_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return shingles.similar_groups(table(spark, folder, "documents"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.without_spread_lines(table(spark, folder, "pages"))
    return out.select("page_id", "n_lines", "n_removed", hex256("kept").alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    rows, found, inertia = centroids.clustered(table(spark, folder, "embeddings"))
    # One value per centroid, by its number: eight at most, however many vectors.
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found]

    def own(values: list, kind: str) -> Column:
        each = F.array(*[F.lit(v) for v in values]) if values else F.array(F.lit(None))
        return F.element_at(each, F.col("cluster") + 1).cast(kind)
    return rows.select("vec_id", "cluster", "distance", own([min(v, centroids.LONG) for v in inertia], "long").alias("cluster_inertia"),
                       F.lit(min(sum(inertia), centroids.LONG)).cast("long").alias("inertia"), own(sha, "string").alias("centroid_sha256"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_mix_sources, op2_quality_classifier, op3_suffix_dedup, op4_best_fit_packing, op5_pii,
    op6_embedding_near_dedup, op7_exact_dedup, op8_license_scan, op9_ngram_jaccard, op10_line_dedup,
    op11_prefix_trie, op12_centroid_clustering, op13_toxicity, pipeline)}
