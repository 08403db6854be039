"""Retrieval of policies for questions: documents, hits, statistics, history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline import contracts as K
from assayline.functions import text as X
from assayline.operators.enrich import STUB_NAME, first_line, with_text
from assayline.operators.similar import cosine_top_k
from assayline.session import scratch

NOTHING_FOUND = "No relevant policies found for this query."


def documents(policies: DataFrame) -> DataFrame:
    """One text per policy, with the fields an answer may cite."""
    return policies.select(
        "policy_number", "policy_state", "is_active",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
          for c in ("annual_premium", "deductible", "umbrella_limit")],
        X.policy_sentence().alias("text"))


def retrieve(questions: DataFrame, docs: DataFrame, k: int = K.TOP_K) -> DataFrame:
    """Hits with the text of their document.

    `questions` has query_id, question and vector; `docs` has doc_id, text and
    vector. The hits are stored, at most k per question, so that Spark knows their
    size: it sends few of them to the documents, whose text then stays where it is.
    """
    path = scratch(docs.sparkSession, "hits")
    cosine_top_k(questions, docs, k).write.parquet(path)
    hits = docs.sparkSession.read.parquet(path)
    return docs.select("doc_id", "text").join(hits, "doc_id").select(
        "query_id", "position", "doc_id", "confidence", "text")


def stats(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per question: scores, number of hits, cited ids and context by rank.

    A question without hits keeps its row, with zeros and found = false.
    """
    entry = F.struct("position", F.col("doc_id").cast("string").alias("id"), "confidence", "text")
    per = hits.groupBy("query_id").agg(
        F.max("confidence").alias("top"), F.avg("confidence").alias("mean"),
        F.array_sort(F.collect_list(entry)).alias("hits"))  # at most k entries
    block = F.transform("hits", lambda h: F.concat(
        F.lit("[Source "), h["position"].cast("string"), F.lit(" — Policy "), h["id"],
        F.lit(" (relevance score: "), F.format_number(h["confidence"], 4), F.lit(")]\n"),
        h["text"]))
    return questions.select("query_id", "question").join(per, "query_id", "left").select(
        "query_id", "question",
        F.coalesce(F.array_join(F.transform("hits", lambda h: h["id"]), ", "), F.lit(""))
        .alias("source_policies"),
        F.coalesce(F.round("top", 4), F.lit(0.0)).alias("confidence_score"),
        F.coalesce(F.round("mean", 4), F.lit(0.0)).alias("avg_confidence"),
        F.coalesce(F.size("hits"), F.lit(0)).alias("chunks_retrieved"),
        F.col("hits").isNotNull().alias("policy_found"),
        F.coalesce(F.array_join(block, "\n\n"), F.lit("")).alias("context"))


def answer(found: DataFrame, generate: Callable[[str], str] = first_line,
           model: str = STUB_NAME, stamp: bool = True) -> DataFrame:
    """Rows of the retrieval history, to be appended. Only questions with hits are put
    to the generator."""
    prompt = F.concat(F.col("context"), F.lit("\n\nQUESTION: "), F.col("question"))
    hit = found.withColumn("_prompt", F.when(F.col("policy_found"), prompt))
    made = with_text(hit, "_prompt", "answer",
                     lambda p: generate(p) if p is not None else NOTHING_FOUND, model)
    out = made.select(
        X.short_id().alias("query_id") if stamp else "query_id", "question", "answer",
        "source_policies", *[F.col(c).cast("float").alias(c) for c in (
            "confidence_score", "avg_confidence", "chunks_retrieved")], "policy_found")
    return out.withColumn("queried_at", F.current_timestamp()) if stamp else out


def latest(history: DataFrame, n: int = 10) -> DataFrame:
    """Newest rows of the history, a preview."""
    return (history.orderBy(F.col("queried_at").desc(), "query_id").limit(n)
            .select("query_id", "question", "source_policies", "confidence_score",
                    "policy_found", "queried_at"))
