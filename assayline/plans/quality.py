"""Reports on the quality log: per issue and per entity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.functions import text as X
from assayline.operators.enrich import STUB_NAME, first_line, with_text
from assayline.operators.report import severity_band
from assayline.plans.silver import with_default

LOG_TABLE = "silver.silver_quality_log"


def issues(log: DataFrame, table: str = LOG_TABLE) -> DataFrame:
    """Quality log with the columns of a report; those already there are kept."""
    df = with_default(log, "issue_id", F.expr("uuid()"))
    df = with_default(df, "table_name", F.lit(table))
    df = with_default(df, "column_name", F.col("quarantine_reason"))
    df = with_default(df, "severity", severity_band("failed_record_count"))
    if "affected_records" not in df.columns:
        df = df.withColumnRenamed("failed_record_count", "affected_records")
    return df


def issue_report(issue_rows: DataFrame, generate: Callable[[str], str] = first_line,
                 model: str = STUB_NAME, stamp: bool = True) -> DataFrame:
    """One explanation per issue."""
    made = with_text(issue_rows.withColumn("_brief", X.issue_brief()), "_brief", "explanation",
                     generate, model)
    out = made.select(
        "issue_id", "table_name", "column_name", "severity",
        F.col("affected_records").try_cast("int").alias("affected_records"), "entity",
        "quarantine_reason", "explanation", "model_name", "generation_status")
    return out.withColumn("generated_at", F.current_timestamp()) if stamp else out


def by_entity(log: DataFrame) -> DataFrame:
    """Per entity: its issues as a list, most frequent first, their total, the last run.

    The list has one entry per reason and type, not per record.
    """
    entry = F.struct((-F.col("failed_record_count")).alias("order"), "quarantine_reason",
                     "failed_record_count")
    extra = [F.max("log_timestamp").alias("latest_run")] if "log_timestamp" in log.columns else []
    return log.groupBy("entity").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(
            e["quarantine_reason"].alias("quarantine_reason"),
            e["failed_record_count"].alias("failed_record_count"))).alias("issues"),
        F.sum("failed_record_count").alias("total_failed"), *extra)


def entity_report(per_entity: DataFrame, generate: Callable[[str], str] = first_line,
                  model: str = STUB_NAME, stamp: bool = True) -> DataFrame:
    """One memo per entity."""
    made = with_text(per_entity.withColumn("_brief", X.entity_brief()), "_brief", "explanation",
                     generate, model)
    out = made.select("entity", F.col("total_failed").try_cast("int").alias("total_failed"),
                      "explanation", "generation_status")
    return out.withColumn("generated_at", F.current_timestamp()) if stamp else out
