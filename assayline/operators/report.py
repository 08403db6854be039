"""Small reports over tables: counts, previews, extremes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline import contracts as K
from assayline.operators.lookup import lookup
from assayline.operators.rules import KIND, REASON, union_all


def pass_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("passed_records"))
        .select(F.lit(name).alias("entity"), "passed_records")
        for name, df in tables.items())


def reconcile(tagged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in, passed and rejected per entity, from one aggregate over the tagged frame."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("records"),
               F.count_if(F.col(REASON).isNull()).alias("passed_records"),
               F.count_if(F.col(REASON).isNotNull()).alias("failed_records"))
        .select(F.lit(name).alias("entity"), "records", "passed_records", "failed_records")
        for name, df in tagged.items())


def flag_report(log: DataFrame) -> DataFrame:
    """Quality log in reading order: by entity, most failures first."""
    return log.select("entity", REASON, KIND, "failed_record_count").orderBy(
        "entity", F.col("failed_record_count").desc(), REASON)


def breakdown(quarantine: DataFrame) -> DataFrame:
    """Rejected rows of one entity by reason and type, most first."""
    return (quarantine.groupBy(REASON, KIND).agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.col("cnt").desc(), REASON))


def before_after(raw: DataFrame, clean: DataFrame, raw_key: Column, key: str,
                 before: Mapping[str, Column], after: Sequence[str]) -> DataFrame:
    """Raw next to cleaned values of each key that is in the clean table. A key that
    came in several times has one row per raw version; the caller may limit it."""
    left = raw.select(raw_key.alias(key), *[c.alias(f"{n}_raw") for n, c in before.items()])
    right = clean.select(F.col(key).alias("_key"), *after, F.lit(True).alias("_known"))
    return lookup(left, right, key, "_key", spread_by=left.columns).filter("_known").drop("_known")


def extreme(df: DataFrame, by: str, tie: Sequence[str], largest: bool = True) -> DataFrame:
    """The one row with the largest or smallest value; ties by the given columns. A row
    without a value comes last either way."""
    first = F.col(by).desc_nulls_last() if largest else F.col(by).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc_nulls_last() for c in tie]).limit(1)


def top(df: DataFrame, by: str, tie: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie]).limit(n)


def duplicate_count(df: DataFrame, group: str, key: str, distinct: str = "keys", total: str = "rows",
                    surplus: str = "duplicates") -> DataFrame:
    """Per group the number of different keys, of rows with a key, and of rows beyond one per
    key. Rows are counted by key first, so a key with many of them is one row by then."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(group, key).agg(F.count(F.lit(1)).alias("_n"))
    # a group whose rows all lack a key still has its row, with zeros
    groups = df.groupBy(group).agg(F.count(key).alias("_all"))
    different = per_key.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias("_keys"))
    keys = F.coalesce(F.col("_keys"), F.lit(0))
    return groups.join(different, F.col(group).eqNullSafe(F.col("_group")), "left").select(
        group, keys.alias(distinct), F.col("_all").alias(total), (F.col("_all") - keys).alias(surplus))


def severity_band(c: str) -> Column:
    high, medium = K.SEVERITY_BANDS
    return (F.when(F.col(c) > high, "HIGH").when(F.col(c) > medium, "MEDIUM").otherwise("LOW"))


def table_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Rows of each named table; NULL and found = false where a table is missing."""
    parts = []
    for name in names:
        there = spark.catalog.tableExists(name)
        rows = (spark.read.table(name).agg(F.count(F.lit(1)).alias("row_count")) if there
                else spark.range(1).select(F.lit(None).cast("bigint").alias("row_count")))
        parts.append(rows.select(F.lit(name).alias("table_name"), F.lit(there).alias("found"),
                                 "row_count"))
    return union_all(parts)
