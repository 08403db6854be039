"""Newest row per key, and the rows it replaces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayline.operators.lookup import HOT_SHARE, hot_keys
from assayline.session import salt_count

HOT_ROWS = 10_000  # a key of fewer rows is no burden to a task


def newest_first(df: DataFrame, key: str, time: str = "_ingest_time",
                 source: str = "_source_file") -> list[Column]:
    """Total order of the rows of one key: newest, then greatest source, then the values.

    The values come last so that a tie is decided the same way in every run. Rows
    that still tie are equal in every column, so either may stand for the other.
    """
    head = [F.col(c).desc_nulls_last() for c in (time, source) if c in df.columns]
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in (key, time, source)]
    return head + rest


def mark_latest(df: DataFrame, key: str, order: Sequence[Column] | None = None,
                flag: str = "_is_latest", salts: int | None = None, share: int = HOT_SHARE,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds a boolean: is this row the survivor of its key?

    Rows are exchanged and sorted once, by key. Hot keys, with more than 1/share of the rows
    and more than `hot_rows`, are found beforehand by a pass over the keys (`hot_keys`), and
    their rows alone are ranked in two rounds, which keep a hot key, or many copies of one
    row, out of a single task. Round one ranks within (key, salt); round two ranks the local
    firsts of each key, at most one per salt, while all other rows keep their salt as their
    group. The salt comes from the input partition and the row, so a retried task gives the
    same salts, and the result does not depend on them.

    Rows with a NULL key are all marked: a missing key is no duplicate. They are spread too.
    """
    order = list(order or newest_first(df, key))
    salts = salts or salt_count(df.sparkSession)
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns]),
                  F.lit(salts))
    hot = [r[0] for r in hot_keys(df, key, share, hot_rows).collect()]
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    once = Window.partitionBy(key, "_lane").orderBy(*order)
    marked = (
        (df.filter(~is_hot) if hot else df)
        .withColumn("_lane", F.when(F.col(key).isNull(), salt).otherwise(F.lit(0).cast("long")))
        .withColumn(flag, F.col(key).isNull() | (F.row_number().over(once) == 1))
        .drop("_lane"))
    if not hot:
        return marked
    local = Window.partitionBy(key, "_salt").orderBy(*order)
    final = Window.partitionBy(key, "_lane").orderBy(*order)
    spread = (
        df.filter(is_hot).withColumn("_salt", salt)
        .withColumn("_local", F.row_number().over(local))
        # -1 is the lane of the local firsts
        .withColumn("_lane", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_salt")))
        .withColumn("_final", F.row_number().over(final))
        .withColumn(flag, (F.col("_lane") == -1) & (F.col("_final") == 1))
        .drop("_salt", "_local", "_lane", "_final"))
    return marked.unionByName(spread)


def split_latest(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Survivors and replaced rows; the latter with reason, type and time."""
    marked = mark_latest(df, key)
    kept = marked.filter("_is_latest").drop("_is_latest")
    replaced = marked.filter(~F.col("_is_latest")).drop("_is_latest").withColumns({
        "quarantine_reason": F.lit(f"duplicate {key}"),
        "quarantine_type": F.lit("drop"),
        "quarantine_timestamp": F.current_timestamp(),
    })
    return kept, replaced


def keep_latest(df: DataFrame, key: str, order: Sequence[Column] | None = None,
                keep_null_keys: bool = True) -> DataFrame:
    """Survivors only. The rank limit prunes each task to one row per key before the
    shuffle, so a hot key sends one row per task. Rows without a key all stay, as none is a
    duplicate of another, and each is a group of its own, which also spreads them over the
    tasks; without `keep_null_keys` they are left out."""
    if not keep_null_keys:
        df = df.filter(F.col(key).isNotNull())
    w = Window.partitionBy(key, "_alone").orderBy(*(order or newest_first(df, key)))
    return (df.withColumn("_alone", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
            .withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank", "_alone"))


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever comes first. Works on streams, where the state holds
    every key ever seen."""
    return df.dropDuplicates(list(keys))


def keep_any_within(df: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Stream form with bounded state: copies further apart than the delay are kept."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
