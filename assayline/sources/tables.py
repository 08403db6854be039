"""Stored tables: Parquet folders or catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.operators.rules import union_all
from assayline.sources import ledger


def read(spark: SparkSession, name: str) -> DataFrame:
    """A path (contains '/') or a table name. Files appended with more columns are merged."""
    if "/" in name:
        return spark.read.option("mergeSchema", True).parquet(name)
    return spark.read.table(name)


def overwrite(df: DataFrame, name: str, comment: str | None = None,
              partition_by: tuple[str, ...] = (), rows_per_file: int = 5_000_000) -> None:
    """Replaces content and schema."""
    _write(df, name, "overwrite", comment, partition_by, rows_per_file)


def append(df: DataFrame, name: str, comment: str | None = None,
           partition_by: tuple[str, ...] = (), rows_per_file: int = 5_000_000) -> None:
    """Adds rows; history accumulates. New columns are allowed in a Parquet folder."""
    _write(df, name, "append", comment, partition_by, rows_per_file)


def _write(df, name, mode, comment, partition_by, rows_per_file) -> None:
    w = df.write.mode(mode).format("parquet").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in name:
        w.save(name)
        return
    w.saveAsTable(name)
    if comment:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{text}'")


def append_once(df: DataFrame, name: str, run: str, version: int | None = None) -> None:
    """Adds the rows of a run to a folder that keeps a commit ledger. The same run again, after
    a crash or by mistake, leaves one copy of its rows, and readers see all of them or none."""
    if version is None:
        seen = {r["run"]: r["version"] for r in ledger.entries(df.sparkSession, name).collect()}
        version = seen.get(run, max(seen.values(), default=-1) + 1)
    ledger.commit(df, name, run, version)


def read_committed(spark: SparkSession, name: str, version: str | None = None) -> DataFrame:
    """All rows of the runs in the ledger; `version` names a column for the number of the run.
    Parts that lack a column give NULL."""
    parts = ledger.committed(spark, name)
    if not parts:
        raise FileNotFoundError(f"{name}: no committed run")
    frames = [spark.read.parquet(p) for _, p in parts]
    if version:
        frames = [df.withColumn(version, F.lit(v).cast("bigint")) for df, (v, _) in zip(frames, parts)]
    return union_all(frames, allow_missing=True)


def read_newest(spark: SparkSession, name: str, keys: Sequence[str]) -> DataFrame:
    """Of a folder to which runs append changed rows: the newest row of each key. A task hands
    on one row per key."""
    rows = read_committed(spark, name, "_version")
    rest = [c for c in rows.columns if c not in (*keys, "_version")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_version").alias("_row"))
    return newest.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def fold_newest(spark: SparkSession, name: str, keys: Sequence[str]) -> None:
    """Folds all runs into one that has the newest rows only, so that many small runs do not
    slow readers down. Readers see the old parts until the new one is named."""
    parts = ledger.committed(spark, name)
    if len(parts) > 1:
        version = parts[-1][0]
        ledger.commit(read_newest(spark, name, keys), name, f"folded-{version}", version, [p for _, p in parts])


def spread(df: DataFrame) -> DataFrame:
    """The frame over at least half as many tasks as there are cores. A file of one row group
    is read by one task, whatever the cluster; its rows are then dealt out before costly steps.
    A table of many row groups is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def tpc(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
