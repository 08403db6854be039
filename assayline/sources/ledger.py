"""Commit ledger of a stored table: which of its parts count.

A run writes its rows to a part of its own and then one small entry that names the part. Readers
take the parts that are named, so they see all rows of a run or none. A run that is repeated
writes the same part and the same entry again, which leaves one copy of its rows. An entry may
also name parts that it replaces; that is how parts are folded together without a moment in
which rows are missing or double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_ENTRY = "version bigint, run string, part string, replaces array<string>"


def entries(spark: SparkSession, table: str) -> DataFrame:
    """(version, run, part, replaces) of every commit."""
    try:
        return spark.read.schema(_ENTRY).json(f"{table}/ledger")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def committed(spark: SparkSession, table: str) -> list[tuple[int, str]]:
    """(version, part) of the parts that count, oldest first. The driver holds one short row a run."""
    rows = sorted(entries(spark, table).collect(), key=lambda r: (r["version"], r["run"]))
    gone = {p for r in rows for p in r["replaces"] or ()}
    return [(r["version"], r["part"]) for r in rows if r["part"] not in gone]


def commit(df: DataFrame, table: str, run: str, version: int, replaces: Sequence[str] = ()) -> None:
    """Writes the rows of a run as its part, then the entry. `run` names the run, whatever the
    number of attempts; `version` orders runs."""
    spark = df.sparkSession
    name = "".join(c if c.isalnum() or c in "-_." else f"%{ord(c):x}" for c in run)
    part = f"{table}/parts/run={name}"
    df.write.mode("overwrite").parquet(part)
    entry = spark.createDataFrame([(version, run, part, list(replaces))], _ENTRY)
    entry.coalesce(1).write.mode("overwrite").json(f"{table}/ledger/entry={name}")
