"""Versioned log of the columns a stream has written.

Each entry is a small folder that one batch owns and replaces, so a repeated batch leaves its
entry as it was. An entry holds the columns that were new at the time, so the log stays as short
as the number of changes, and readers need not open the data to know its columns.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENTRY = "version bigint, position int, name string, type string"


def entries(spark: SparkSession, log: str) -> DataFrame:
    """(version, position, name, type) of every column, by the batch that brought it."""
    try:
        return spark.read.schema(_ENTRY).json(log)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def current(spark: SparkSession, log: str, before: int | None = None) -> T.StructType:
    """All columns so far, oldest first; with `before`, those of earlier versions."""
    rows = entries(spark, log)
    if before is not None:
        rows = rows.filter(F.col("version") < before)
    fields: dict[str, T.StructField] = {}
    for r in rows.orderBy("version", "position").collect():
        fields.setdefault(r["name"].lower(), T.StructField(r["name"], T.DataType.fromDDL(r["type"])))
    return T.StructType(list(fields.values()))


def extend(spark: SparkSession, log: str, version: int, schema: T.StructType) -> T.StructType:
    """Adds the columns that no earlier version has, and returns all. A column whose type
    is another than the log's is an error: its rows could not be read back."""
    known = {f.name.lower(): f for f in current(spark, log, version)}
    new = []
    for f in schema:
        old = known.get(f.name.lower())
        if old is None:
            new.append((version, len(new), f.name, f.dataType.simpleString()))
        elif old.dataType != f.dataType:
            raise ValueError(f"column {f.name}: {f.dataType.simpleString()} where the log has {old.dataType.simpleString()}")
    if new:
        spark.createDataFrame(new, _ENTRY).coalesce(1).write.mode("overwrite").json(f"{log}/entry={version}")
    return current(spark, log)
