"""Column types found in text, by a lattice that any number of files can be merged in.

A value is of one kind; a column's kinds are a set, held as bits. Sets are merged by `bit_or`,
which Spark combines in tasks first, so neither the number of files nor their order matters,
and files in which a column looks different meet in the narrowest type that holds all of it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of values by bit; a missing or empty value is of none.
INT, LONG, DOUBLE, DATE, TIME, BOOL, TEXT = (1 << i for i in range(7))
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"


def kind(c: str) -> Column:
    """Bit of a text value."""
    v = F.trim(F.col(f"`{c}`"))
    whole = v.try_cast("bigint")
    return (
        F.when(v.isNull() | (v == ""), F.lit(0))
        .when(v.rlike(r"^[+-]?[0-9]{1,18}$"), F.when(whole.between(-(1 << 31), (1 << 31) - 1), F.lit(INT)).otherwise(F.lit(LONG)))
        .when(v.rlike(_NUMBER), F.lit(DOUBLE))
        .when(v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(v, "yyyy-MM-dd").isNotNull(), F.lit(DATE))
        .when(v.rlike(_TIME) & F.try_to_timestamp(v).isNotNull(), F.lit(TIME))
        .when(F.lower(v).isin("true", "false"), F.lit(BOOL)).otherwise(F.lit(TEXT)))


def type_of(kinds: int) -> str:
    """Narrowest type for a set of kinds. Whole numbers beside fractions are doubles, days beside
    times are times; kinds that have nothing else in common are text, and so is a column without
    any value."""
    for allowed, name in ((INT, "int"), (INT | LONG, "bigint"), (INT | LONG | DOUBLE, "double"),
                          (DATE, "date"), (DATE | TIME, "timestamp"), (BOOL, "boolean")):
        if kinds and not kinds & ~allowed:
            return name
    return "string"


def data_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string" and not c.startswith("_")]


def kinds_by_file(df: DataFrame, file: str = "_source_file") -> DataFrame:
    """(file, column, kinds): the set of each file and column, for a log of what differs."""
    columns = data_columns(df)
    per = df.groupBy(F.col(file).alias("file")).agg(*[F.bit_or(kind(c)).alias(f"k{i}") for i, c in enumerate(columns)])
    return per.select("file", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"k{i}").alias("kinds")) for i, c in enumerate(columns)])))


def found_types(df: DataFrame) -> dict[str, str]:
    """Type of every text column whose name does not begin with '_'. One pass; the driver sees one row."""
    columns = data_columns(df)
    if not columns:
        return {}
    row = df.agg(*[F.bit_or(kind(c)).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    return {c: type_of(row[i] or 0) for i, c in enumerate(columns)}


def cast_to(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One cast per column. Empty text becomes NULL where the type is another; a value that does
    not fit the type given becomes NULL too, and cannot occur with types found in the same rows."""
    def one(c: str) -> Column:
        name = F.col(f"`{c}`")
        if types.get(c, "string") == "string":
            return name
        return F.nullif(F.trim(name), F.lit("")).try_cast(types[c]).alias(c)
    return df.select(*map(one, df.columns))


def narrowed(df: DataFrame) -> DataFrame:
    """The frame with the types found in it."""
    return cast_to(df, found_types(df))
