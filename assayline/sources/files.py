"""Raw files into bronze frames: all values as text, with provenance."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline import contracts as K
from assayline.operators.rules import union_all
from assayline.sources import prefix
from assayline.sources.prefix import BOM
from assayline.sources.types import narrowed

RESCUED = "_rescued_data"
ODD_RECORD, BEYOND = "_odd_record_text", "_value_beyond_names"


@dataclass(frozen=True)
class Source:
    """Where the files of one entity lie and how to read them."""

    entity: str
    fmt: str  # csv or json
    pattern: str
    columns: tuple[str, ...] | None = None  # declared columns; others are rescued
    drop_ghosts: bool = True
    options: Mapping[str, str] = field(default_factory=dict)


SOURCES = {
    name: Source(name, "json" if name == "claims" else "csv", K.FILE_PATTERNS[name],
                 K.RAW_COLUMNS[name])
    for name in K.FILE_PATTERNS
}


def ingest(spark: SparkSession, source: Source, paths: str | Sequence[str],
           infer_types: bool = False, label_pattern: str = K.LABEL_PATTERN) -> DataFrame:
    """Bronze frame of one entity: the files of a folder tree, or a list of files.

    With `infer_types` every column gets the narrowest type that all its files allow
    (`sources.types`; for JSON, as Spark merges the types of its values); without, all
    values stay text.
    """
    if source.fmt == "json":
        df = read_json(spark, source, paths, infer_types)
    else:
        df = read_csv(spark, source, paths)
        df = narrowed(df) if infer_types else df
    df = with_provenance(df, label_pattern)
    return drop_ghost_rows(df) if source.drop_ghosts else df


def _reader(spark: SparkSession, source: Source, listed: bool):
    r = spark.read.options(**source.options)
    if not listed:
        r = r.option("recursiveFileLookup", True).option("pathGlobFilter", source.pattern)
    return r


# --- headers ----------------------------------------------------------------
def header_lines(spark: SparkSession, source: Source, paths: str | Sequence[str]) -> DataFrame:
    """(path, header): first line of each file that is not blank, NULL if there is none.

    The files are listed, not read, and tasks open each for a prefix as long as its
    header. Files in a store that only Spark can open, and packed ones other than
    gzip, are read as text instead.
    """
    listed = not isinstance(paths, str)
    files = (_reader(spark, Source(source.entity, source.fmt, source.pattern), listed)
             .format("binaryFile").load(list(paths) if listed else paths).select("path"))
    options = dict(source.options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [prefix.first_line(p, options) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([h for h, _ in found], pa.string()),
                 pa.array([opened for _, opened in found], pa.bool_())], ["path", "header", "opened"])

    return files.mapInArrow(run, "path string, header string, opened boolean")


def headers(spark: SparkSession, source: Source, paths: str | Sequence[str]) -> dict[str, list[str]]:
    """Distinct headers and the files that have them. Files are grouped on the
    executors; the driver holds their names, as it does for any read."""
    rows = header_lines(spark, source, paths).groupBy("header", "opened").agg(
        F.collect_list("path").alias("paths")).toLocalIterator()
    groups: dict[str, list[str]] = {}
    closed: list[str] = []
    for r in rows:
        if not r["opened"]:
            closed += r["paths"]
        elif r["header"] is not None:
            groups.setdefault(r["header"], []).extend(map(escaped, r["paths"]))
    if closed:
        text = _reader(spark, source, True).text([escaped(p) for p in closed])
        first = (text.select("value", F.col("_metadata.file_path").alias("path"),
                             F.col("_metadata.file_block_start").alias("start"),
                             F.monotonically_increasing_id().alias("at"))
                 .filter("start = 0 and trim(value) != ''")
                 .groupBy("path").agg(F.min_by("value", "at").alias("header")))
        for r in first.toLocalIterator():
            groups.setdefault(r["header"].lstrip(BOM), []).append(_as_path(r["path"]))
    return groups


# --- CSV --------------------------------------------------------------------
def read_csv(spark: SparkSession, source: Source, paths: str | Sequence[str]) -> DataFrame:
    """CSV files whose headers differ, as one frame.

    Spark gives all files of a read the names of the first, so files are grouped
    by header, each group is read with its own names, and the groups are united by
    name with NULL for absent columns. What the names have no place for is rescued:
    columns that are not declared, values beyond the last name (as `_c` and their
    place from 0), and records whose quotes do not close (as `_corrupt_record`).
    """
    groups = headers(spark, source, paths)
    if not groups:
        names = list(source.columns or ())
        return spark.createDataFrame([], T.StructType(
            [T.StructField(c, T.StringType()) for c in names] +
            [T.StructField(RESCUED, T.StringType()), T.StructField("_source_file", T.StringType())]))
    frames = []
    for header, files in sorted(groups.items()):
        names = _names(header, source.options.get("sep", ","))
        # With one column more than there are names every record is an odd one to the
        # parser, which then hands over its text as well; only a record with just one
        # value too many fits, and that value is in the column.
        fields = [T.StructField(n, T.StringType()) for n in (*names, BEYOND, ODD_RECORD)]
        df = (spark.read.options(**source.options).option("header", True)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", ODD_RECORD)
              .schema(T.StructType(fields)).csv(files))
        df = df.select("*", F.col("_metadata.file_path").alias("_source_file"))
        frames.append(_rescue(df, source.columns, surplus_values(names, source.options)))
    return union_all(frames, allow_missing=True)


def surplus_values(names: Sequence[str], options: Mapping[str, str]) -> Column:
    """Map of what one CSV record has beyond its names; NULL without.

    A record with an open quote is kept as a whole; otherwise the values after the
    last name are, each without its quotes, but for empty ones. A record with too few
    values has nothing to rescue. The text is taken apart only where it has enough
    separators for a value too many.
    """
    sep, quote = options.get("sep", ","), options.get("quote", '"')
    escape = options.get("escape", "\\")
    record = F.col(ODD_RECORD)
    q, e, s = (re.escape(x) for x in (quote, escape, sep))
    if quote:
        inside = f"[^{q}{e}]*+" if quote != escape else f"[^{q}]*+"
        pair = f"{e}.|{q}{q}" if quote != escape else f"{q}{q}"
        token = f"(?:^|{s})({q}{inside}(?:(?:{pair}){inside})*+{q}(?={s}|$)|(?!{q}).*?(?={s}|$))"
        # With pairs taken out, an odd number of quotes is left if one is open.
        bare = F.regexp_replace(record, f"(?s){e}." if quote != escape else q + q, "")
        open_quote = record.contains(quote) & ((F.length(bare) - F.length(F.replace(bare, F.lit(quote)))) % 2 == 1)
    else:
        token, open_quote = f"(?:^|{s})(.*?)(?={s}|$)", F.lit(False)
    values = F.regexp_extract_all(record, F.lit("(?s)" + token), F.lit(1))
    separators = (F.length(record) - F.length(F.replace(record, F.lit(sep)))) / len(sep)

    def plain(v: Column) -> Column:
        if not quote:
            return v
        return F.when((F.length(v) > 1) & v.startswith(quote) & v.endswith(quote), F.regexp_replace(
            v.substr(F.lit(2), F.length(v) - 2), f"{e}({q})|{q}({q})", "$1$2")).otherwise(v)

    def places(found: Column) -> Column:
        """The values after the last name, with their places."""
        every = F.transform(found, lambda v, i: F.struct(
            F.concat(F.lit("_c"), i.cast("string")).alias("key"), plain(v).alias("value"), i.alias("i")))
        return F.filter(every, lambda p: (p["i"] >= len(names)) & (p["value"] != ""))

    many = F.transform(places(values), lambda p: F.struct(p["key"], p["value"]))
    return (F.when(open_quote, F.create_map(F.lit("_corrupt_record"), record))
            .when(separators >= len(names), F.map_from_entries(many))
            .when(record.isNull() & F.col(BEYOND).isNotNull(),
                  F.create_map(F.lit(f"_c{len(names)}"), F.col(BEYOND))))


# --- JSON -------------------------------------------------------------------
#: A line end that no JSON text has, in UTF-8, UTF-16 or UTF-32.
_NO_LINE_END = "\0" * 8


def _whole(reader, options: Mapping[str, str]):
    """Reader that takes each file as one JSON text.

    With `multiLine` Spark parses a stream, and goes back to the file with a read of its own
    for every number that is to be text as it stands there. A file read as one line is parsed
    in memory, and number texts are cut out of that. A file may then have 2 GB at most, all
    rows of which a task holds either way. Options that name an encoding or a line end are
    left to `multiLine`; files in UTF-16 or UTF-32 that hold numbers need the encoding named.
    """
    if {o.lower() for o in options} & {"encoding", "charset", "linesep"}:
        return reader.option("multiLine", True)
    return reader.option("multiLine", False).option("lineSep", _NO_LINE_END)


def read_json(spark: SparkSession, source: Source, paths: str | Sequence[str],
              infer_types: bool = False) -> DataFrame:
    """JSON files, one array (or object) per file, or one object per line with `multiLine` off.

    Lines with declared columns are read once, as text, and parsed into these; names
    that differ in case alone are found too. Other fields are rescued, and so is a line
    that is no object. In all other cases fields (and types, if they are to be inferred)
    are found in a pass of their own.
    """
    listed = not isinstance(paths, str)
    many = str(source.options.get("multiLine", True)).lower() == "true"
    target = list(paths) if listed else paths
    if source.columns is None or infer_types or many:
        reader = _reader(spark, source, listed)
        reader = _whole(reader, source.options) if many else reader.option("multiLine", False)
        df = reader.option("primitivesAsString", not infer_types).json(target)
        df = _rescue(df.select("*", F.col("_metadata.file_path").alias("_source_file")), source.columns)
        have = {c.lower() for c in df.columns}
        absent = [c for c in (source.columns or ()) if c.lower() not in have]
        return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df
    text = _reader(spark, source, listed).text(target).select(
        F.col("value").alias("_json"), F.col("_metadata.file_path").alias("_source_file"))
    return json_columns(text.filter("trim(_json) != ''"), source.columns)


#: Numbers that the parser writes anew: with a fraction or an exponent.
_WRITTEN = r"^-?[0-9.]+(E-?[0-9]+)?$"


def json_columns(text: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Declared columns of the objects in `_json` as text, and all else in the rescued one."""
    extra = F.array_except("_keys", F.array(*map(F.lit, columns)))
    parsed = text.withColumn("_keys", F.json_object_keys("_json")).withColumns({
        "_value": F.from_json("_json", T.StructType([T.StructField(c, T.StringType()) for c in columns])),
        "_extra": F.when(F.size(extra) > 0, F.map_filter(
            F.from_json("_json", "map<string,string>"), lambda k, v: F.array_contains(extra, k)))})
    alike = F.array(*[F.lit(c.lower()) for c in columns])
    parsed = parsed.withColumn("_alike", F.map_entries(
        F.map_filter("_extra", lambda k, v: F.array_contains(alike, F.lower(k)))))
    rest = F.map_filter("_extra", lambda k, v: ~F.array_contains(alike, F.lower(k)) & v.isNotNull())
    broken = F.when(F.col("_keys").isNull(), F.create_map(F.lit("_corrupt_record"), F.col("_json")))
    kept = F.coalesce(broken, F.when(F.size(rest) > 0, rest))

    def value(c: str) -> Column:
        own = F.filter("_alike", lambda e: F.lower(e["key"]) == c.lower())
        v = F.coalesce(F.col(f"_value.`{c}`"),
                       F.when(F.size("_alike") > 0, F.try_element_at(own, F.lit(1))["value"]))
        # A number as the file has it, if what stands after the name is the same number.
        found = F.regexp_extract_all("_json", F.lit('(?i)"' + re.escape(c) + r'"\s*:\s*(-?[0-9][0-9.eE+-]*)'), F.lit(1))
        same = F.filter(found, lambda n: n.try_cast("double") == v.try_cast("double"))
        fraction = (v.contains(".") | v.contains("E")) & v.rlike(_WRITTEN)
        return F.when(fraction, F.coalesce(F.try_element_at(same, F.lit(1)), v)).otherwise(v).alias(c)

    return parsed.select(*map(value, columns), "_source_file", F.to_json(kept).alias(RESCUED))


def _names(header: str, sep: str) -> list[str]:
    return [n.strip() or f"_c{i}" for i, n in enumerate(next(csv.reader(io.StringIO(header),
                                                                        delimiter=sep)))]


def _as_path(uri: str) -> str:
    """File URI as the path a reader takes."""
    return escaped(unquote(uri))


def escaped(path: str) -> str:
    """Path whose characters do not count as a pattern."""
    return "".join("\\" + ch if ch in "{}[]*?" else ch for ch in path)


def _rescue(df: DataFrame, declared: Iterable[str] | None, more: Column | None = None) -> DataFrame:
    """Columns outside the declared ones, and the map `more`, become one JSON text; NULL
    if all are NULL. Without declared columns only `more` is rescued."""
    known = None if declared is None else {c.lower() for c in declared}
    inner = ("_source_file", ODD_RECORD, BEYOND)
    extra = [] if known is None else [c for c in df.columns if c.lower() not in known and c not in inner]
    own = F.filter(F.array(*[F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value")) for c in extra]),
                   lambda e: e["value"].isNotNull()) if extra else None
    empty = F.create_map().cast("map<string,string>")
    maps = [F.coalesce(m, empty) for m in (None if own is None else F.map_from_entries(own), more) if m is not None]
    packed = F.lit(None).cast("string")
    if maps:
        joined = F.map_concat(*maps) if len(maps) > 1 else maps[0]
        packed = F.when(F.size(joined) > 0, F.to_json(joined))
    return df.withColumn(RESCUED, packed).drop(*extra, ODD_RECORD, BEYOND)


def with_provenance(df: DataFrame, label_pattern: str = K.LABEL_PATTERN) -> DataFrame:
    """Adds ingest time and the label found in the path; '' without a match."""
    uri = F.col("_source_file")
    file = F.coalesce(F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), uri)
    return df.withColumns({
        "_source_file": file,
        "_ingest_time": F.current_timestamp(),
        "_source_region": source_label(file, label_pattern)})


def source_label(file, pattern: str = K.LABEL_PATTERN) -> Column:
    return F.regexp_extract(file, pattern, 0)


def drop_ghost_rows(df: DataFrame) -> DataFrame:
    """Without the rows in which every data column is NULL and nothing was rescued.

    Store the result before renaming many columns: the optimizer restates a filter
    for every combination of old and new names.
    """
    data = [F.col(f"`{c}`").cast("string") for c in df.columns if not c.startswith("_") or c == RESCUED]
    return df.filter(F.coalesce(*data).isNotNull()) if data else df


def file_log(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """One row per file: entity, names, rows, first and last ingest."""
    return union_all(file_log_of(df, entity) for entity, df in bronze.items())


def file_log_of(df: DataFrame, entity: str) -> DataFrame:
    """Works on a stream too, where the counts grow with each micro-batch."""
    return (
        df.groupBy("_source_file", "_source_region")
        .agg(F.count(F.lit(1)).alias("row_count"),
             F.min("_ingest_time").alias("first_ingested_at"),
             F.max("_ingest_time").alias("last_seen_at"))
        .select(
            F.lit(entity).alias("entity"),
            F.regexp_extract("_source_file", K.FILE_NAME_PATTERN, 1).alias("file_name"),
            F.regexp_extract("_source_file", K.FILE_FORMAT_PATTERN, 1).alias("file_format"),
            "_source_file", "_source_region", "row_count", "first_ingested_at", "last_seen_at",
            F.lit("processed").alias("status")))
