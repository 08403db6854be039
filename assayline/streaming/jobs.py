"""File-following ingest, streaming cleaning and streaming counts.

All jobs use `availableNow`: they take what is new since their checkpoint and stop.
Output, checkpoint and source folders must be shared by all executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayline.operators.latest import keep_any, keep_any_within
from assayline.operators.rules import expect
from assayline.plans.silver import ENTITIES, EXPECTATIONS
from assayline.sources import schema_log, tables
from assayline.sources.files import Source, escaped, file_log_of, ingest

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, source: Source, folder: str,
              files_per_batch: int = 1000) -> DataFrame:
    """Stream of the paths of files not seen before. The content is not read: only
    the path is selected, and the scan is pruned to it."""
    return (
        spark.readStream.format("binaryFile").schema(_FILES)
        .option("recursiveFileLookup", True).option("pathGlobFilter", source.pattern)
        .option("maxFilesPerTrigger", files_per_batch).load(folder).select("path"))


def bronze(spark: SparkSession, source: Source, folder: str, out: str, checkpoint: str,
           files_per_batch: int = 1000) -> StreamingQuery:
    """Ingests new files into a Parquet folder, whatever headers they have.

    A stream has one fixed schema, so the stream carries file names, at most
    `files_per_batch` of them, and each micro-batch reads its files as a batch:
    header by header, extra columns rescued. A micro-batch owns one sub-folder and
    replaces it, so a repeated micro-batch leaves no rows twice. Columns that are new
    go to the schema log beside the checkpoint before the rows are written.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [escaped(r["path"]) for r in batch.toLocalIterator()]
        if paths:
            rows = ingest(batch.sparkSession, source, paths)
            schema_log.extend(batch.sparkSession, schema_of(checkpoint), batch_id, rows.schema)
            rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (new_files(spark, source, folder, files_per_batch).writeStream
            .foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def schema_of(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-schema"


def read_bronze(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """Everything ingested so far, under the columns of the schema log: files are opened
    for their rows alone. Files that lack a column give NULL."""
    return spark.read.schema(schema_log.current(spark, schema_of(checkpoint))).parquet(out).drop("batch")


def stream_of(spark: SparkSession, folder: str, pattern: str = "*.parquet",
              schema=None) -> DataFrame:
    """Parquet files of a folder as a stream. The schema is taken from the files that
    are there unless given."""
    if schema is None:
        schema = (spark.read.option("pathGlobFilter", pattern)
                  .option("recursiveFileLookup", True).parquet(folder).schema)
    return (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).parquet(folder))


def clean(stream: DataFrame, entity: str, within: str | None = None,
          expectations: bool = True) -> DataFrame:
    """Stream form of the cleaning: same functions, expectations, one row per key.

    Which row of a key stays is the first to arrive. Without `within` the state
    holds every key ever seen; with it, a watermark on the ingest time bounds the
    state and copies further apart stay.
    """
    e = ENTITIES[entity]
    df = e.clean(stream)
    if expectations:
        df = expect(df, **EXPECTATIONS[entity], observation=f"expectations_{entity}")
    if within:
        return keep_any_within(df, [e.key], "_ingest_time", within)
    return keep_any(df, [e.key])


def file_counts(stream: DataFrame, entity: str) -> DataFrame:
    return file_log_of(stream, entity)


def run(df: DataFrame, out: str, checkpoint: str) -> None:
    """Appends to a Parquet folder until the source is exhausted."""
    q = (df.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_changes(df: DataFrame, out: str, checkpoint: str, fold_every: int = 50,
                keys: Sequence[str] = ()) -> None:
    """For aggregates: each micro-batch adds the rows of the keys it changed as a run of its
    own (`tables.read_newest` gives the whole result). What a reader finds is always whole,
    a repeated micro-batch leaves nothing twice, and no more is written than has changed.
    With `keys`, every `fold_every` micro-batches the runs are folded into one."""
    def write(batch: DataFrame, batch_id: int) -> None:
        tables.append_once(batch, out, f"batch-{batch_id}", batch_id)
        if keys and batch_id % fold_every == fold_every - 1:
            tables.fold_newest(batch.sparkSession, out, keys)

    q = (df.writeStream.foreachBatch(write).outputMode("update")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def newest(stream: DataFrame, key: str, time: str = "_ingest_time", source: str = "_source_file") -> DataFrame:
    """Stream form of `latest.keep_latest`: the state holds the newest row of each key, in the
    same total order as in a batch, and gives it out again whenever it is replaced. So the
    stored result does not depend on the order in which rows arrive. Rows without a key are
    left out, as no state could tell them apart; write them with `run`.

    `run_changes` stores the result; a row is (key, the other columns).
    """
    rest = [c for c in stream.columns if c != key]
    values = [c for c in rest if c not in (time, source)]
    order = []
    if time in rest:
        order += [F.col(time).isNull().alias("t0"), (-F.unix_micros(F.col(time).cast("timestamp"))).alias("t1")]
    if source in rest:
        # letters turned round, with an end behind all of them: the greatest text comes first
        turned = F.concat(F.translate(F.hex(source), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))
        order += [F.col(source).isNull().alias("s0"), turned.alias("s1")]
    best = F.min(F.struct(*order, *values, *[c for c in (time, source) if c in rest]))
    return (stream.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("_best"))
            .select(key, *[F.col(f"_best.`{c}`").alias(c) for c in rest]))
