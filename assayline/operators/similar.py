"""Exact cosine top-k of documents for a set of query vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from assayline.contracts import TOP_K
from assayline.session import salt_count

QUERIES_PER_PASS = 1024  # query vectors of a block
DOCS_PER_BLOCK = 4096
HELD_QUERIES = 1 << 16  # queries whose best rows a task holds before it passes them on
RANK_DECIMALS = 9  # scores closer than this are a tie, which the id decides


def cosine_top_k(queries: DataFrame, documents: DataFrame, k: int = TOP_K,
                 query_id: str = "query_id", query_vector: str = "vector",
                 doc_id: str = "doc_id", doc_vector: str = "vector",
                 per_pass: int = QUERIES_PER_PASS) -> DataFrame:
    """(query_id, doc_id, confidence, position) of the k nearest documents.

    Queries and documents are laid out in blocks, one row each, on the executors; neither
    is counted or collected. A document block goes to one salt and the query blocks to
    all, so every task multiplies its share of the documents with all queries, block by
    block, keeps k rows per query, and the ranks are settled in two rounds: within a task
    group, then per query. Query blocks are sent to all tasks instead if Spark knows them
    to be small.

    A vector that is null or has a null, NaN or infinite element is no query and no
    document; vectors of different lengths have nothing in common; a vector of zeros has
    similarity 0 with everything.
    """
    salts = salt_count(documents.sparkSession)
    q = _blocks(queries, query_id, query_vector, per_pass, "q")
    d = _blocks(documents, doc_id, doc_vector, DOCS_PER_BLOCK, "d")
    q = q.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    d = d.withColumn("salt", F.pmod(F.xxhash64("d_data"), F.lit(salts)).cast("int"))
    pairs = d.join(q, ["salt", "width"]).select("width", "q_ids", "q_data", "d_ids", "d_data")
    schema = T.StructType([T.StructField("q", queries.schema[query_id].dataType),
                           T.StructField("d", documents.schema[doc_id].dataType),
                           T.StructField("confidence", T.DoubleType())])
    found = pairs.mapInArrow(_best(k, schema), schema)
    order = [F.col("confidence").desc(), F.col("d").asc()]
    local = Window.partitionBy("q", "task").orderBy(*order)
    final = Window.partitionBy("q").orderBy(*order)
    return (
        found.withColumn("task", F.pmod(F.spark_partition_id(), F.lit(256)))
        .withColumn("position", F.row_number().over(local)).filter(F.col("position") <= k)
        .withColumn("position", F.row_number().over(final)).filter(F.col("position") <= k)
        .select(F.col("q").alias(query_id), F.col("d").alias(doc_id), "confidence", "position"))


def sound(x: str | Column) -> Column:
    """Whether a vector has a cosine: not null, and no element null, NaN or infinite."""
    x = F.col(x) if isinstance(x, str) else x
    return x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))


def _blocks(df: DataFrame, id_col: str, vector: str, size: int, name: str) -> DataFrame:
    """Rows (width, ids, data): at most `size` unit vectors of one length, as bytes."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("x")).filter(sound("x"))
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("width", T.IntegerType()), T.StructField(f"{name}_ids", T.ArrayType(kind)),
                           T.StructField(f"{name}_data", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.array([len(v) for v in batch.column(1)], np.int32)
            for width in np.unique(widths):
                own = np.flatnonzero(widths == width)
                for at in range(0, len(own), size):
                    part = batch.take(pa.array(own[at:at + size]))
                    flat = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                    ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([width], pa.int32()), ids, pa.array([_unit(flat).tobytes()], pa.binary())],
                        names=schema.names)

    return rows.mapInArrow(run, schema)


def _best(k: int, schema: T.StructType):
    """Of pairs of blocks, the k best documents of each query among those a task has seen."""
    q_type, d_type = (to_arrow_type(schema[c].dataType) for c in ("q", "d"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def out() -> pa.RecordBatch:
            q = [i for i, (_, names) in held.items() for _ in range(len(names))]
            names = [n for _, own in held.values() for n in own.tolist()]
            scores = np.concatenate([s for s, _ in held.values()]) if held else np.empty(0)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(q, q_type), pa.array(names, d_type), pa.array(scores)],
                                              names=["q", "d", "confidence"])

        for batch in batches:
            for i in range(batch.num_rows):
                width, q_ids, q_data, d_ids, d_data = (batch.column(c)[i].as_py() for c in range(5))
                q_rows, d_rows = (np.frombuffer(x).reshape(-1, width) for x in (q_data, d_data))
                scores = np.round(d_rows @ q_rows.T, RANK_DECIMALS)
                names = np.array(d_ids, object if isinstance(d_ids[0], str) else None)
                for j, query in enumerate(q_ids):
                    top = _top(scores[:, j], names, k)
                    score, name = scores[top, j], names[top]
                    if query in held:
                        score, name = np.concatenate([held[query][0], score]), np.concatenate([held[query][1], name])
                        top = _top(score, name, k)
                        score, name = score[top], name[top]
                    held[query] = score, name
                if len(held) > HELD_QUERIES:
                    yield out()
        yield out()

    return run


def _top(scores: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k best scores; among equal scores the smallest names."""
    if len(scores) <= k:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > edge)
    level = np.flatnonzero(scores == edge)
    level = level[np.argsort(names[level], kind="stable")]
    return np.concatenate([above, level[: k - len(above)]])


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)
