"""Centroid clustering of integer vectors by scalar lookup tables.

Vectors are turned into integers once and laid out in blocks of at most BLOCK vectors: per
dimension the integers that occur in the block, sorted, and for each vector the index of its own.
A round tabulates, per block, dimension and occurring integer, the squared difference to every
centroid; the distances of the block are gathers from these tables and their sums. All arithmetic
is on integers: 64-bit ones where no distance of the block can pass them, Python's own where one
could. A task hands on a sum per centroid and dimension, cut into digits of 2**40 so that Spark
can add them up without overflow; the driver sees those of the centroids alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import forget, stored

#: Fixed production parameters: components of a vector, factor before flooring, centroids,
#: rounds, start of the text whose hash orders the vectors that centroids begin as.
WIDTH = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SALT = "3:"
#: Vectors of a block; also the most entries of a table per dimension and centroid.
BLOCK = 4096
DIGIT = 40
LONG = (1 << 63) - 1
BLOCKS = "ids array<bigint>, codes binary, sizes binary, occurring array<string>, data binary"
NAMES = ["ids", "codes", "sizes", "occurring", "data"]


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of all components, a row per vector; Python integers if any passes 2**60."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width) * scale)
    if not len(x) or np.abs(x).max() < 2**60:
        return x.astype(np.int64)
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def encoded(ids: pa.Array, values: np.ndarray) -> pa.RecordBatch:
    """One block: the integers that occur per dimension, and each vector's index among them."""
    codes, sizes, occurring = [], [], []
    for column in values.T:
        own, at = np.unique(column, return_inverse=True)
        codes.append(at.astype(np.uint16))
        sizes.append(len(own))
        occurring.append(own)
    large = values.dtype == object
    return pa.RecordBatch.from_arrays([
        pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([np.stack(codes).tobytes()], pa.binary()),
        pa.array([np.array(sizes, np.int32).tobytes()], pa.binary()),
        pa.array([[str(v) for own in occurring for v in own] if large else None], pa.list_(pa.string())),
        pa.array([None if large else np.concatenate(occurring).tobytes()], pa.binary())], NAMES)


def blocks(width: int, scale: int, block: int):
    """Lays vectors out in blocks, which do not reach past the end of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                own = batch.slice(start, block)
                yield encoded(own.column(0), integers(own.column(1), width, scale))
    return run


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row, so that one block at a time is taken apart."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


class Block:
    """A stored block, read back."""

    def __init__(self, row: dict):
        sizes = np.frombuffer(row["sizes"], np.int32)
        flat = np.frombuffer(row["data"], np.int64) if row["occurring"] is None \
            else np.array([int(v) for v in row["occurring"]], object)
        self.occurring = np.split(flat, np.cumsum(sizes)[:-1])
        self.codes = np.frombuffer(row["codes"], np.uint16).reshape(len(sizes), -1)

    def nearest(self, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (the smallest of equals) and the squared distance."""
        width = len(self.codes)
        most = max(max(abs(int(own[0])), abs(int(own[-1]))) for own in self.occurring) \
            + max(abs(v) for c in centroids for v in c)
        kind = np.int64 if width * most * most <= LONG else object
        total = np.zeros((self.codes.shape[1], len(centroids)), kind)
        for j in range(width):
            here = np.array([c[j] for c in centroids], kind)
            table = (self.occurring[j].astype(kind)[:, None] - here) ** 2
            total += table[self.codes[j]]
        number = total.argmin(axis=1)
        return number, total[np.arange(len(total)), number]

    def sums(self, number: np.ndarray, k: int) -> list[list[int]]:
        """Per centroid the sum of its vectors in every dimension."""
        out = []
        for own, at in zip(self.occurring, self.codes):
            seen = np.bincount(number * len(own) + at, minlength=k * len(own)).reshape(k, -1)
            # A block has at most 2**16 vectors, so sums of integers below 2**46 fit 64 bits.
            small = own.dtype != object and max(abs(int(own[0])), abs(int(own[-1]))) < 1 << 46
            out.append((seen @ own).tolist() if small else
                       [sum(int(n) * int(v) for n, v in zip(row[row > 0], own[row > 0])) for row in seen])
        return [list(c) for c in zip(*out)]


def digits(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a whole number in base 2**DIGIT; the sign goes with each digit."""
    sign, value, place = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield place, sign * (value & ((1 << DIGIT) - 1))
        value >>= DIGIT
        place += 1


SUMS = "cluster int, dim int, place int, digit long"


def partial_sums(centroids: list[list[int]]):
    """One round in a task: assigns its vectors and hands on sums (dim -1: how many)."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), None
        for row in rows_of(batches):
            block = Block(row)
            number, _ = block.nearest(centroids)
            count += np.bincount(number, minlength=k)
            own = block.sums(number, k)
            total = own if total is None else [[a + b for a, b in zip(x, y)] for x, y in zip(total, own)]
        if total is None:
            return
        rows = [(c, -1, p, d) for c in range(k) for p, d in digits(int(count[c]))]
        rows += [(c, j, p, d) for c in range(k) for j, v in enumerate(total[c]) for p, d in digits(v)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["cluster", "dim", "place", "digit"])
    return run


def assigned(centroids: list[list[int]]):
    """Every vector with its centroid and distance; a distance no long can hold is the largest one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            number, distance = block.nearest(centroids)
            if distance.dtype == object:
                distance = np.array([min(int(d), LONG) for d in distance], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(number.astype(np.int32)),
                                              pa.array(distance)], ["vec_id", "cluster", "distance"])
    return run


def whole(rows) -> dict[tuple[int, int], int]:
    """Whole numbers by (cluster, dim) out of summed digits."""
    out: dict[tuple[int, int], int] = {}
    for r in rows:
        key = (r["cluster"], r["dim"])
        out[key] = out.get(key, 0) + (r["digit"] << (DIGIT * r["place"]))
    return out


def clustered(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH,
              scale: int = SCALE, salt: str = SALT, id_col: str = "vec_id", vector_col: str = "embedding",
              block: int = BLOCK) -> tuple[DataFrame, list[list[int]], list[int]]:
    """(frame, centroids, inertia of each): the frame has a row per kept vector with vec_id,
    cluster and distance (squared, in integer units).

    Kept are vectors of exactly `width` components, none null, NaN or infinite; null vectors
    are not. Components become floor(scale * x), computed in double precision. Centroids begin
    as the kept vectors with the smallest SHA-256 of `salt` and id; rows without an id come
    last, and rows that share one are ordered by their components. With fewer kept vectors than
    `centroids` each of them is one; without any the frame is empty. Ties go to the smaller
    number. Each round replaces every centroid that has vectors by their mean, floored exactly;
    the others stay. Repeated rows count as often as they occur; other columns are not read.
    A scaled component beyond the range of doubles counts as not finite, and so is not kept.
    """
    if not 0 < block <= 1 << 16:
        raise ValueError("a block has 1 to 65,536 vectors")
    x = F.col("x")
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    given = given.where((F.size(x) == width) & F.forall(
        x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e * F.lit(float(scale))) != float("inf")), F.lit(False))))
    first = given.withColumn("h", F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)) \
        .orderBy(F.col("h").asc_nulls_last(), "x").limit(centroids).collect()
    now = [[int(v) for v in np.floor(np.array(r["x"]) * scale)] for r in first]
    if not now:
        return given.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], []
    laid = stored(given.mapInArrow(blocks(width, scale, block), BLOCKS), "centroid-blocks")
    coded = laid.drop("ids")
    for _ in range(rounds):
        sums = whole(coded.mapInArrow(partial_sums(now), SUMS).groupBy("cluster", "dim", "place")
                     .agg(F.sum("digit").alias("digit")).collect())
        new = [[sums.get((c, j), 0) // n for j in range(width)] if (n := sums.get((c, -1), 0)) else old
               for c, old in enumerate(now)]
        if new == now:  # further rounds would change nothing
            break
        now = new
    out = stored(laid.mapInArrow(assigned(now), "vec_id long, cluster int, distance long"), "centroid-rows")
    forget(laid)
    each = {r["cluster"]: int(r["inertia"]) for r in out.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(19,0)")).alias("inertia")).collect()}
    return out, now, [each.get(c, 0) for c in range(len(now))]
