"""Helpers shared by the operators of this folder: stored steps, text buffers, word hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.session import scratch

#: White space that separates words and lines up copies: blank, tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of a word from which on it has a hash of its own; shorter ones share prefix sums.
LONG_WORD = 128


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The frame written to the shared folder and read again: later steps neither repeat its
    work nor depend on an executor that may be lost."""
    path = scratch(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path) if not partition_by \
        else df.sparkSession.read.parquet(path)
    out.stored_in = path
    return out


def forget(*frames: DataFrame) -> None:
    """Removes the folders of stored frames that no later step reads."""
    for df in frames:
        remove(df.sparkSession, df.stored_in)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many '_' before it as no column of the frame has (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


#: Bits of a filter per key, and the most bits it may have: 16 MB, whatever the number of keys.
KEY_BITS = 16
MOST_BITS = 1 << 27
_WORD = 15  # Spark's bitmaps have 2**15 bits


def may_have(df: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """The rows of `df` whose `columns` may be among those of `keys`: all that are, and few
    others, so that a join that follows does not send every row through an exchange.

    `keys` is counted and then turned into a bitmap by hash, which is sent to all tasks. Its
    size is bounded; with more keys than it is made for, more of the other rows stay.
    """
    n = max(1, keys.count())
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(_WORD, (KEY_BITS * n - 1).bit_length()))
    place, word, field = free(df, "key_place", "key_word", "key_bits")
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(bits))
    bitmap = keys.select(own.alias(place)).groupBy(F.shiftright(place, _WORD).alias(word)).agg(
        F.bitmap_construct_agg(F.col(place).bitwiseAND((1 << _WORD) - 1)).alias(field))
    bit = F.col(place).bitwiseAND((1 << _WORD) - 1)
    byte = F.conv(F.hex(F.substring(F.col(field), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return (df.withColumn(place, own).withColumn(word, F.shiftright(place, _WORD))
            .join(F.broadcast(bitmap), word).where(F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1)
            .select(*[F.col(f"`{c}`") for c in df.columns]))


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about `limit` bytes of `column`, one row at least. The
    arrays made of a slice take some thirty times its size, so slices are small; what the last
    batch took is given back, as a worker may stay idle for long afterwards."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0)
                     .to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Returns freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, one after the other, and where each begins (and the
    last ends). A null counts as the empty text."""
    empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
    column = pc.fill_null(column, empty).cast(pa.large_binary())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (a bijection)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Distinct values in order. Sorts, which is several times faster here than hashing them."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n, kept for the next call."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length()) if n else 1 << 16
        both = []
        for base in (BASE, INVERSE):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            both.append(np.cumprod(steps))
        have = _powers[0] = (both[0], both[1])
    return have[0][:n], have[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums by which any stretch of bytes is hashed; see `stretch`."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


def stretch(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from start to end; equal bytes have equal hashes."""
    inverse = powers(len(sums))[1]
    h = (sums[end] - sums[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64) * GOLDEN)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased, cut at white space) and the index of its document."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = _LOWER[data]
    space = _SPACES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, space[1:]
    start = np.flatnonzero(~space & (before | edge[:-1]))
    end = np.flatnonzero(~space & (after | edge[1:])) + 1
    found = stretch(prefix_sums(data), start, end)
    # Sums modulo 2**64 agree for some long words that differ; those are hashed apart.
    for i in np.flatnonzero(end - start > LONG_WORD):
        found[i] = xxhash.xxh64_intdigest(data[start[i]:end[i]].tobytes())
    return found, np.searchsorted(at, start, "right") - 1
