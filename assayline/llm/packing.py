"""Best-fit packing planned on the histogram of lengths.

Documents become tokens and pieces of at most one sequence. How many pieces have each length
is all the plan needs: best-fit, longest first, places counts of equal pieces into counts of
equal sequences. A piece then finds its place by its rank among the pieces of its length.
Ranks need no sort: a task numbers its pieces per length, and sums over tasks shift them.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayline.llm.common import pieces, stored

CAPACITY = 1024
END = 2


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(2)
def encoder(path: str):
    """Byte-level encoder from a file of ranks; its ids are those of the JSON form of the
    same vocabulary (a test compares them). Special strings in a text are their token."""
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={"<|endoftext|>": len(ranks)})


def ids_of(encode, text: str) -> np.ndarray:
    if not text:
        return np.empty(0, np.uint32)
    return np.asarray(encode.encode(text, allowed_special="all") if "<|endoftext|>" in text
                      else encode.encode_ordinary(text), np.uint32)


CUT = "doc_id long, piece int, start long, length long, ids_crc32 long, lane int, place long"


def cutter(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        lane = TaskContext.get().partitionId()
        encode = encoder(path)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                out: list[tuple] = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(ids_of(encode, text or ""), np.uint32(END)).astype("<u4")
                    stop = (len(ids) - 1) % capacity + 1
                    start = k = 0
                    while start < len(ids):
                        n = stop - start
                        out.append((doc, k, start, n, zlib.crc32(ids[start:stop].tobytes()), lane, int(seen[n])))
                        seen[n] += 1
                        start, stop, k = stop, stop + capacity, k + 1
                columns = list(zip(*out))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "lane", "place"])
    return run


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Slots for `counts` pieces of each length: (length, first rank, first sequence, offset).

    From that rank on, up to the next entry of the length, the pieces take consecutive
    sequences at the same offset. Longest lengths first; a length goes to the open sequences
    with the least room that holds it, as many at once as are alike, and to new ones after that.
    """
    room: dict[int, list[list[int]]] = {}  # room left -> runs of sequences [first, how many]
    open_: list[int] = []
    slots, sequences = [], 0

    def put(left: int, first: int, n: int) -> None:
        if left:
            if left not in room:
                room[left] = []
                insort(open_, left)
            room[left].append([first, n])

    for length in sorted(counts, reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            k = bisect_left(open_, length)
            if k == len(open_):
                # None has room: new sequences, each filled with all pieces it can hold.
                per = capacity // length
                full, rest = divmod(todo, per)
                for n, held in ((full, per), (1 if rest else 0, rest)):
                    if n:
                        for i in range(held):
                            slots.append((length, rank, sequences, i * length))
                            rank += n
                        put(capacity - held * length, sequences, n)
                        sequences += n
                break
            left = open_[k]
            run = room[left].pop()
            if not room[left]:
                del room[left]
                open_.pop(k)
            m = min(todo, run[1])
            slots.append((length, rank, run[0], capacity - left))
            rank, todo = rank + m, todo - m
            if m < run[1]:
                put(left, run[0] + m, run[1] - m)
            put(left - length, run[0], m)
    return slots


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its tokens and an end token (a null text: the end token alone). Longer ones
    are cut into pieces of `capacity`, of which the first may be shorter. Rows that share an
    id are documents of their own. An empty table gives no rows; other columns are not read.
    The histogram (at most `capacity` rows) and the plan, whose size depends on the lengths
    that occur and not on how many documents there are, are all that the driver sees.
    """
    spark = docs.sparkSession
    cut = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                 .mapInArrow(cutter(path or vocabulary_path(), capacity), CUT), "pack-pieces")
    lanes = stored(cut.groupBy("lane", "length").agg(F.count("*").alias("n")), "pack-lanes")
    counts = {r["length"]: r["n"] for r in lanes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = np.array(plan(counts, capacity), np.int64).reshape(-1, 4)
    order = np.lexsort((slots[:, 1], slots[:, 0]))
    shared = spark.sparkContext.broadcast(slots[order])
    line = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    shifts = lanes.select("lane", "length", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("shift"))
    ranked = cut.join(shifts, ["lane", "length"]) \
        .withColumn("rank", F.col("place") + F.col("shift")) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        lengths, firsts = slots[:, 0], slots[:, 1]
        low = {int(n): (int(np.searchsorted(lengths, n)), int(np.searchsorted(lengths, n, "right")))
               for n in np.unique(lengths)}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            k = np.empty(len(length), np.int64)
            for n in np.unique(length):
                a, b = low[int(n)]
                own = length == n
                k[own] = a + np.searchsorted(firsts[a:b], rank[own], "right") - 1
            sequence = slots[k, 2] + rank - firsts[k]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(sequence), pa.array(slots[k, 3])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
