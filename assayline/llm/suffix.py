"""Repeated passages across documents, by suffix order of shards.

A string of WINDOW bytes goes from every document but the one with the smallest id that has
it. Which strings can repeat at all is found first: the smallest hash among the 32 stretches
of 19 bytes in a window is the window's key, and keys are counted over all documents. Strings
whose key is not in two documents cannot repeat. The others are cut out with their
surroundings, each distinct one of a block once, and dealt by key, so equal windows meet in
one shard. A shard orders all suffixes of its text by external induced sorting (`induced`);
suffixes that share WINDOW bytes are neighbours, and the smallest id among them owns the
window. Blocks of documents are stored once, so every later step sees the same blocks.
"""

from __future__ import annotations

import hashlib
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import mix, pieces, prefix_sums, stored, stretch, utf8
from assayline.llm.induced import suffixes

#: A window has GRAM - 1 + 32 bytes, so each has 32 stretches of GRAM bytes.
WINDOW, GRAM = 50, 19
#: Text of a block of documents, and memory a shard's sort may take before it uses the disk.
BLOCK_BYTES = 3 << 20
SORT_BYTES = 64 << 20
NO_ID = (1 << 63) - 1


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(6).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


BLOCKS = "block long, ids binary, sizes binary, text binary"


def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    base, k = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for part in pieces(batch, "text", BLOCK_BYTES):
            data, at = utf8(part.column("text"))
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + k]), *[pa.array([x], pa.binary()) for x in (
                    ids.tobytes(), np.diff(at).astype(np.int64).tobytes(), squeeze(data.tobytes()))]],
                ["block", "ids", "sizes", "text"])
            k += 1


class Block:
    """Documents of a block and the runs of windows that share a key."""

    def __init__(self, ids: bytes, sizes: bytes, text: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.at = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
        self.text = expand(text)

    def runs(self) -> None:
        """Sets key, start (in the block), count of windows and document of every run."""
        data = np.frombuffer(self.text, np.uint8)
        n = len(data) - WINDOW + 1
        if n <= 0:
            self.key, self.start = np.empty(0, np.uint64), np.empty(0, np.int64)
            self.count = self.doc = self.start
            return
        first = np.arange(len(data) - GRAM + 1)
        least = stretch(prefix_sums(data), first, first + GRAM)
        for width in (1, 2, 4, 8, 16):
            least = np.minimum(least[:-width], least[width:])
        change = np.zeros(n + 1, np.int32)
        begin, end = self.at[:-1], np.maximum(self.at[:-1], self.at[1:] - WINDOW + 1)
        own = end > begin
        np.add.at(change, begin[own], 1)
        np.add.at(change, end[own], -1)
        valid = np.cumsum(change[:n]) > 0
        edge = np.ones(n, bool)
        edge[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
        edge[begin[own]] = True
        start = np.flatnonzero(edge)
        count = np.diff(np.append(start, n))
        keep = valid[start]
        self.start, self.count = start[keep], count[keep]
        self.key = mix(least[self.start])
        self.doc = np.searchsorted(self.at, self.start, "right") - 1

    def by_shard(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys in order, whether two documents of the block have each, and where the keys
        of every shard begin."""
        order = np.lexsort((self.doc, self.key))
        key, doc = self.key[order], self.doc[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
        last = np.append(first[1:], len(key)) - 1 if len(key) else order
        key, several = key[first], doc[first] != doc[last]
        return key, several, np.searchsorted(shard_of(key, shards), np.arange(shards + 1))

    def repeated(self, bits: list, shards: int) -> list[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
        """Runs whose key is marked by shard in `bits`: for each shard the distinct strings in order
        of appearance, the smallest id of each, and the runs (numbers) with the string of each."""
        self.runs()
        key, _, cut = self.by_shard(shards)
        marked = np.zeros(len(key), bool)
        for r in bits:
            a, b = cut[r["shard"]], cut[r["shard"] + 1]
            marked[a:b] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=b - a)
        hit = np.flatnonzero(marked[np.searchsorted(key, self.key)])
        shard = shard_of(self.key[hit], shards)
        order = np.argsort(shard, kind="stable")
        hit, shard = hit[order], shard[order]
        cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(hit) else []
        out = []
        for a, b in zip(cut, [*cut[1:], len(hit)]):
            runs = hit[a:b]
            known: dict[bytes, int] = {}
            which = np.array([known.setdefault(self.text[s:s + c + WINDOW - 1], len(known)) for s, c in zip(
                self.start[runs].tolist(), self.count[runs].tolist())])
            least = np.full(len(known), NO_ID)
            np.minimum.at(least, which, self.ids[self.doc[runs]])
            out.append((int(shard[a]), list(known), least, np.stack([runs, which])))
        return out


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def block_rows(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = [batch.column(c)[k].as_py() for c in ("block", "ids", "sizes", "text", *more)]
            yield row[0], Block(*row[1:4]), *row[4:]


def emit_keys(shards: int):
    """Distinct keys of a block by shard: six bytes of each (a shard already fixes the others'
    part), and a bit for those of two documents in the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, block in block_rows(batches):
            block.runs()
            key, several, cut = block.by_shard(shards)
            low = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            some = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), name)),
                 pa.array([low[cut[k]:cut[k + 1]].tobytes() + np.packbits(several[cut[k]:cut[k + 1]]).tobytes()
                           for k in some], pa.binary())], ["shard", "block", "data"])
    return run


def find_repeated(group: pd.DataFrame) -> pd.DataFrame:
    """For each block, which of its keys in a shard two documents have: a bit per key."""
    own, several = [], []
    for x in group["data"]:
        n = len(x) * 8 // 49
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(x, np.uint8, 6 * n).reshape(n, 6)
        own.append(wide.view("<u8").ravel())
        several.append(np.unpackbits(np.frombuffer(x, np.uint8, offset=6 * n), count=n).astype(bool))
    every = np.sort(np.concatenate(own))
    twice = np.union1d(every[1:][every[1:] == every[:-1]], np.concatenate(own)[np.concatenate(several)])
    out = []
    for shard, block, keys in zip(group["shard"], group["block"], own):
        at = np.searchsorted(twice, keys)
        at[at == len(twice)] = 0
        hit = twice[at] == keys if len(twice) else np.zeros(len(keys), bool)
        if hit.any():
            out.append((shard, block, np.packbits(hit).tobytes()))
    return pd.DataFrame(out, columns=["shard", "block", "bits"])


def emit_strings(shards: int):
    """Strings around repeated keys, by shard, each with the smallest id in the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, block, keys in block_rows(batches, "keys"):
            for shard, strings, least, _ in block.repeated(keys, shards):
                sizes = np.fromiter(map(len, strings), np.int64, len(strings))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([name]), *[pa.array([x], pa.binary()) for x in (
                        sizes.astype(np.int32).tobytes(), least.tobytes(), squeeze(b"".join(strings)))]],
                    ["shard", "block", "sizes", "ids", "data"])
    return run


def owners(text: np.ndarray, ends: np.ndarray, ids: np.ndarray, window: int, limit: int) -> np.ndarray:
    """For each place of a text of strings, the smallest id of a string that has the window
    beginning there; strings end at `ends`, each followed by a separator.

    Neighbours in suffix order that share a window form a group."""
    owner = np.full(len(text), NO_ID)
    folder = tempfile.mkdtemp(prefix="suffix-")
    try:
        for bucket in suffixes(text, folder, limit, window):
            pos = bucket["pos"]
            string = np.searchsorted(ends, pos, "right")
            fits = (string < len(ends)) & (ends[np.minimum(string, len(ends) - 1)] - pos >= window)
            if not fits.any():
                continue
            # A suffix too short to hold a window never stands between two that share one.
            group = np.cumsum(bucket["lcp"] < window)
            pos, string, group = pos[fits], string[fits], group[fits]
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            least = np.minimum.reduceat(ids[string], first)
            owner[pos] = np.repeat(least, np.diff(np.append(first, len(pos))))
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    return owner


def may_share(strings: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Strings with a window whose hash another window has as well."""
    hashes, owner = [], []
    at = 0
    while at < len(strings):
        stop = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), 2 << 20, "right")) + at)
        count = sizes[at:stop] - WINDOW + 1
        begin = np.cumsum(sizes[at:stop]) - sizes[at:stop]
        pos = np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        data = np.frombuffer(b"".join(strings[at:stop]), np.uint8)
        hashes.append(stretch(prefix_sums(data), pos, pos + WINDOW))
        owner.append(np.repeat(np.arange(at, stop), count).astype(np.int32))
        at = stop
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    every = np.sort(hashes)
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = np.zeros(len(strings), bool)
    if len(twice):
        k = np.searchsorted(twice, hashes)
        k[k == len(twice)] = 0
        out[owner[twice[k] == hashes]] = True
    return out


def sort_shard(limit: int):
    """Owners of all windows of a shard, for each block as runs of equal owners."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        known: dict[bytes, int] = {}
        least: list[int] = []
        uses = []
        for sizes, ids, data in zip(group["sizes"], group["ids"], group["data"]):
            data, which, at = expand(data), [], 0
            for n, i in zip(np.frombuffer(sizes, np.int32).tolist(), np.frombuffer(ids, np.int64).tolist()):
                k = known.setdefault(data[at:at + n], len(known))
                at += n
                which.append(k)
                if k == len(least):
                    least.append(i)
                elif i < least[k]:
                    least[k] = i
            uses.append(which)
        strings, least = list(known), np.array(least, np.int64)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        # A string all of whose windows are its own has one owner; the others are sorted.
        shares = may_share(strings, sizes)
        lengths, values = sizes - WINDOW + 1, least.copy()
        first = np.arange(len(strings))
        runs = np.ones(len(strings), np.int64)
        if shares.any():
            # Bytes become 2 to 257, 1 ends a string and 0 the text.
            part = [strings[i] for i in np.flatnonzero(shares)]
            ends = np.cumsum(sizes[shares] + 1) - 1
            text = np.frombuffer(b"\0".join(part) + b"\0\0", np.uint8).astype(np.int16) + np.int16(2)
            text[ends] = 1
            text[-1] = 0
            owner = owners(text, ends, least[shares], WINDOW, limit)
            count = lengths[shares]
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            flat = owner[np.repeat(ends - sizes[shares], count) + inner]
            edge = np.flatnonzero((inner == 0) | np.concatenate([[True], flat[1:] != flat[:-1]]))
            begin = np.searchsorted(edge, np.flatnonzero(inner == 0))
            runs[shares] = np.diff(np.append(begin, len(edge)))
            first[shares] = len(strings) + begin
            lengths = np.concatenate([lengths, np.diff(np.append(edge, len(flat)))])
            values = np.concatenate([values, flat[edge]])
        out = []
        for block, which in zip(group["block"], uses):
            n = runs[which]
            take = np.repeat(first[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((int(group["shard"].iloc[0]), block,
                        squeeze(lengths[take].tobytes() + values[take].tobytes())))
        return pd.DataFrame(out, columns=["shard", "block", "owners"])
    return run


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut_out(shards: int, with_text: bool):
    """Removes from the documents of a block every window whose owner is a smaller id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, keys, replies in block_rows(batches, "keys", "replies"):
            change = np.zeros(len(block.text) + 1, np.int32)
            if keys:
                found = {r["shard"]: r["owners"] for r in replies}
                for shard, strings, _, (runs, which) in block.repeated(keys, shards):
                    data = np.frombuffer(expand(found[shard]), np.int64)
                    lengths, values = data[:len(data) // 2], data[len(data) // 2:]
                    owner = np.repeat(values, lengths)
                    windows = np.fromiter(map(len, strings), np.int64, len(strings)) - WINDOW + 1
                    begin = np.cumsum(windows) - windows
                    count = block.count[runs]
                    shift = np.cumsum(count) - count
                    inner = np.arange(count.sum()) - np.repeat(shift, count)
                    gone = owner[np.repeat(begin[which], count) + inner] < np.repeat(block.ids[block.doc[runs]], count)
                    start = (np.repeat(block.start[runs], count) + inner)[gone]
                    np.add.at(change, start, 1)
                    np.add.at(change, start + WINDOW, -1)
            gone = np.cumsum(change[:-1]) > 0
            data = np.frombuffer(block.text, np.uint8)
            rows = []
            for i, (a, b) in enumerate(zip(block.at[:-1], block.at[1:])):
                own = gone[a:b]
                spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if b > a else 0
                kept = data[a:b][~own].tobytes() if spans else block.text[a:b]
                rows.append((int(block.ids[i]) if block.ids[i] != NO_ID else None, int(b - a), int(own.sum()), spans,
                             kept if with_text else hashlib.sha256(kept).hexdigest().encode()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    sort_bytes: int = SORT_BYTES, with_text: bool = True) -> DataFrame:
    """A row per input row: doc_id, n_bytes, n_removed, n_spans, kept (bytes left).

    Each byte goes that is covered by a string of 50 bytes which also begins in a document with
    a smaller id; strings are judged on the input. A null text is empty; texts under 50 bytes
    stay. Rows that share an id do not count against each other; a row without an id counts as
    the largest. Other columns are not read; an empty table gives no rows. Without `with_text`,
    `kept` is the hex digest of the bytes left. `sort_bytes` bounds what a sort holds in memory.
    """
    spark = docs.sparkSession
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = stored(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                                F.col(text_col).alias("text")).mapInArrow(to_blocks, BLOCKS), "suffix-blocks")
    keys = stored(blocks.mapInArrow(emit_keys(shards), "shard int, block long, data binary")
                  .groupBy("shard").applyInPandas(find_repeated, "shard int, block long, bits binary")
                  .groupBy("block").agg(F.collect_list(F.struct("shard", "bits")).alias("keys")), "suffix-keys")
    replies = (blocks.join(keys, "block")
                     .mapInArrow(emit_strings(shards), "shard int, block long, sizes binary, ids binary, data binary")
                     .groupBy("shard").applyInPandas(sort_shard(sort_bytes), "shard int, block long, owners binary")
                     .groupBy("block").agg(F.collect_list(F.struct("shard", "owners")).alias("replies")))
    return blocks.join(keys, "block", "left").join(replies, "block", "left") \
        .mapInArrow(cut_out(shards, with_text), KEPT)
