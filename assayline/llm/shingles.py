"""Jaccard join of word shingles: documents that link, and the groups they form.

1. A set needs most of its elements in others to link. Elements are dealt out by hash, those in
   one set only are counted, and sets with too many of these are left out.
   Signatures bring together what can link. If two sets have at least 85 % of their union in
   common, few elements differ; with more parts (by hash) than that, one part is the same in
   both. A set emits a hash per part, for the two classes of sizes its partner may be in.
   Parts without elements say nothing: a set that fills too few emits the elements of its
   prefix too, so a pair is found by the one or the other. Every pair that links shares a
   signature; a passage that many documents share makes none equal, as a part must agree whole.
2. Sets that share signatures form clusters. In each, sets with the same smallest hash (three
   salts) are compared directly, which settles most links. The sets outside the largest group
   that this gives are searched by T-occurrence: inverted lists of its shingles, short ones merged by a heap, long ones probed by binary
   search (DivideSkip), and documents kept that reach the overlap the threshold asks for.
3. Of a cluster too large for a task, sets go that have too few elements in common with all
   others; the rest is cut into blocks that share some pivots. Near copies
   connect through these; documents that do not are searched among those of like size, in
   blocks of bounded bytes.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import distinct, forget, free, give_back, may_have, mix, pieces, stored, utf8, word_hashes
from assayline.llm.components import components

WIDTH = 4
#: Link where 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Sets of a cluster that one task searches, and pivots that blocks of a cluster share.
BLOCK = 1500
PIVOTS = 8
#: Bytes of elements of a large cluster that one task compares with as many others.
SIDE = 16 << 20


def set_of(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one document's word hashes."""
    n = len(words)
    if not n:
        return words
    k = min(n, width)
    x = mix(words[:n - k + 1] + np.uint64(k))
    for i in range(1, k):
        x = mix(x * np.uint64(5) + words[i:n - k + 1 + i])
    return distinct(x)


def sets_of(column: pa.Array, width: int) -> list[np.ndarray]:
    words, doc = word_hashes(*utf8(column))
    cut = np.searchsorted(doc, np.arange(len(column) + 1))
    return [set_of(words[a:b], width) for a, b in zip(cut, cut[1:])]


def digest(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit values that equal sets share; signed, as the engine stores them."""
    if not len(s):
        return 0, 0
    a = mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    b = np.bitwise_xor.reduce(mix(s + np.uint64(0x1234567)))
    return int(a.astype(np.int64)), int(b.astype(np.int64))


class Schemes:
    """Size classes and the number of parts for pairs whose smaller set is in a class."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]
        self.made: dict[int, tuple[int, int]] = {}

    def of(self, n: int) -> list[int]:
        """Schemes a set of n elements takes part in: its class, and the one below."""
        while self.low[-1] <= n:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        c = bisect_left(self.low, n + 1) - 1
        return [c, c - 1] if c else [c]

    def parts(self, scheme: int) -> tuple[int, int]:
        """(most elements that differ, parts) in a scheme."""
        if scheme not in self.made:
            top = self.low[scheme + 1] - 1
            both = top + top * 100 // self.percent
            differ = both * (100 - self.percent) // (100 + self.percent)
            self.made[scheme] = differ, differ + 2 + differ // 10 if differ else 1
        return self.made[scheme]


def signatures(s: np.ndarray, schemes: Schemes) -> np.ndarray:
    """All signatures of a sorted set that is not empty."""
    out, bare = [], False
    high = s >> np.uint64(32)
    mixed = mix(s)
    for scheme in schemes.of(len(s)):
        differ, parts = schemes.parts(scheme)
        part = (high * np.uint64(parts)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        tag = part[first] + np.uint64((scheme + 1) << 32)
        out.append(mix(np.add.reduceat(mixed, first) ^ mix(tag)))
        bare |= len(first) <= differ
    if bare:
        prefix = len(s) - -(-schemes.percent * len(s) // 100) + 1
        out.append(mix(s[:prefix] + np.uint64(0x51ED270B)))
    return np.concatenate(out)


DOCS = "doc_id long, text_hash long, n_shingles long, hi long, lo long"


def describe(width: int):
    """Size and digest of each document's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = sets_of(piece.column("text"), width)
                both = np.array([digest(s) for s in sets], np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("text_hash"),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                    ["doc_id", "text_hash", "n_shingles", "hi", "lo"])
    return run


def by_shard(value: np.ndarray, node: np.ndarray, key: np.ndarray, shards: int, kept=np.uint64) -> list[tuple]:
    """(shard, values, numbers of their sets, keys of these sets) for each shard that has values;
    the upper half of a value says which, and `kept` how much of it is handed on."""
    shard = ((value >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.uint16 if shards <= 1 << 16 else np.int64)
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for k in np.flatnonzero(np.diff(cut)):
        own = order[cut[k]:cut[k + 1]]
        used, at = np.unique(node[own], return_inverse=True)
        at = at.astype(np.uint16 if len(used) < 1 << 16 else np.uint32)
        rows.append((int(k), value[own].astype(kept).tobytes(), at.tobytes(), key[used].tobytes()))
    return rows


def numbers(at: bytes, n: int) -> np.ndarray:
    """The n numbers of sets that `by_shard` packed."""
    return np.frombuffer(at, np.uint16 if len(at) == 2 * n else np.uint32)


#: Bytes of elements of a slice. Texts are taken apart in smaller pieces, which take many times their size.
SLICE = 4 << 20


def sets_in_texts(width: int):
    """(keys, sets): distinct sets of each slice of texts, with the first value of their digest."""
    def read(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        sets: dict[tuple[int, int], np.ndarray] = {}
        size = 0
        for piece in pieces(batch, "text"):
            for s in sets_of(piece.column("text"), width):
                if len(s):
                    sets[digest(s)] = s
                    size += s.nbytes
            if size > SLICE:
                yield np.array([k[0] for k in sets], np.int64), list(sets.values())
                sets, size = {}, 0
        if sets:
            yield np.array([k[0] for k in sets], np.int64), list(sets.values())
    return read


def sets_by_rep(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(keys, sets): distinct sets of each slice of rows with elements, with their number."""
    for piece in pieces(batch, "elements", SLICE):
        sets = dict(zip(piece.column("rep").to_pylist(), piece.column("elements").to_pylist()))
        yield np.array(list(sets), np.int64), [np.frombuffer(x, np.uint64) for x in sets.values()]


def sign(width: int, percent: int, shards: int):
    """Signatures of the distinct sets of each slice, by shard, with set digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemes, read = Schemes(percent), sets_in_texts(width)
        for batch in batches:
            for hi, sets in read(batch):
                found = [signatures(s, schemes) for s in sets]
                node = np.repeat(np.arange(len(found), dtype=np.uint32), [len(f) for f in found])
                shard, value, at, key = zip(*by_shard(np.concatenate(found), node, hi, shards))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), *[pa.array(x, pa.binary()) for x in (value, at, key)]],
                    ["shard", "value", "node", "hi"])
    return run


def meet(group: pd.DataFrame) -> pd.DataFrame:
    """Within a shard, each set is joined to the smallest one with which it shares a signature."""
    value, node = [], []
    for v, n, h in zip(group["value"], group["node"], group["hi"]):
        v, h = np.frombuffer(v, np.uint64), np.frombuffer(h, np.int64)
        value.append(v)
        node.append(h[numbers(n, len(v))])
    value, node = np.concatenate(value), np.concatenate(node)
    order = np.argsort(value, kind="stable")
    value, node = value[order], node[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    size = np.diff(np.append(first, len(value)))
    least = np.repeat(np.minimum.reduceat(node, first), size)
    own = node != least
    both = np.unique(np.stack([node[own], least[own]], 1), axis=0)
    return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})


class Links:
    """Union of sets that link, by index."""

    def __init__(self, labels: list):
        first: dict = {}
        self.up = [first.setdefault(x, i) if x is not None else i for i, x in enumerate(labels)]
        self.edges: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.edges.append((i, j))


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap with which sets of n and m elements link."""
    return -(-percent * (n + m) // (100 + percent))


def common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def merge_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """(id, count) of the ids in at least `least` of some sorted lists, by a heap that jumps
    over ids which cannot reach it."""
    heap = [(ids[0], k, 0) for k, ids in enumerate(lists) if ids]
    heapq.heapify(heap)
    while len(heap) >= least:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= least:
            yield top, len(popped)
            target = top + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            target = max(top + 1, heap[0][0])
        for _, k, at in popped:
            at = bisect_left(lists[k], target, at)
            if at < len(lists[k]):
                heapq.heappush(heap, (lists[k][at], k, at))


def divide_skip(lists: list, least: int) -> Iterator[tuple[int, int, list]]:
    """Candidates (id, count in short lists, long lists still to be probed)."""
    lists = sorted((x for x in lists if len(x)), key=len)
    if len(lists) < least:
        return
    most = len(lists[-1])
    long = min(least - 1, int(least / (0.0085 * math.log2(most + 1) + 1)))
    short, long_lists = [np.asarray(x).tolist() for x in lists[:len(lists) - long]], lists[len(lists) - long:]
    for i, n in merge_skip(short, least - long):
        yield i, n, long_lists


def probe(ids: np.ndarray, count: np.ndarray, need: np.ndarray, long_lists: list[np.ndarray]) -> np.ndarray:
    """The ids whose count reaches what they need when the long lists are searched for them;
    an id is dropped once the lists left cannot bring it there."""
    for rest, own in zip(range(len(long_lists) - 1, -1, -1), long_lists):
        count = count + (own[np.minimum(np.searchsorted(own, ids), len(own) - 1)] == ids)
        hope = count + rest >= need
        if not hope.all():
            ids, count, need = ids[hope], count[hope], need[hope]
        if not len(ids):
            break
    return ids[count >= need]


def search(sets: list[np.ndarray], links: Links, queries: list[int], percent: int, main: int | None = None) -> None:
    """Joins every query with all sets that link with it and are not yet connected to it.

    Sets connected to `main` need no search: a link that leaves their group has another end. So
    the sets with the most common elements, which may connect many, are searched first.
    """
    if not len(queries):
        return
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    key, end = every[first], np.append(first[1:], len(every))
    spread = np.bincount(owner, np.repeat(end - first, end - first), len(sets)) / np.maximum(1, sizes)
    root = np.array([links.find(i) for i in range(len(sets))])
    done = np.zeros(len(sets), bool)  # all their links are known
    for q in sorted(queries, key=lambda i: -spread[i]):
        if main is not None and root[q] == root[main]:
            continue
        n = len(sets[q])
        free = ~done & (root != root[q]) & (100 * sizes >= percent * n) & (percent * sizes <= 100 * n)
        done[q] = True
        if not free.any():
            continue
        at = np.searchsorted(key, sets[q])
        lists = [own[free[own]] for own in (owner[first[k]:end[k]] for k in at if end[k] - first[k] > 1)]
        found = list(divide_skip(lists, needed(n, int(sizes[free].min()), percent)))
        if not found:
            continue
        ids, count = np.array([(i, c) for i, c, _ in found]).T
        for i in probe(ids, count, needed(n, sizes[ids], percent), found[0][2]):
            links.join(q, int(i))
            root[root == root[i]] = root[q]


def connect(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links enough to connect all sets that links connect.

    Sets with the same smallest element under some hash are tried first. Then it is enough to
    search for the sets outside the largest group: a link between groups has such an end.
    """
    links = Links([None] * len(sets))
    for salt in (1, 2, 3):
        leaders: dict[int, int] = {}
        for i, s in enumerate(sets):
            j = leaders.setdefault(int(mix(s + np.uint64(salt * 7919)).min()), i)
            if j != i and links.find(i) != links.find(j) and \
                    common(s, sets[j]) >= needed(len(s), len(sets[j]), percent):
                links.join(i, j)
    roots = [links.find(i) for i in range(len(sets))]
    count: dict[int, int] = {}
    for r in roots:
        count[r] = count.get(r, 0) + 1
    largest = max(count, key=count.get)
    search(sets, links, [i for i, r in enumerate(roots) if r != largest], percent, largest)
    return links.edges


EDGES = "a long, b long"


def edge_frame(nodes: list[int], edges: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame([(nodes[i], nodes[j]) for i, j in edges], columns=["a", "b"], dtype=np.int64)


def within(width: int, percent: int):
    """Links in each cluster of a group of rows with texts, or with elements where a block of a
    cluster has its sets stored. A text counts if it has the digest of the set it stands for."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in group.groupby("cluster"):
            own = own.drop_duplicates("rep").sort_values("rep")
            if "text" in own:
                sets = sets_of(pa.array(own["text"], pa.string()), width)
                right = [digest(s) == k for s, k in zip(sets, zip(own["hi"], own["lo"]))]
                sets, own = [s for s, r in zip(sets, right) if r], own[right]
            else:
                sets = [np.frombuffer(x, np.uint64) for x in own["elements"]]
            if len(sets) > 1:
                out.append(edge_frame(own["rep"].tolist(), connect(sets, percent)))
        return pd.concat(out) if out else edge_frame([], [])
    return run


def across(percent: int):
    """Links between documents apart from the rest of their cluster and one block of it."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["apart", "rep"], ascending=[False, True]).drop_duplicates("rep")
        sets = [np.frombuffer(x, np.uint64) for x in group["elements"]]
        links = Links(group["component"].tolist())
        search(sets, links, np.flatnonzero(group["apart"].to_numpy(bool)).tolist(), percent)
        return edge_frame(group["rep"].tolist(), links.edges)
    return run


def dealt(shards: int, read):
    """Elements of the sets of each slice, by shard: the lower halves of their hashes, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_ = TaskContext.get().partitionId() << 32
        for batch in batches:
            for keys, sets in read(batch):
                node = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
                rows = by_shard(np.concatenate(sets), node, keys, shards, np.uint32)
                shard, value, at, key = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), pa.array(np.full(len(rows), slice_)),
                     *[pa.array(x, pa.binary()) for x in (value, at, key)]], ["shard", "slice", "value", "node", "key"])
                slice_ += 1
    return run


def lone(group: pd.DataFrame) -> pd.DataFrame:
    """For each slice, how many elements of its sets in this shard no set with another key has.
    Hashes that differ and have the same lower half pass for one element: never too many are lone."""
    value = [np.frombuffer(v, np.uint32) for v in group["value"]]
    at = [numbers(n, len(v)) for n, v in zip(group["node"], value)]
    keys = [np.frombuffer(k, np.int64) for k in group["key"]]
    key, value_ = np.concatenate([k[a] for k, a in zip(keys, at)]), np.concatenate(value)
    order = np.argsort(value_)
    value_, key = value_[order], key[order]
    first = np.flatnonzero(np.concatenate([[True], value_[1:] != value_[:-1]]))
    only = np.minimum.reduceat(key, first) == np.maximum.reduceat(key, first)
    mark = np.empty(len(order), bool)
    mark[order] = np.repeat(only, np.diff(np.append(first, len(order))))
    out, start = [], 0
    for slice_, a, k in zip(group["slice"], at, keys):
        n = np.bincount(a[mark[start:start + len(a)]], minlength=len(k)).astype(np.uint32)
        out.append((slice_, k[n > 0].tobytes(), n[n > 0].tobytes()))
        start += len(a)
    return pd.DataFrame(out, columns=["slice", "key", "n"])


def summed(group: pd.DataFrame) -> pd.DataFrame:
    """Lone elements of each set of a slice, over all shards."""
    key, at = np.unique(np.frombuffer(b"".join(group["key"]), np.int64), return_inverse=True)
    n = np.bincount(at, np.frombuffer(b"".join(group["n"]), np.uint32), len(key))
    return pd.DataFrame({"key": key, "alone": n.astype(np.int64)})


def alone_in(sets: DataFrame, read) -> DataFrame:
    """(key, alone): number of elements that no other set has, for the sets with any. Elements go
    through one exchange, packed; a set that occurs in several slices has the same number in each."""
    shards = max(1, int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return sets.mapInArrow(dealt(shards, read), "shard int, slice long, value binary, node binary, key binary") \
        .groupBy("shard").applyInPandas(lone, "slice long, key binary, n binary") \
        .groupBy("slice").applyInPandas(summed, "key long, alone long") \
        .groupBy("key").agg(F.max("alone").alias("alone"))


def enough(n: Column, percent: int) -> Column:
    """Whether a set of n elements, `alone` of them (null: none) in no other set, may link with any.
    A link takes 100 * common >= percent * size of either set."""
    return 100 * (n - F.coalesce("alone", F.lit(0))) >= percent * n


def that_may_link(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sets, counts): the sets that have enough elements in common with others to link with any,
    and a stored table of the number of elements that no other set has."""
    counts = stored(alone_in(sets.select("rep", "elements"), sets_by_rep).withColumnRenamed("key", "rep"), "jaccard-alone")
    return sets.join(counts, "rep", "left").where(enough(F.length("elements") / 8, percent)).select(*sets.columns), counts


def size_class(size: Column, percent: int) -> Column:
    """Number of a class of sizes; sets that link are of the same class or of neighbouring ones."""
    # A little wider than the ratio of sizes allows, so that rounding cannot part such a pair.
    return F.floor(F.log(size.cast("double")) / (max(math.log(100 / percent), 1e-3) * (1 + 1e-9)))


CELL = ("cluster", "class", "up")


def meetings(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, cells): the sets of large clusters dealt to the tasks of `across`, and a stored
    table of what each cell holds.

    A set apart from its main group asks the sets of its own class of sizes and of the next one
    above (`up`), and of the next one below those that are not apart, as the others ask it
    themselves. A cell of too many bytes is cut: askers by turn, those asked by block.
    """
    asked = labelled.withColumn("up", F.explode(F.when(F.col("apart"), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))))
    askers = labelled.where("apart").withColumn("step", F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))) \
        .withColumns({"class": F.col("class") + F.col("step"), "up": F.col("step") >= 0}).drop("step")

    def parts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*CELL).agg(F.ceil(F.sum(F.length("elements")) / SIDE).cast("int").alias(name))
    cells = stored(parts(asked, "blocks").join(parts(askers, "turns"), list(CELL)), "jaccard-cells")
    columns = [*CELL, "rep", "component", "apart", "elements", "block", "turn"]
    left = asked.join(cells, list(CELL)).withColumns({
        "apart": F.lit(False), "block": F.pmod(F.xxhash64("rep"), "blocks").cast("int"),
        "turn": F.explode(F.sequence(F.lit(0), F.col("turns") - 1))}).select(columns)
    right = askers.join(cells, list(CELL)).withColumns({
        "turn": F.pmod(F.xxhash64("rep", F.lit(1)), "turns").cast("int"),
        "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))}).select(columns)
    return left.unionByName(right), cells


def elements_of(width: int):
    """Sets of the documents that stand for their set, checked by digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = sets_of(piece.column("text"), width)
                right = [i for i, (s, hi, lo) in enumerate(zip(
                    sets, piece.column("hi").to_pylist(), piece.column("lo").to_pylist())) if digest(s) == (hi, lo)]
                take = pa.array(right, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(c).take(take) for c in ("cluster", "size", "rep")],
                     pa.array([sets[i].tobytes() for i in right], pa.binary())],
                    ["cluster", "size", "rep", "elements"])
    return run


#: Sets up to which their keys (some 60 bytes each) are sent to all tasks; more are joined by a shuffle.
SENT_SETS = 500_000


def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per set and task, however often its document is repeated."""
    seen: set[int] = set()
    for batch in batches:
        new = []
        for i, rep in enumerate(batch.column("rep").to_pylist()):
            if rep not in seen:
                seen.add(rep)
                new.append(i)
        yield batch.take(pa.array(new, pa.int64()))
    give_back()


def met_by(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents that stand for a set, as often as they are repeated. Where the sets are
    counted to be few the texts meet them without an exchange; otherwise only those that may be
    wanted go through one."""
    texts = texts.where("doc_id is not null")
    if wanted.limit(SENT_SETS + 1).count() <= SENT_SETS:
        return texts.join(F.broadcast(wanted), ["doc_id", "text_hash"])
    return may_have(texts, wanted, "doc_id", "text_hash").join(wanted.hint("shuffle_hash"), ["doc_id", "text_hash"])


def texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cluster, size, rep, hi, lo, text) of the documents that stand for a set."""
    return met_by(texts, wanted).select("cluster", "size", "rep", "hi", "lo", "text").mapInArrow(
        once, "cluster long, size long, rep long, hi long, lo long, text string")


def similar_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id, n_shingles, component_id.

    Two documents link if 100 * common >= percent * all of their distinct shingles of `width`
    words (a shorter text is one shingle); `component_id` is the smallest id reachable by links.
    Null and empty texts and texts of white space have no shingle and link with nothing; a row
    without an id has no component. Rows that share an id but not a text keep their own sets,
    and may connect the groups of both. Other columns are not read; an empty table gives no rows.
    """
    return grouped_rows(docs, width, percent, block, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def text_key(text_col: str = "text") -> Column:
    """What tells rows with the same id apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def keep_first(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each group that links, the row
    with the smallest id (of several with this id, the one with the smallest hash of its text).
    Rows without an id or a shingle stay. Rows equal in id and text cannot be told apart and
    stay or go together."""
    own, key = free(docs, "_id", "_hash")
    gone = grouped_rows(docs, width, percent).where("doc_id != component_id or text_hash != component_hash") \
        .select(F.col("doc_id").alias(own), F.col("text_hash").alias(key)).distinct()
    return docs.join(gone, (docs["doc_id"].cast("long") == F.col(own)) & (text_key() == F.col(key)), "left_anti") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def grouped_rows(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `similar_groups`, with text_hash, and component_hash: the smallest text_hash of the
    rows of the group that have the smallest id.

    Sets go by the number of their row in a stored table (`rep`), as several may have the same
    smallest id.
    """
    spark = docs.sparkSession
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        text_key(text_col).alias("text_hash"))
    rows = stored(texts.mapInArrow(describe(width), DOCS), "jaccard-docs")
    known = rows.where("n_shingles > 0 and doc_id is not null")
    classes = stored(known.groupBy("hi", "lo", "n_shingles").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
                     .select("hi", "lo", "n_shingles", "first", F.monotonically_increasing_id().alias("rep")),
                     "jaccard-classes")
    # Sets that have too few elements in common with all others link with none: they are found first, as
    # parts they share by chance would else tie most sets of a large table into one cluster.
    alone = alone_in(texts.where("doc_id is not null").select("text"), sets_in_texts(width))
    classes_left = stored(classes.join(alone.withColumnRenamed("key", "hi"), "hi", "left")
                          .where(enough(F.col("n_shingles"), percent)).select(*classes.columns), "jaccard-left")
    met = met_by(texts, classes_left.select(F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))).select("text") \
        .mapInArrow(sign(width, percent, shards), "shard int, value binary, node binary, hi binary") \
        .groupBy("shard").applyInPandas(meet, EDGES)
    clusters = components(met).select(F.col("node").alias("hi"), F.col("component").alias("cluster"))
    members = classes_left.join(clusters, "hi")
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(sizes, "cluster"), "jaccard-members")
    wanted = members.select("cluster", "size", "rep", F.col("first.doc_id").alias("doc_id"),
                            F.col("first.text_hash").alias("text_hash"), "hi", "lo")
    blocks = F.ceil(F.col("size") / block).cast("int")
    here = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    cells = 4 * shards
    small = texts_of(texts, wanted.where(blocks == 1)).withColumn("cell", F.pmod(F.xxhash64("cluster"), F.lit(cells)))
    edges = small.groupBy("cell").applyInPandas(within(width, percent), EDGES)
    some_large = not members.where(blocks > 1).isEmpty()
    if some_large:
        # Blocks of a large cluster meet several times, so its sets are stored.
        large = stored(texts_of(texts, wanted.where(blocks > 1))
                       .mapInArrow(elements_of(width), "cluster long, size long, rep long, elements binary"), "jaccard-sets")
        whole = large
        large, counts = that_may_link(whole, percent)
        pivots = large.groupBy("cluster").agg(
            *[F.min(F.struct(F.xxhash64("rep", F.lit(k)), "rep")).alias(f"p{k}") for k in range(PIVOTS)]) \
            .select("cluster", F.explode(F.array_distinct(F.array(*[F.col(f"p{k}.rep") for k in range(PIVOTS)]))).alias("rep"))
        shared = large.join(pivots, ["cluster", "rep"]).select(
            "cluster", "rep", "elements", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
        parts = large.select("cluster", "rep", "elements", here.alias("block")).unionByName(shared)
        edges = edges.unionByName(parts.groupBy("cluster", "block").applyInPandas(within(width, percent), EDGES))
    edges = stored(edges, "jaccard-links")
    groups = components(edges)
    forget(edges)
    if some_large:
        # Documents apart from the main group of a large cluster meet all of it that is of like size.
        labelled = large.join(groups.withColumnRenamed("node", "rep"), "rep", "left") \
            .withColumn("component", F.coalesce("component", "rep"))
        main = labelled.groupBy("cluster", "component").agg(F.count("*").alias("n")) \
            .groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("m")) \
            .select("cluster", F.col("m.component").alias("main"), F.col("m.n").alias("n"))
        labelled = stored(labelled.join(main, "cluster").withColumn("apart", F.col("component") != F.col("main"))
                          .where("size > n").select("cluster", "rep", "component", "apart", "elements",
                                                    size_class(F.length("elements") / 8, percent).alias("class")), "jaccard-apart")
        forget(whole, counts)
        more, cells = meetings(labelled)
        more = more.groupBy(*CELL, "block", "turn").applyInPandas(across(percent), EDGES)
        more = stored(more, "jaccard-more")
        if not more.isEmpty():
            groups = components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
        forget(labelled, more, cells)
    forget(members, classes_left)
    reached = classes.join(groups.withColumnRenamed("node", "rep"), "rep")
    least = reached.groupBy("component").agg(F.min("first").alias("least"))
    reached = reached.join(least, "component").where("first != least").select("hi", "lo", "n_shingles", "least")
    ids = classes.join(reached, ["hi", "lo", "n_shingles"], "left") \
        .select("hi", "lo", "n_shingles", F.coalesce("least", "first").alias("least"))
    columns = ["doc_id", "text_hash", "n_shingles"]
    alone = rows.where("n_shingles = 0 or doc_id is null").select(
        *columns, F.col("doc_id").alias("component_id"), F.col("text_hash").alias("component_hash"))
    return known.join(ids, ["hi", "lo", "n_shingles"]).select(
        *columns, F.col("least.doc_id").alias("component_id"), F.col("least.text_hash").alias("component_hash")) \
        .unionByName(alone)
