"""Suffix order by induced sorting in external memory.

Suffixes of the text that begin a stretch (leftmost smaller ones) are ordered first: their
stretches get names in sorted order, and where names repeat, the string of names is sorted
the same way, recursively, until it fits into memory. Then two scans induce all others: taken
smallest first, each suffix puts the one before it into a queue; larger characters first for
the second scan. The queues hold tuples (first character, position, common prefix with the
tuple before) and keep all but a bounded part in sorted runs on disk.

Common prefixes are carried along: the prefix that two induced suffixes share is one longer
than the shortest one between those they were induced from. Prefixes and order are bounded by
`depth`, as nothing longer is asked for: suffixes alike in `depth` characters come in any order.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np

#: Position and common prefix of a queued suffix.
TUPLE = np.dtype([("pos", "<i8"), ("lcp", "<i4")])


def space(folder: str, n: int, dtype, limit: int) -> np.ndarray:
    """An array in memory, or in a file of `folder` if it has more than `limit` bytes."""
    if n * np.dtype(dtype).itemsize <= limit:
        return np.zeros(n, dtype)
    return np.memmap(os.path.join(folder, f"a{len(os.listdir(folder))}"), dtype, "w+", shape=(n,))


class Queue:
    """Suffix tuples by character, first in first out within one.

    As the scans never go back behind the character they are at, a queue of buckets is a
    priority queue. Above `limit` bytes everything held is written as one run, sorted by
    character, and read back piece by piece when its character comes up.
    """

    def __init__(self, folder: str, limit: int, sign: int = 1):
        self.folder, self.limit, self.sign = folder, limit, sign
        self.held: dict[int, list[np.ndarray]] = {}
        self.bytes = 0
        self.runs: list[tuple[str, dict[int, tuple[int, int]]]] = []
        self.heap: list[int] = []
        self.queued: set[int] = set()

    def push(self, chars: np.ndarray, pos: np.ndarray, lcp: np.ndarray | None) -> None:
        if not len(pos):
            return
        order = np.argsort(chars, kind="stable")
        chars = chars[order]
        out = np.empty(len(pos), TUPLE)
        out["pos"] = pos[order]
        out["lcp"] = 0 if lcp is None else lcp[order]
        first = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
        for c, a, b in zip(chars[first].tolist(), first, np.append(first[1:], len(chars))):
            self.held.setdefault(c, []).append(out[a:b])
            if c not in self.queued:
                self.queued.add(c)
                heapq.heappush(self.heap, self.sign * c)
        self.bytes += out.nbytes
        if self.bytes > self.limit:
            self.spill()

    def spill(self) -> None:
        path = os.path.join(self.folder, f"q{id(self)}-{len(self.runs)}")
        index, at = {}, 0
        with open(path, "wb") as f:
            for c in sorted(self.held):
                n = sum(len(x) for x in self.held[c])
                index[c] = (at, n)
                for x in self.held[c]:
                    f.write(x.tobytes())
                at += n * TUPLE.itemsize
        self.runs.append((path, index))
        self.held, self.bytes = {}, 0

    def head(self) -> int | None:
        """The next character that has tuples."""
        return self.sign * self.heap[0] if self.heap else None

    def pop(self, c: int) -> np.ndarray:
        """All tuples of a character; empty if there are none."""
        found = []
        if c in self.queued:
            self.queued.discard(c)
            if self.heap and self.heap[0] == self.sign * c:
                heapq.heappop(self.heap)
            for path, index in self.runs:
                if c in index:
                    at, n = index.pop(c)
                    found.append(np.fromfile(path, TUPLE, n, offset=at))
            for x in self.held.pop(c, ()):
                self.bytes -= x.nbytes
                found.append(x)
        return np.concatenate(found) if found else np.empty(0, TUPLE)

    def close(self) -> None:
        for path, _ in self.runs:
            os.unlink(path)


def types_of(text: np.ndarray, folder: str, limit: int, chunk: int = 1 << 20) -> np.ndarray:
    """True where a suffix is smaller than the one that follows it."""
    n = len(text)
    small = space(folder, n, bool, limit)
    small[n - 1] = True
    for stop in range(n - 1, 0, -chunk):
        start = max(0, stop - chunk)
        step = np.sign(text[start + 1:stop + 1].astype(np.int64) - text[start:stop].astype(np.int64))
        at = np.where(step != 0, np.arange(stop - start), stop - start)
        at = np.minimum.accumulate(at[::-1])[::-1]  # equal characters take the type to the right
        inside = at < stop - start
        part = np.empty(stop - start, bool)
        part[inside] = step[at[inside]] > 0
        part[~inside] = small[stop]
        small[start:stop] = part
    return small


def shared(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix, `depth` at most, of the suffixes at a and at b."""
    out = np.zeros(len(a), np.int32)
    live = np.arange(len(a))
    n = len(text)
    for k in range(depth):
        x, y = a[live] + k, b[live] + k
        ok = (x < n) & (y < n)
        ok[ok] = text[x[ok]] == text[y[ok]]
        live = live[ok]
        if not len(live):
            break
        out[live] += 1
    return out


class Carry:
    """Common prefixes of induced suffixes, from those of the suffixes that were scanned."""

    def __init__(self, chars: int, depth: int):
        self.since = np.full(chars, -1, np.int32)  # least since the last one put into a bucket
        self.depth = depth

    def induce(self, lcp: np.ndarray, at: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """For the scanned tuples at `at`, which put suffixes into the buckets `chars`."""
        n = len(lcp)
        before = np.minimum.accumulate(lcp)
        after = np.append(np.minimum.accumulate(lcp[::-1])[::-1][1:], np.int32(self.depth))
        out = np.empty(len(at), np.int32)
        order = np.argsort(chars, kind="stable")
        c, p = chars[order], at[order]
        first = np.concatenate([[True], c[1:] != c[:-1]]) if len(c) else np.empty(0, bool)
        least = np.empty(len(c), np.int32)
        least[first] = np.minimum(self.since[c[first]], before[p[first]])
        again = np.flatnonzero(~first)
        if len(again):
            # Least over (previous, this] by a table of powers of two.
            low, high = p[again - 1] + 1, p[again]
            power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
            table, width = lcp, 1
            for k in range(int(power.max()) + 1):
                own = power == k
                if own.any():
                    least[again[own]] = np.minimum(table[low[own]], table[high[own] - width + 1])
                if len(table) > width:
                    table = np.minimum(table[:-width], table[width:])
                width *= 2
        out[order] = np.minimum(least + 1, self.depth)
        if n:
            self.since = np.minimum(self.since, before[-1])
            last = np.append(first[1:], True) if len(c) else first
            self.since[c[last]] = after[p[last]]
        return out


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray | None,
           folder: str, limit: int, depth: int) -> Iterator[np.ndarray]:
    """Tuples of all suffixes in order, a bucket at a time, buckets from the largest character
    down. `seeds` are the leftmost smaller suffixes in order; without their common prefixes
    none are carried."""
    carry = seed_lcp is not None
    chars = int(text.max()) + 1
    up, larger = Queue(folder, limit), Queue(folder, limit, -1)
    track = Carry(chars, depth) if carry else None
    seed_char = text[seeds]
    cut = np.flatnonzero(np.concatenate([[True], seed_char[1:] != seed_char[:-1]]))
    cuts = list(zip(seed_char[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(seeds)]))

    def put(queue: Queue, track: Carry | None, pos: np.ndarray, lcp: np.ndarray, want: bool) -> None:
        at = np.flatnonzero(pos > 0)
        at = at[small[pos[at] - 1] == want]
        before = pos[at] - 1
        c = text[before].astype(np.int64)
        queue.push(c, before, track.induce(lcp, at, c) if track else None)

    turn = 0
    while up.heap or turn < len(cuts):
        head = up.head()
        c = cuts[turn][0] if head is None or turn < len(cuts) and cuts[turn][0] < head else head
        last = None
        while len(batch := up.pop(c)):
            larger.push(np.full(len(batch), c), batch["pos"], batch["lcp"])
            put(up, track, batch["pos"], batch["lcp"], False)
            last = batch["pos"][-1]
        if turn < len(cuts) and cuts[turn][0] == c:
            _, a, b = cuts[turn]
            turn += 1
            pos = np.asarray(seeds[a:b])
            lcp = np.zeros(len(pos), np.int32)
            if carry:
                lcp[:] = seed_lcp[a:b]
                lcp[0] = shared(text, np.array([last]), pos[:1], depth)[0] if last is not None else 0
            put(up, track, pos, lcp, False)
    up.close()
    down = Queue(folder, limit, -1)
    track = Carry(chars, depth) if carry else None
    down.push(text[-1:].astype(np.int64), np.array([len(text) - 1]), np.zeros(1, np.int32))
    while down.heap or larger.heap:
        c = max(x for x in (down.head(), larger.head()) if x is not None)
        smaller = []
        while len(batch := down.pop(c)):
            put(down, track, batch["pos"], batch["lcp"], True)
            smaller.append(batch)
        bigger = larger.pop(c)
        fell = np.concatenate(smaller) if smaller else np.empty(0, TUPLE)
        rose = fell[::-1].copy()
        if len(rose):
            rose["lcp"][1:] = fell["lcp"][::-1][:-1]
            seam = 0
            if carry and len(bigger):
                seam = int(shared(text, bigger["pos"][-1:], rose["pos"][:1], depth)[0])
            rose["lcp"][0] = seam
        if len(bigger):
            lcp = np.zeros(len(bigger), np.int32)
            if carry:
                lcp[1:] = bigger["lcp"][1:][::-1]
                lcp[0] = rose["lcp"][0] if len(rose) else 0
            put(down, track, bigger["pos"][::-1], lcp, True)
        yield np.concatenate([bigger, rose])
    down.close()
    larger.close()


def doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string that fits into memory, by `depth` characters."""
    rank = names.astype(np.int64)
    k = 1
    while True:
        order = np.argsort(rank, kind="stable")
        if k >= depth or (np.diff(rank[order]) > 0).all():
            return order
        second = np.zeros(len(rank), np.int64)
        second[:-k or None] = rank[k:] + 1 if k < len(rank) else 0
        _, rank = np.unique(rank * (int(second.max()) + 1) + second, return_inverse=True)
        k *= 2


def seeds_in_order(text: np.ndarray, small: np.ndarray, folder: str, limit: int, depth: int) -> np.ndarray:
    """Leftmost smaller suffixes, sorted: by names of their stretches, recursively."""
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) == 1:
        return lms
    begins = space(folder, len(text), bool, limit)
    begins[lms] = True
    by_char = lms[np.argsort(text[lms], kind="stable")]
    found = [x["pos"][begins[x["pos"]]] for x in induce(text, small, by_char, None, folder, limit, depth)]
    order = np.concatenate(found[::-1])
    size = np.minimum(np.append(np.diff(lms) + 1, 1), depth)
    size = size[np.searchsorted(lms, order)]
    same = size[1:] == size[:-1]
    pairs = np.flatnonzero(same)
    same[pairs] = shared(text, order[pairs], order[pairs + 1], depth) >= size[pairs]
    names = np.concatenate([[0], np.cumsum(~same)])
    if names[-1] + 1 == len(lms):
        return order
    reduced = space(folder, len(lms), np.int64, limit)
    reduced[np.searchsorted(lms, order)] = names
    deep = depth // 2 + 2  # two stretches begin two characters apart at least
    if reduced.nbytes <= limit:
        return lms[doubled(np.asarray(reduced), deep)]
    inner = [x["pos"] for x in suffixes(reduced, folder, limit, deep, False)]
    return lms[np.concatenate(inner[::-1])]


def suffixes(text: np.ndarray, folder: str, limit: int, depth: int, carry: bool = True) -> Iterator[np.ndarray]:
    """Tuples (pos, lcp) of all suffixes by their first `depth` characters, a bucket of one first
    character at a time from the largest down, ascending inside. The last character must be the
    smallest and occur once. `lcp` is the prefix shared with the one before in the bucket."""
    if len(text) == 1:
        yield np.zeros(1, TUPLE)
        return
    small = types_of(text, folder, limit)
    seeds = seeds_in_order(text, small, folder, limit, depth)
    lcp = None
    if carry:
        lcp = np.concatenate([[0], shared(text, seeds[:-1], seeds[1:], depth)]).astype(np.int32)
    yield from induce(text, small, seeds, lcp, folder, limit, depth)
