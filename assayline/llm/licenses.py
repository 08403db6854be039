"""License notices in texts, exact and with small errors.

Texts are brought to a plain form, lower-cased words with one blank between. Each notice with
k errors allowed is cut into k + 1 pieces: a place with at most k errors has one piece without
any (pigeonhole), so an automaton over all pieces gives every candidate place. There the
regex library matches the notice with bounded errors and reports span and errors.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import pieces, utf8

#: Phrases that count as they stand, with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
           ("cc by nc", "cc-by-nc"))
#: Notices found with errors, with label and errors allowed.
NOTICES = (
    ("under the mit license", "mit", 2),
    ("the mit license mit", "mit", 1),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("apache license version 2", "apache-2", 2),
    ("cc by nc", "cc-by-nc", 0),
    ("licensed under the apache license", "apache-2", 3),
    ("http www apache org licenses license 2 0", "apache-2", 3),
    ("creative commons attribution noncommercial", "cc-by-nc", 4),
    ("creative commons attribution sharealike", "cc-by-sa", 4),
    ("gnu general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("mozilla public license", "mpl", 2),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("all rights reserved", "all-rights-reserved", 1),
    ("spdx license identifier", "spdx", 2),
)

_word = np.zeros(256, bool)
_word[48:58] = _word[97:123] = _word[128:] = True
_low = np.arange(256, dtype=np.uint8)
_low[65:91] += 32


def plain_words(data: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts in plain form, each with a blank before every word and one at its end; where
    each begins (and the last ends), and the number of its words."""
    low = _low[data]
    word = _word[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    start = word & (~before | edge[:-1])
    sums = np.concatenate([[0], np.cumsum(start)])
    place = np.concatenate([[0], np.cumsum(word.astype(np.int64) + start)])
    own = np.repeat(np.arange(len(at) - 1), np.diff(at))
    out = np.full(place[-1] + len(at) - 1, 32, np.uint8)
    out[(place[1:] - 1 + own)[word]] = low[word]
    return out.tobytes(), place[at] + np.arange(len(at)), sums[at[1:]] - sums[at[:-1]]


@lru_cache(1)
def machine():
    """Automaton of all pieces, and for each notice its pattern."""
    seeds: dict[str, list[tuple[int, int]]] = {}
    patterns = []
    for k, (text, _, errors) in enumerate(NOTICES):
        cuts = [len(text) * i // (errors + 1) for i in range(errors + 2)]
        for a, b in zip(cuts, cuts[1:]):
            seeds.setdefault(text[a:b], []).append((k, a))
        patterns.append(regex.compile(rf"(?be)(?<![^ ])(?:{regex.escape(text)}){{e<={errors}}}(?![^ ])"))
    found = ahocorasick.Automaton()
    for seed, at in seeds.items():
        found.add_word(seed, (len(seed), at))
    found.make_automaton()
    return found, patterns


def scan(text: str) -> list[tuple[int, int, int, int]]:
    """Notices in a plain text with one blank before and after: (notice, start, end, errors).

    Every piece found is searched for in a window of its own, a little longer than the notice,
    so the work grows with the text however many notices stand next to each other.
    """
    automaton, patterns = machine()
    windows: dict[int, dict[tuple[int, int], None]] = {}
    for end, (size, owners) in automaton.iter(text):
        for k, a in owners:
            notice, _, errors = NOTICES[k]
            start = end - size + 1 - a
            window = max(0, start - errors - 1), min(len(text), start + len(notice) + errors + 1)
            windows.setdefault(k, {})[window] = None
    hits = []
    for k, own in windows.items():
        least = len(NOTICES[k][0]) - NOTICES[k][2]
        hits += [(k, *h) for h in settle(text, patterns[k], list(own), least)]
    return hits


def settle(text: str, pattern, windows: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """(start, end, errors) of matches that do not overlap, those with the fewest errors first
    and then from the left. A match that overlaps one taken before is sought again in what is
    left of its window; `least` is the shortest match there is."""
    taken: list[tuple[int, int, int]] = []
    heap: list[tuple[int, int, int, int, int]] = []

    def look(low: int, high: int) -> None:
        if high - low >= least and (m := pattern.search(text, low, high)):
            heapq.heappush(heap, (sum(m.fuzzy_counts), m.start(), m.end(), low, high))

    for low, high in windows:
        look(low, high)
    while heap:
        errors, start, end, low, high = heapq.heappop(heap)
        i = bisect_right(taken, (start, len(text) + 1, 0))
        near = taken[max(0, i - 1):i + 1]
        if not any(a < end and start < b for a, b, _ in near):
            taken.insert(i, (start, end, errors))
            look(low, start)
            look(end, high)
            continue
        at, j = low, max(0, bisect_right(taken, (low, 0, 0)) - 1)
        while j < len(taken) and taken[j][0] < high:  # the free stretches of the window
            look(at, taken[j][0])
            at, j = max(at, taken[j][1]), j + 1
        look(at, high)
    return taken


def base_places(text: bytes, blanks: np.ndarray) -> list[tuple[int, str]]:
    """(word number, label) of each place of a phrase in a plain text with blanks at `blanks`."""
    found = []
    for phrase, label in PHRASES:
        seek, at = b" " + phrase.encode() + b" ", -1
        while (at := text.find(seek, at + 1)) >= 0:
            found.append((int(np.searchsorted(blanks, at)), label))
    return sorted(found)


HIT = "struct<label:string,start:int,stop:int,errors:int>"
SCHEMA = (f"doc_id long, n_words long, base array<struct<word:int,label:string>>, hits array<{HIT}>, "
          "score double")


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hit = pa.struct([("label", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("errors", pa.int32())])
    place = pa.struct([("word", pa.int32()), ("label", pa.string())])
    automaton, _ = machine()
    for batch in batches:
        for part in pieces(batch, "text"):
            text, at, n = plain_words(*utf8(part.column("text")))
            base: list[list] = [[] for _ in n]
            hits: list[list] = [[] for _ in n]
            score = [0.0] * len(n)
            for i in range(len(n)):
                own = text[at[i]:at[i + 1]]
                wide = own.decode("latin-1")
                if next(automaton.iter(wide), None) is None:
                    continue
                blanks = np.flatnonzero(np.frombuffer(own, np.uint8) == 32)
                base[i] = [{"word": w, "label": x} for w, x in base_places(own, blanks)]
                for k, s, e, errors in sorted(scan(wide)):
                    notice, label, _ = NOTICES[k]
                    hits[i].append({"label": label, "start": int(np.searchsorted(blanks, s)) - (own[s:s + 1] != b" "),
                                    "stop": int(np.searchsorted(blanks, e)), "errors": errors})
                    score[i] = max(score[i], 1 - errors / len(notice))
                if base[i]:
                    score[i] = 1.0
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(base, pa.list_(place)),
                 pa.array(hits, pa.list_(hit)), pa.array(score, pa.float64())],
                ["doc_id", "n_words", "base", "hits", "score"])


def license_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id, n_words, base, hits, score.

    `base` are the places where a phrase's words stand one after the other (word number from
    0); `hits` the notices found with errors (words from start to before stop, errors). `score`
    is 1 with a base place, else the best share of a notice without error, else 0. A null or
    empty text has no words; texts of any length are read whole, in time that grows with their
    length; ids may be null or repeat; other columns are not read; an empty table gives no rows.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(scan_batches, SCHEMA)
