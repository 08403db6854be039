"""Personal data in plain and disguised form, with spans in the source text.

A chain of small transducers rewrites a text and keeps, for every character it writes, the
stretch of the source it stands for: look-alike letters and digits become ASCII and invisible
characters go; digits written as words become digits; "(at)" and "dot" become signs. The same
detectors run on the source text and on the rewritten one, and spans found in the latter are
mapped back to source characters.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import pieces

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

#: Fixed patterns. A local part cannot begin inside the one before it, and a run of digits
#: fails as a whole or not at all, so the look-behind and possessive forms find the same.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the address pattern, found from each `@`."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    for m in IP.finditer(text):
        if all(len(p) < 4000 and int(p) <= 255 for p in (x.lstrip("0")[:4] or "0" for x in m[0].split("."))):
            yield m.span()


def luhn(digits: list[int]) -> bool:
    twice = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = [int(c) for c in m[0] if c not in " -"]
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                yield m.span()


DETECTORS: tuple[tuple[str, Callable[[str], Iterator[Span]]], ...] = (
    ("email", emails), ("ip", ips), ("card", cards), ("phone", phones))

# --- transducers ------------------------------------------------------------
#: Letters that look like ASCII ones, in the order of their look-alikes.
LOOK_ALIKES = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "ԝ": "w", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H",
    "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "Α": "A", "Β": "B",
    "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a", "。": ".", "․": ".", "﹒": ".", "‐": "-", "‑": "-",
    "‒": "-", "–": "-", "﹣": "-", "﹫": "@", "\u00a0": " ", "\u2009": " ", "\u202f": " ",
}
#: Characters without width.
INVISIBLE = frozenset("\u00ad\u200b\u200c\u200d\u2060\ufeff")
#: Digits as words, by language (English, French, German, Spanish).
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}


def plain_char(c: str) -> str:
    """ASCII form of a look-alike, a digit of any script or a full-width or styled character."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    wide = unicodedata.normalize("NFKC", c) if unicodedata.decomposition(c).startswith("<") else c
    return wide if len(wide) == 1 and wide.isascii() else c


_plain: dict[str, str] = {}
_word = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
#: "dot" in brackets; a dot inside a run of spelled digits may also be the word or a point with
#: the same on both sides: blanks, commas, hyphens or, for a point, nothing.
BRACKETED_DOT = r"\s{0,3}[(\[{<]\s{0,3}(?:dot|\.|point|punkt|punto)\s{0,3}[)\]}>]\s{0,3}"
_dot = rf"(?:[\s,-]{{1,3}}(?:dot|point|punkt|punto|\.)[\s,-]{{1,3}}|{BRACKETED_DOT}|\.)"
_item = rf"(?:{_word}|[0-9]+)"
_between = rf"(?:[\s,-]{{1,3}}|{_dot})"
#: Three or more digits in a row of which one at least is a word, with blanks, commas, hyphens or
#: dots between; "plus" before them.
SPELLED = re.compile(rf"(?<!\w)(?:plus[\s-]+)?(?:{_item}{_between}){{2,}}{_item}(?!\w)", re.I)
SPELLED_HINT = re.compile(rf"(?<!\w)(?:{_word}){_between}{_item}(?!\w)|[0-9]{_dot}(?:{_word})(?!\w)", re.I)
#: What a run of spelled digits consists of, but for blanks, commas and hyphens.
TOKEN = re.compile(rf"(?<!\w)(?:(?P<plus>plus)|(?P<word>{_word})|[0-9]+)(?!\w)|(?P<dot>{_dot})", re.I)
#: "at" and "dot" in brackets, or bare between words when both stand there.
AT = re.compile(r"\s{0,3}[(\[{<]\s{0,3}(?:at|@|arobase|arroba)\s{0,3}[)\]}>]\s{0,3}", re.I)
DOT = re.compile(BRACKETED_DOT, re.I)
NEAR = r"[A-Za-z0-9-]{1,63}"
BARE = re.compile(rf"(?<=[A-Za-z0-9])(?:\s{{1,3}}at\s{{1,3}}|@)(?={NEAR}(?:\.{NEAR}){{0,3}}\s{{1,3}}dot\s{{1,3}}[A-Za-z0-9])", re.I)
BARE_DOT = re.compile(r"(?<=[A-Za-z0-9])\s{1,3}dot\s{1,3}(?=[A-Za-z0-9])", re.I)


class Rewritten:
    """A text with, for each stretch that was replaced, where it came from."""

    def __init__(self, text: str):
        self.text = text
        self.steps: list[tuple[list[int], list[int], list[int], list[int]]] = []

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Applies edits (start, end, new), in order and without overlap."""
        if not edits:
            return
        out, at, n = [], 0, 0
        new_start, new_end, old_start, old_end = [], [], [], []
        for start, end, new in edits:
            out += [self.text[at:start], new]
            n += start - at
            new_start.append(n)
            old_start.append(start)
            n += len(new)
            new_end.append(n)
            old_end.append(end)
            at = end
        out.append(self.text[at:])
        self.text = "".join(out)
        self.steps.append((new_start, new_end, old_start, old_end))

    def source(self, start: int, end: int) -> Span:
        """Source characters that the characters from start to end stand for."""
        for new_start, new_end, old_start, old_end in reversed(self.steps):
            k = bisect_right(new_start, start) - 1
            while k >= 0 and new_start[k] == new_end[k] == start:  # a deletion just before
                k -= 1
            if k >= 0:
                inside = start < new_end[k]
                start = old_start[k] if inside else old_end[k] + start - new_end[k]
                if not inside:  # what was deleted just before the first character stays out
                    for j in range(k + 1, len(old_start)):
                        if old_start[j] != start or new_start[j] != new_end[j]:
                            break
                        start = old_end[j]
            elif new_start and new_start[0] == new_end[0]:
                for j in range(len(old_start)):
                    if old_start[j] != start or new_start[j] != new_end[j]:
                        break
                    start = old_end[j]
            last = end - 1
            k = bisect_right(new_start, last) - 1
            while k >= 0 and new_start[k] == new_end[k] and new_start[k] > last:
                k -= 1
            if k >= 0:
                end = old_end[k] if last < new_end[k] else old_end[k] + last - new_end[k] + 1
        return start, end


def characters(r: Rewritten) -> None:
    if r.text.isascii():
        return
    for c in set(r.text) - _plain.keys():
        _plain[c] = c if c.isascii() else plain_char(c)
    strange = [c for c in set(r.text) if _plain[c] != c]
    if strange:
        found = re.compile("[" + re.escape("".join(strange)) + "]")
        r.replace([(m.start(), m.end(), _plain[m[0]]) for m in found.finditer(r.text)])


def spelled_digits(r: Rewritten) -> None:
    if not SPELLED_HINT.search(r.text):
        return
    edits: list[tuple[int, int, str]] = []
    for m in SPELLED.finditer(r.text):
        tokens = list(TOKEN.finditer(r.text, *m.span()))
        if not any(t["word"] for t in tokens):
            continue
        for t, after in zip(tokens, [*tokens[1:], None]):
            if t["dot"]:  # `signs` settles whether it is one
                edits.append((*t.span(), t[0] if t[0] == "." else " dot "))
            elif t["plus"]:  # nothing stands between a plus and its digits
                edits.append((t.start(), after.start(), "+"))
            elif t["word"]:
                end = after.start() if after and after["word"] else t.end()
                edits.append((t.start(), end, DIGIT_WORDS[t["word"].lower()]))
    r.replace(edits)


def signs(r: Rewritten) -> None:
    if re.search(r"[(\[{<]\s{0,3}(?:at|@|dot|\.|arobase|arroba|point|punkt|punto)\s{0,3}[)\]}>]", r.text, re.I):
        for pattern, new in ((AT, "@"), (DOT, ".")):
            r.replace([(m.start(), m.end(), new) for m in pattern.finditer(r.text)])
    if BARE_DOT.search(r.text):
        r.replace([(m.start(), m.end(), "@") for m in BARE.finditer(r.text)])
        near = [m for m in BARE_DOT.finditer(r.text)]
        # A bare "dot" counts in an address (after an `@` in the same word) or between digits.
        edits, end = [], -1
        for m in near:
            left = r.text[max(0, m.start() - 64):m.start()]
            word = re.split(r"\s", left)[-1]
            digits = r.text[m.start() - 1].isdigit() and r.text[m.end()].isdigit()
            if "@" in word or digits or m.start() - end <= 64 and " " not in r.text[end:m.start()].strip() and end >= 0:
                edits.append((m.start(), m.end(), "."))
                end = m.end()
            elif re.match(rf"{NEAR}(?:\.{NEAR}){{0,2}}@", r.text[m.end():m.end() + 200]):
                edits.append((m.start(), m.end(), "."))
        r.replace(edits)


TRANSDUCERS = (characters, spelled_digits, signs)


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the source text as it is, and all spans: those and the disguised ones that lie
    in none of the same kind. Sorted by kind, as listed, start and end."""
    base = [(kind, s, e) for kind, detect in DETECTORS for s, e in detect(text)]
    r = Rewritten(text)
    for step in TRANSDUCERS:
        step(r)
    if not r.steps:
        return base, base
    every = list(base)
    for kind, detect in DETECTORS:
        taken = sorted((s, e) for k, s, e in base if k == kind)
        starts = [s for s, _ in taken]
        for s, e in (r.source(*x) for x in detect(r.text)):
            k = bisect_right(starts, s) - 1
            if k < 0 or taken[k][1] < e:  # the plain part of an identifier does not hide the whole
                every.append((kind, s, e))
    every.sort(key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return base, every


SCHEMA = "doc_id long, base array<struct<kind:string,start:int,stop:int>>, spans array<struct<kind:string,start:int,stop:int>>"


def detect_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        for part in pieces(batch, "text"):
            found = [find(t or "") for t in part.column("text").to_pylist()]
            rows = [[[{"kind": k, "start": s, "stop": e} for k, s, e in f[i]] for f in found] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(rows[0], span), pa.array(rows[1], span)],
                ["doc_id", "base", "spans"])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id, base and spans (lists of kind, start, stop in code points).

    `base` are the plain matches, `spans` those and the disguised ones, which may contain or
    overlap a plain one that is a part of them. A null text is empty
    and has none; ids may be null or repeat; other columns are not read; an empty table gives
    no rows. A text is always read whole; work is linear in its length.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(detect_batches, SCHEMA)
