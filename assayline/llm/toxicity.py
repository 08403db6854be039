"""Toxicity classifier whose scores are not to change when identity terms are swapped.

Features are the distinct words, word pairs and word beginnings of a whole text, hashed to a
fixed number of slots. A linear model with logistic loss is fitted to labelled rows; besides its
weights' size it is charged for each change of a score between a labelled text and its
counterfactuals, the same text with every identity term replaced by another of its kind. Terms
that stand in many toxic texts by the way they are talked about thus lose their weight, and
neutral mentions of a group are not taken for toxic; the words around them keep theirs.

What is fitted is a bounded sample of labelled rows: FIT_ROWS of either class, and the rows with
identity terms among SAMPLE labelled ones. Their ids alone are sent out, so that the texts of
other rows move nowhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import GOLDEN, distinct, mix, pieces, prefix_sums, stored, stretch, utf8
from assayline.llm.quality import held_out

#: Fixed production parameters: log2 of slots, labelled ids looked at, rows of a class that are
#: fitted, rows with identity terms that are fitted, counterfactuals of each, lengths in bytes of
#: word beginnings, cost of weights, of a change of score, most steps of the fit, decision.
BITS = 18
SAMPLE = 65536
FIT_ROWS = 4096
PAIR_ROWS = 4096
SWAPS = 3
BEGINNINGS = (4, 5, 6)
L2 = 0.02
COUNTERFACTUAL = 5.0
STEPS = 60
DECIDE = 0.5

#: Terms that name groups of people, by kind; each may stand for another of its line.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("black", "white", "asian", "african", "latino", "arab", "european"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("mexican", "american", "chinese", "indian", "russian", "german", "french", "turkish"),
    ("mexicans", "americans", "indians", "russians", "germans", "turks"),
    ("immigrant", "refugee", "foreigner", "citizen"), ("immigrants", "refugees", "foreigners", "citizens"),
    ("deaf", "blind", "disabled", "autistic"),
    ("frau", "mann"), ("frauen", "männer"), ("christen", "muslime", "juden"),
    ("ausländer", "flüchtling", "einheimischer"), ("schwul", "lesbisch", "hetero"),
    ("femme", "homme"), ("femmes", "hommes"), ("chrétien", "musulman", "juif"), ("chrétiens", "musulmans", "juifs"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("cristiano", "musulmán", "judío"), ("cristianos", "musulmanes", "judíos"),
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def slots(data: np.ndarray, at: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of each text, one text after the other, and where each text's begin."""
    letter = np.append(_LETTER[data], False)
    inner = np.zeros(len(data) + 1, bool)
    inner[1:] = letter[:-1]
    inner[at] = False  # a word does not reach into the next text
    start = np.flatnonzero(letter & ~inner)
    doc = np.searchsorted(at, start, "right") - 1
    # A word ends where a byte that is no letter, or the next text, begins.
    stop = np.flatnonzero(~letter)
    stop = distinct(np.concatenate([stop, at]))
    end = stop[np.searchsorted(stop, start, "right")]
    sums = prefix_sums(_LOWER[data])
    word = stretch(sums, start, end)
    found, owner = [word], [doc]
    for n in BEGINNINGS:
        own = end - start >= n
        found.append(mix(stretch(sums, start[own], start[own] + n) + np.uint64(n)))
        owner.append(doc[own])
    if len(word) > 1:
        same = doc[1:] == doc[:-1]
        found.append(mix(word[:-1] * np.uint64(3) + word[1:] + GOLDEN)[same])
        owner.append(doc[1:][same])
    shift = np.uint64(64 - bits)
    keys = distinct((np.concatenate(owner).astype(np.uint64) << np.uint64(bits)) | (np.concatenate(found) >> shift))
    starts = np.searchsorted(keys, np.arange(len(at), dtype=np.uint64) << np.uint64(bits))
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int32), starts


_WORDS = re.compile(r"\w+")


class Swaps:
    """Counterfactuals of a text."""

    def __init__(self, terms: Sequence[Sequence[str]] = IDENTITY_TERMS):
        self.kind = {t: kind for kind in terms for t in kind}
        every = sorted(self.kind, key=lambda t: (-len(t), t))
        self.find = re.compile(r"\b(?:" + "|".join(map(re.escape, every)) + r")\b", re.I) if every else None

    def has(self, text: str) -> bool:
        return not self.kind.keys().isdisjoint(_WORDS.findall(text.lower()))

    def of(self, text: str, by: int) -> str:
        """Every identity term is replaced by the one `by` places on in its line, round and round."""
        def other(m: re.Match) -> str:
            kind = self.kind.get(m[0].lower())
            if kind is None:  # a letter whose lower case is of another form
                return m[0]
            i = kind.index(m[0].lower())
            step = 1 + (by - 1) % max(1, len(kind) - 1)
            return kind[(i + step) % len(kind)]
        return self.find.sub(other, text)


FOUND = "row long, label int, fit boolean, slots binary, others array<binary>"


def features(bits: int, swaps: int, terms: Sequence[Sequence[str]]):
    """Slots of sampled rows, and those of their counterfactuals where they have identity terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swap = Swaps(terms)
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = [t or "" for t in piece.column("text").to_pylist()]
                named = [swap.has(t) for t in texts]
                keep = [i for i, f in enumerate(piece.column("fit").to_pylist()) if f or named[i]]
                piece = piece.take(pa.array(keep, pa.int64()))
                own, at = slots(*utf8(piece.column("text")), bits)
                others: list[list[bytes] | None] = []
                for i in keep:
                    made = [swap.of(texts[i], by) for by in range(1, swaps + 1)] if named[i] else []
                    there = [slots(*utf8(pa.array([m])), bits)[0] for m in dict.fromkeys(made) if m != texts[i]]
                    others.append([s.tobytes() for s in there] or None)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id").cast(pa.int64()), piece.column("label").cast(pa.int32()), piece.column("fit"),
                    pa.array([own[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary()),
                    pa.array(others, pa.list_(pa.binary()))], ["row", "label", "fit", "slots", "others"])
    return run


class Rows:
    """Sparse rows: margins of all of them, and the sum of rows times given factors."""

    def __init__(self, rows: list[np.ndarray], signs: list[np.ndarray] | None = None):
        self.n = len(rows)
        self.at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        self.slot = np.concatenate(rows) if rows else np.empty(0, np.int32)
        self.sign = np.concatenate(signs) if signs else None

    def times(self, w: np.ndarray) -> np.ndarray:
        x = w[self.slot] if self.sign is None else w[self.slot] * self.sign
        sums = np.concatenate([[0.0], np.cumsum(x)])
        return sums[self.at[1:]] - sums[self.at[:-1]]

    def back(self, factor: np.ndarray, size: int) -> np.ndarray:
        x = np.repeat(factor, np.diff(self.at))
        return np.bincount(self.slot, x if self.sign is None else x * self.sign, size)


def changes(rows: list[np.ndarray], others: list[list[np.ndarray]]) -> Rows:
    """A sparse row per counterfactual: +1 at slots the text alone has, -1 at those it alone has."""
    slot, sign = [], []
    for own, made in zip(rows, others):
        for other in made:
            lost, new = np.setdiff1d(own, other), np.setdiff1d(other, own)
            slot.append(np.concatenate([lost, new]))
            sign.append(np.concatenate([np.ones(len(lost)), -np.ones(len(new))]))
    return Rows(slot, sign)


def ratios(rows: Rows, y: np.ndarray, size: int) -> np.ndarray:
    """Log ratio of the shares of the two classes that have a slot, each smoothed by one row."""
    share = [(rows.back((y == c).astype(float), size) + 1) / ((y == c).sum() + 2) for c in (1, -1)]
    return np.log(share[0]) - np.log(share[1])


def fit_model(rows: Rows, y: np.ndarray, weight: np.ndarray, pairs: Rows, size: int, l2: float = L2,
              counterfactual: float = COUNTERFACTUAL, steps: int = STEPS) -> np.ndarray:
    """Weights per slot and a bias that minimise the mean weighted logistic loss, plus l2 / 2 times
    the squared weights, plus counterfactual / 2 times the mean squared change of a margin.

    A weight's size is measured against the slot's log ratio, so that slots which tell the classes
    apart are cheap and the many that do not hardly move. Limited-memory BFGS from zero, with
    halved steps until the loss falls enough; y is 1 or -1.
    """
    weight = weight / weight.sum()
    scale = ratios(rows, y, size)

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        w = v[:-1] * scale
        margin = y * (rows.times(w) + v[-1])
        away = -y * weight / (1 + np.exp(np.clip(margin, -500, 500)))
        value = (weight * np.logaddexp(0, -margin)).sum() + l2 / 2 * (v[:-1] @ v[:-1])
        grad = np.append(rows.back(away, size) * scale + l2 * v[:-1], away.sum())
        if pairs.n:
            change = pairs.times(w)
            value += counterfactual / 2 * (change @ change) / pairs.n
            grad[:-1] += pairs.back(counterfactual * change / pairs.n, size) * scale
        return float(value), grad

    w = np.zeros(size + 1)
    value, grad = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, used = grad.copy(), []
        for s, d in reversed(past):
            a = (s @ q) / (s @ d)
            used.append(a)
            q -= a * d
        if past:
            s, d = past[-1]
            q *= (s @ d) / (d @ d)
        for (s, d), a in zip(past, reversed(used)):
            q += s * (a - (d @ q) / (s @ d))
        slope, step = -(grad @ q), 1.0
        while step > 1e-10:
            new_value, new_grad = loss(w - step * q)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, d = -step * q, new_grad - grad
        if s @ d > 1e-12:
            past = [*past, (s, d)][-10:]
        fall, w, value, grad = value - new_value, w + s, new_value, new_grad
        if fall < 1e-8 * max(1.0, abs(value)):
            break
    return np.append(w[:-1] * scale, w[-1])


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS, sample: int = SAMPLE, fit_rows: int = FIT_ROWS,
          pair_rows: int = PAIR_ROWS, swaps: int = SWAPS, counterfactual: float = COUNTERFACTUAL, l2: float = L2,
          terms: Sequence[Sequence[str]] = IDENTITY_TERMS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> np.ndarray:
    """The model: weights per slot and bias, from labelled rows that are not held out.

    Of each class the `fit_rows` ids with the smallest hash are fitted, and both classes weigh the
    same; counterfactuals are those of the `pair_rows` rows of smallest hash
    with identity terms among the `sample` labelled ids of smallest hash. A document with several
    labels takes the lowest; of rows that share an id one is taken (the one whose slots come first
    in order); null labels and ids and labels without a document count for nothing. Without both
    classes every score is the share of class 1 among the labels (0 without labels).
    """
    spark = docs.sparkSession
    given = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")) \
        .where("doc_id is not null and label in (0, 1)").where(~held_out("doc_id")) \
        .groupBy("doc_id").agg(F.min("label").alias("label"))
    given = stored(given.withColumn("h", F.xxhash64("doc_id")), "toxicity-labels")
    classes = {r["label"] for r in given.select("label").distinct().collect()}
    constant = np.zeros((1 << bits) + 1)
    constant[-1] = 30.0 if classes == {1} else -30.0
    if len(classes) < 2:
        return constant
    order = [F.col("h"), F.col("doc_id")]
    # Three plain top-k reads; at most `sample` + 2 `fit_rows` ids are sent out.
    fit = given.where("label = 1").orderBy(*order).limit(fit_rows).unionByName(given.where("label = 0").orderBy(*order).limit(fit_rows))
    chosen = fit.withColumn("fit", F.lit(True)).unionByName(given.orderBy(*order).limit(sample).withColumn("fit", F.lit(False))) \
        .groupBy("doc_id", "label").agg(F.max("fit").alias("fit"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "fit", "text") \
        .mapInArrow(features(bits, swaps, terms), FOUND)
    found = stored(found.groupBy("row", "label", "fit").agg(F.min(F.struct("slots", "others")).alias("x"))
                   .select("row", "label", "fit", "x.slots", F.expr("x.others").alias("others"), F.xxhash64("row").alias("h")), "toxicity-slots")
    fitted = found.where("fit").select("row", "label", "slots", F.lit(None).cast("array<binary>").alias("others"))
    paired = found.where("others is not null").orderBy("h", "row").limit(pair_rows).select("row", "label", "slots", "others")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["others"] is not None, r["row"]))

        def own(r: dict) -> np.ndarray:
            return np.frombuffer(r["slots"], np.int32)
        main = [r for r in rows if r["others"] is None]
        pair = [r for r in rows if r["others"] is not None]
        y = np.array([2.0 * r["label"] - 1 for r in main])
        if len(set(y)) < 2:
            model = constant.copy()
            model[-1] = 30.0 if len(y) and y[0] > 0 else -30.0
        else:
            weight = np.where(y > 0, 1 / (y > 0).sum(), 1 / (y < 0).sum())
            model = fit_model(Rows([own(r) for r in main]), y, weight,
                              changes([own(r) for r in pair], [[np.frombuffer(o, np.int32) for o in r["others"]] for r in pair]),
                              1 << bits, l2, counterfactual)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], ["model"])

    model = fitted.unionByName(paired).repartition(1).mapInArrow(solve, "model binary").first()
    return np.frombuffer(model["model"]) if model else constant


def scores(texts: pa.Array, model: np.ndarray, bits: int) -> np.ndarray:
    found, at = slots(*utf8(texts), bits)
    # Summed per text, so that a score does not depend on the texts beside it.
    margin = np.array([model[found[i:j]].sum() for i, j in zip(at, at[1:])]) + model[-1]
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def score(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text", decide: float = DECIDE) -> DataFrame:
    """A row per input row: doc_id, held_out, score, predicted. Only id and text are read."""
    bits = int(np.log2(len(model) - 1))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(scores(piece.column("text"), shared.value, bits))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, score double") \
        .select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= decide).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Learns from the labelled rows that are not held out and scores every row of `docs`.

    Null and empty texts are scored by the bias alone; a null id counts as held out; ids may
    repeat; texts of any length are read whole; an empty table gives no rows, and without labels
    every score is that of class 0. Other columns are not read.
    """
    return score(docs, train(docs, labels, **options))
