"""Quality classifier: linear support vectors over n-gram indicators scaled by naive Bayes.

Features are the distinct words, word pairs and repetitions of one word in a whole text, hashed
to a fixed number of slots. Over all labelled training rows each class counts the documents that hold a slot;
the log ratio of the two smoothed shares scales the slot's indicator. A linear model with
hinge loss is fitted to the scaled indicators by dual coordinate descent, on a sample of
labelled rows whose size is bounded by FIT_ROWS; then its weights are interpolated with their
mean size, and a logistic curve turns margins into scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm.common import distinct, may_have, mix, pieces, stored, utf8, word_hashes

#: Fixed production parameters: log2 of slots, rows the model is fitted to at most, smoothing,
#: cost of a margin error, share of the fitted weights, passes over the sample, decision.
BITS = 18
FIT_ROWS = 8192
SMOOTH = 1.0
COST = 1.0
BETA = 0.5
PASSES = 20
DECIDE = 0.3
SLICE = 4096
#: Lengths n of a word repeated n times that have a slot of their own.
REPEATS = (2, 3, 4, 6, 8, 12)
#: Parts into which partial counts are dealt before the last sum.
LANES = 64


def held_out(doc_id: str | Column) -> Column:
    """Documents never learned from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def slots(data: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots of each text, one after the other, and where each text's begin."""
    words, doc = word_hashes(data, at)
    pair = mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) > 1 else words[:0]
    same = doc[:-1] == doc[1:]
    # One word n times over is an n-gram of its own, whatever the word.
    run = np.concatenate([[False], (words[:-1] == words[1:]) & same, [False]]) if len(words) else np.zeros(2, bool)
    begin, end = np.flatnonzero(run[1:] & ~run[:-1]), np.flatnonzero(run[:-1] & ~run[1:])
    again = [(doc[begin[end - begin + 1 >= n]].astype(np.uint64) << np.uint64(bits))
             | (mix(np.array([n], np.uint64)) >> np.uint64(64 - bits)) for n in REPEATS]
    shift = np.uint64(64 - bits)
    keys = np.concatenate([(doc.astype(np.uint64) << np.uint64(bits)) | (words >> shift),
                           (doc[:-1][same].astype(np.uint64) << np.uint64(bits)) | (pair[same] >> shift), *again])
    keys = distinct(keys)
    starts = np.searchsorted(keys, np.arange(len(at), dtype=np.uint64) << np.uint64(bits))
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int32), starts


COUNTED = "part int, slice int, row long, label int, data binary"


def counter(bits: int):
    """Counts documents per class and slot in a task; rows to fit pass through as slot lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        counts = np.zeros((2, 1 << bits), np.int64)
        names = ["part", "slice", "row", "label", "data"]
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, at = slots(*utf8(piece.column("text")), bits)
                label = piece.column("label").to_numpy(zero_copy_only=False)
                fit = piece.column("fit").to_numpy(zero_copy_only=False)
                per = np.repeat(label, np.diff(at))
                for c in (0, 1):
                    counts[c] += np.bincount(found[per == c], minlength=1 << bits)
                rows = np.flatnonzero(fit)
                if len(rows):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(rows), -1, np.int32)), pa.array(np.full(len(rows), -1, np.int32)),
                        piece.column("doc_id").take(pa.array(rows)).cast(pa.int64()), pa.array(label[rows].astype(np.int32)),
                        pa.array([found[at[i]:at[i + 1]].tobytes() for i in rows], pa.binary())], names)
        part = TaskContext.get().partitionId()
        step = min(SLICE, 1 << bits)
        data = [counts[:, i:i + step].tobytes() for i in range(0, 1 << bits, step)]
        if counts.any():
            k = np.arange(len(data), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(k), part % LANES, np.int32)), pa.array(k), pa.nulls(len(k), pa.int64()),
                pa.nulls(len(k), pa.int32()), pa.array(data, pa.binary())], names)
    return run


def add_up(group: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(group["data"].iloc[0], np.int64).copy()
    for d in group["data"][1:]:
        total += np.frombuffer(d, np.int64)
    return pd.DataFrame({"slice": [group["slice"].iloc[0]], "data": [total.tobytes()]})


def fit_model(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = COST,
              beta: float = BETA, passes: int = PASSES, seed: int = 7) -> np.ndarray:
    """Weights per slot (already times the slot's ratio), bias, and the curve's slope and shift.

    Dual coordinate descent for hinge loss: each step finds the best multiplier of one row,
    within 0 and `cost`, with all others fixed. The bias is the weight of a slot that every
    row has.
    """
    n = len(rows)
    w = np.zeros(len(ratio))
    bias = 0.0
    values = [ratio[r] for r in rows]
    size = np.array([v @ v + 1.0 for v in values])
    alpha = np.zeros(n)
    rng = np.random.default_rng(seed)
    weight = np.where(y > 0, 1.0, max(1.0, min(10.0, (y > 0).sum() / max(1, (y < 0).sum()))))
    for _ in range(passes):
        worst = 0.0
        for i in rng.permutation(n):
            slope = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / size[i], 0.0), cost * weight[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * y[i] * values[i]
                bias += step * y[i]
                worst = max(worst, abs(step))
        if worst < 1e-4:
            break
    w = beta * w + (1 - beta) * np.abs(w).mean()
    w = w * ratio
    margin = np.array([w[r].sum() + bias for r in rows])
    # Logistic curve through the margins, by Newton's method with smoothed targets.
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        v = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(v * margin**2).sum() + 1e-6, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([w, [bias, a, b]])


def train(docs: DataFrame, labels: DataFrame, bits: int = BITS, fit_rows: int = FIT_ROWS,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """The model as one vector, from labelled rows that are not held out.

    A document with several labels takes the lowest; null labels and labels without a document
    count for nothing. Class counts cover all rows; the fit takes the `fit_rows` with the
    smallest hash of the id. With fewer than two classes every score is the share of class 1
    among the labels (1 without labels).
    """
    spark = docs.sparkSession
    given = stored(labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
                   .where("doc_id is not null and label in (0, 1)").where(~held_out("doc_id"))
                   .groupBy("doc_id").agg(F.min("label").alias("label")), "quality-labels")
    chosen = given.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows) \
        .select(F.col("doc_id").alias("fit_id"))
    given = given.join(F.broadcast(chosen), F.col("doc_id") == F.col("fit_id"), "left") \
        .select("doc_id", "label", F.col("fit_id").isNotNull().alias("fit"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Only texts that may have a label go through the exchange of the join.
    counted = stored(may_have(texts, given, "doc_id").join(given.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "label", "fit")
                     .mapInArrow(counter(bits), COUNTED), "quality-counts")
    sums = counted.where("slice >= 0").groupBy("slice", "part").applyInPandas(add_up, "slice int, data binary") \
        .groupBy("slice").applyInPandas(add_up, "slice int, data binary").orderBy("slice").collect()
    if not sums:
        return np.array([0.0] * (1 << bits) + [0.0, 0.0, 30.0])
    counts = np.concatenate([np.frombuffer(r["data"], np.int64).reshape(2, -1) for r in sums], axis=1) + SMOOTH
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    shared = spark.sparkContext.broadcast(ratio)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels_ = [], []
        for batch in batches:
            rows += [(i, np.frombuffer(d, np.int32)) for i, d in
                     zip(batch.column("row").to_pylist(), batch.column("data").to_pylist())]
            labels_ += batch.column("label").to_pylist()
        order = sorted(range(len(rows)), key=lambda i: (rows[i][0], labels_[i], len(rows[i][1])))
        y = np.array([2.0 * labels_[i] - 1 for i in order])
        if len(set(y)) < 2:
            share = (y > 0).mean() if len(y) else 1.0
            model = np.zeros(len(shared.value) + 3)
            model[-1] = 30.0 if share else -30.0
        else:
            model = fit_model([rows[i][1] for i in order], y, shared.value)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], ["model"])

    model = counted.where("slice < 0").select("row", "label", "data").repartition(1) \
        .mapInArrow(fit, "model binary").first()
    return np.frombuffer(model["model"]) if model else np.array([0.0] * (1 << bits) + [0.0, 0.0, 30.0])


def scores(texts: pa.Array, model: np.ndarray, bits: int) -> np.ndarray:
    w, (bias, a, b) = model[:-3], model[-3:]
    found, at = slots(*utf8(texts), bits)
    # Sums per text, so that a text's score does not depend on its neighbours.
    sums = np.array([w[found[i:j]].sum() for i, j in zip(at, at[1:])])
    return 1 / (1 + np.exp(-np.clip(a * (sums + bias) + b, -700, 700)))


def score(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          decide: float = DECIDE) -> DataFrame:
    """A row per input row: doc_id, held_out, score, predicted. Only id and text are read."""
    bits = int(np.log2(len(model) - 3))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                p = scores(piece.column("text"), shared.value, bits)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, score double") \
        .select("doc_id", held_out("doc_id").alias("held_out"), "score",
                (F.col("score") >= decide).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: np.ndarray, text_col: str = "text", decide: float = DECIDE) -> DataFrame:
    """The rows of `docs`, with all their columns, whose score is at least `decide`. Null and empty
    texts have the score of the bias; each row is judged by its own text, so rows that share an id
    or a text are kept or not each for itself; an empty table stays empty."""
    bits = int(np.log2(len(model) - 3))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                yield piece.filter(pa.array(scores(piece.column(text_col), shared.value, bits) >= decide))

    return docs.mapInArrow(run, docs.schema)


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Learns from the labelled rows that are not held out and scores every row of `docs`.

    Null and empty texts are scored (they have no slots, so the bias decides); a null id counts
    as held out; ids may repeat; empty tables give an empty result or scores of a model
    without labels; other columns are not read.
    """
    return score(docs, train(docs, labels, **options))
