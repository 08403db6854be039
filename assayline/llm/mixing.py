"""Mixing sources to target weights by temperature.

Each source's share of all tokens is raised to an exponent and normalised again. The exponent
is found by bisection: the smallest in [0, 1] (the flattest mixture) whose entropy does not
exceed a target and at which no source is repeated more often than allowed. The weights
become budgets of tokens, and a budget becomes blocks: the documents of a source lie in
blocks, every epoch takes the blocks in another order, and the last epoch ends where the
budget does.

The end is found as in a search by digits: tokens per block, then per sub-block of the one
block in which the budget ends, then per document of one sub-block. So no task sorts the
documents of a whole source, however large it is.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayline.llm.common import stored

#: Fixed production parameters.
MAX_EPOCHS = 4.0
SEED = "mix"
#: Hex digits of the block and sub-block of a document: 256 and 4096.
BLOCK_DIGITS, SUB_DIGITS = 2, 3
#: Bisection steps, and how many of them one pass over the shares answers.
STEPS, AT_ONCE = 50, 5
#: A plan of at most so many rows may be broadcast; a longer one is joined by shuffling.
SMALL_PLAN = 50_000


def words(text: str | Column) -> Column:
    """Tokens of a text where no tokenizer is given: words between white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def bisect_exponent(shares: DataFrame, max_epochs: float | None = MAX_EPOCHS,
                    target_entropy: float | None = None, budget: int | None = None) -> dict:
    """Exponent, budget and norm for `shares` (source, tokens; tokens above 0).

    Both the entropy and the largest number of epochs fall as the exponent grows. One pass
    aggregates both at the 31 midpoints that the next five halvings can ask for, so the driver
    sees a few numbers however many sources there are. Without `budget`, the budget is the
    smallest at which every source is read in full once. If no exponent is good enough, it is 1.
    """
    top = shares.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("most"),
                     F.min("tokens").alias("least")).first()
    if not top["all"]:
        return {"exponent": 1.0, "budget": 0, "norm": 1.0}
    total, share = float(top["all"]), F.col("tokens") / F.lit(float(top["all"]))

    def at(points: list[float]) -> list[tuple[float, float]]:
        """Norm and entropy at each exponent."""
        aggs = []
        for k, e in enumerate(points):
            p = F.pow(share, F.lit(e))
            aggs += [F.sum(p).alias(f"n{k}"), F.sum(p * F.log(share) * e).alias(f"l{k}")]
        r = shares.agg(*aggs).first()
        return [(r[f"n{k}"], math.log(r[f"n{k}"]) - r[f"l{k}"] / r[f"n{k}"]) for k in range(len(points))]

    def tokens(e: float, norm: float) -> float:
        if budget is not None:
            return float(budget)
        return float(top["most"]) * norm / (float(top["most"]) / total) ** e

    def good(e: float, norm: float, entropy: float) -> bool:
        least = float(top["least"])
        epochs = (least / total) ** e / norm * tokens(e, norm) / least
        return (max_epochs is None or epochs <= max_epochs) and \
            (target_entropy is None or entropy <= target_entropy)

    low, high = 0.0, 1.0
    (n0, h0), (n1, _) = at([0.0, 1.0])
    if good(0.0, n0, h0):
        high, norm = 0.0, n0
    else:
        norm = n1
        for _ in range(STEPS // AT_ONCE):
            width = (high - low) / 2 ** AT_ONCE
            points = [low + width * k for k in range(1, 2 ** AT_ONCE)]
            known = dict(zip(points, at(points)))
            a, b = 0, 2 ** AT_ONCE
            while b - a > 1:
                mid = (a + b) // 2
                e = points[mid - 1]
                if good(e, *known[e]):
                    b, high, norm = mid, e, known[e][0]
                else:
                    a, low = mid, e
    return {"exponent": high, "budget": int(tokens(high, norm) + 1e-6), "norm": norm}


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
          tokens: Column | None = None, max_epochs: float | None = MAX_EPOCHS,
          target_entropy: float | None = None, budget: int | None = None,
          seed: str = SEED) -> DataFrame:
    """A row per document taken, once per epoch: doc_id, source, n_tokens, epoch, block,
    block_start, weight, copy_of.

    `block_start` is where the block begins in its source's stream of `budget * weight`
    tokens; ordering by its share of that budget interleaves the sources at their weights.
    `epoch` counts from 0. A null source is a source of its own; sources without any token
    have weight 0 and none of their documents is taken; documents without tokens go with
    their block. Rows that share an id are separate documents with the same place in the order.
    The last document taken may pass the end of its budget. An empty table gives no rows.
    Other columns are not read. `copy_of` numbers the rows of the input.
    """
    count = words(docs["text"]) if tokens is None else tokens
    slim = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), count.alias("n_tokens"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("h"))
        .withColumn("block", F.substring("h", 1, BLOCK_DIGITS))
        .withColumn("row", F.monotonically_increasing_id()), "mix-docs")
    blocks = stored(slim.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")),
                    "mix-blocks")
    shares = stored(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens"))
                    .where("tokens > 0"), "mix-shares")
    found = bisect_exponent(shares, max_epochs, target_entropy, budget)
    total = shares.agg(F.sum("tokens")).first()[0] or 1
    plan = shares.withColumn("weight", F.pow(F.col("tokens") / F.lit(float(total)),
                                             F.lit(found["exponent"])) / F.lit(found["norm"])) \
        .withColumn("budget", F.floor(F.col("weight") * found["budget"] + 1e-6)) \
        .withColumn("budget", F.greatest("budget", "tokens") if budget is None else F.col("budget")) \
        .select(F.col("source").alias("s"), "weight", "budget", F.col("tokens").alias("size"),
                F.floor(F.col("budget") / F.col("tokens")).alias("full"),
                (F.col("budget") % F.col("tokens")).alias("rest"))

    def order(*parts) -> Column:
        return F.md5(F.concat_ws(":", F.lit(seed), *[F.col(p).cast("string") for p in parts]))

    # Blocks of every epoch in their order; `start` is where each begins in its epoch.
    same = F.col("source").eqNullSafe(F.col("s"))
    epochs = blocks.join(plan, same).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full")))) \
        .withColumn("key", order("epoch", "block"))
    line = Window.partitionBy("source", "epoch").orderBy("key", "block")
    before = F.sum("tokens").over(line.rowsBetween(Window.unboundedPreceding, -1))
    epochs = stored(epochs.withColumn("start", F.coalesce(before, F.lit(0))).where(
        (F.col("epoch") < F.col("full")) | (F.col("start") < F.col("rest"))), "mix-plan")
    cut = (F.col("epoch") == F.col("full")) & (F.col("start") + F.col("tokens") > F.col("rest"))
    whole, ends = epochs.where(~cut), epochs.where(cut)
    taken = slim.select("doc_id", F.col("source").alias("of"), "n_tokens", "block", "row") \
        .join(small(whole.select("source", "block", "epoch", "weight", "size", "start")),
              F.col("of").eqNullSafe(F.col("source")) & (F.col("block") == F.col("b")))
    # The block in which a budget ends, by sub-blocks and then by documents.
    inside = stored(slim.select("doc_id", F.col("source").alias("of"), "n_tokens", "block", "row", "h")
                    .join(small(ends.select("source", "block", "epoch", "weight", "size", "start", "rest")),
                          F.col("of").eqNullSafe(F.col("source")) & (F.col("block") == F.col("b")))
                    .withColumn("sub", F.substring("h", BLOCK_DIGITS + 1, SUB_DIGITS)), "mix-ends")
    subs = inside.groupBy("source", "sub").agg(F.sum("n_tokens").alias("tokens"), F.first("start").alias("start"),
                                              F.first("rest").alias("rest"))
    line = Window.partitionBy("source").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    subs = subs.withColumn("sub_start", F.col("start") + F.coalesce(F.sum("tokens").over(line), F.lit(0))) \
        .where("sub_start < rest") \
        .select(F.col("source").alias("s"), F.col("sub").alias("u"), "sub_start",
                (F.col("sub_start") + F.col("tokens") > F.col("rest")).alias("last"))
    inside = inside.join(subs, F.col("source").eqNullSafe(F.col("s")) & (F.col("sub") == F.col("u")))
    line = Window.partitionBy("source").orderBy("h", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    final = inside.where("last").withColumn(
        "at", F.col("sub_start") + F.coalesce(F.sum("n_tokens").over(line), F.lit(0))).where("at < rest")
    out = ["doc_id", "source", "n_tokens", "epoch", "block",
           (F.col("start") + F.col("epoch") * F.col("size")).alias("block_start"), "weight", F.col("row").alias("copy_of")]
    return taken.select(*out).unionByName(inside.where("not last").select(*out)) \
        .unionByName(final.select(*out))


def small(plan: DataFrame) -> DataFrame:
    """A plan as the side of a join: broadcast only if its counted rows are few."""
    plan = plan.withColumnRenamed("block", "b")
    return F.broadcast(plan) if plan.limit(SMALL_PLAN + 1).count() <= SMALL_PLAN else plan
