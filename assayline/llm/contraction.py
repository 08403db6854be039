"""Sums over the subtrees of a forest by parallel tree contraction.

A round rakes and compresses. Rake: every leaf hands its sum to its parent and is done. Compress:
of a chain of nodes with one child each, those that a bit of their level picks are spliced out;
their sum goes to the edge above their child. No node and its child are both picked, so all of
it happens in two joins. The first rounds take the bits of the level one after the other, which
halves a chain of consecutive levels each time; then a hash of node and round tosses a coin in
every second turn, so that any other chain shrinks as well. Once the roots are bare, the rounds
are undone from the last to the first: a spliced node's sum is what it had then and its
child's sum, which is known by that time. Both ways the tables shrink and grow by a constant
factor a round, and a deep tree takes a number of rounds that grows with the logarithm of its depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import forget, stored


def picked(node: Column | str, level: Column | str, turn: int, bits: int) -> Column:
    """Whether a round may splice a node out, if it has one child that the round does not pick."""
    if turn // bits % 2 == 0:
        level = F.col(level) if isinstance(level, str) else level
        return level.bitwiseAND(1 << turn % bits) != 0
    return F.xxhash64(node, F.lit(turn)).bitwiseAND(1) == 1


def subtree_sums(tree: DataFrame, values: list[str], most_rounds: int = 200) -> DataFrame:
    """(node, values...): of each node, the sums of `values` over its subtree, itself included.

    `tree` has a row per node: node (any type that can be joined on), parent (null at a root),
    level (whole number; a child's is best one above its parent's, but any is right) and the
    values as longs, null as 0. Every parent is a node and there are no cycles: with either,
    rounds stop removing nodes and an error is raised after `most_rounds`. An empty tree gives
    no rows; other columns are not read.
    """
    edges = [f"_edge_{v}" for v in values]
    n = tree.where("parent is not null").groupBy("parent").agg(F.count("*").alias("_n")) \
        .withColumnRenamed("parent", "node")
    live = stored(tree.select("node", "parent", F.col("level").cast("long").alias("level"),
                              *[F.coalesce(F.col(v).cast("long"), F.lit(0)).alias(v) for v in values])
                  .join(n, "node", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
                  .withColumns({e: F.lit(0).cast("long") for e in edges}), "contract-live")
    most = live.agg(F.max(F.abs("level"))).first()[0] or 0
    bits = max(1, int(most).bit_length())
    rounds: list[tuple[DataFrame, DataFrame]] = []
    while not live.where("_n > 0").isEmpty():
        turn = len(rounds)
        if turn >= most_rounds:
            raise RuntimeError(f"nodes left after {most_rounds} rounds")
        up = live.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.when(F.col("_n") == 0, F.col(v) + F.col(e)).otherwise(0)).alias(f"_up_{v}") for v, e in zip(values, edges)],
            F.count_if(F.col("_n") > 0).alias("_left"),
            F.min(F.when(F.col("_n") > 0, F.struct("node", "level", *edges))).alias("_kid"))
        out = (F.col("_left") == 1) & F.col("parent").isNotNull() & picked("node", "level", turn, bits) \
            & ~picked(F.col("_kid.node"), F.col("_kid.level"), turn, bits)
        inner = stored(live.where("_n > 0").join(up, "node").select(
            "node", "parent", "level", *[(F.col(v) + F.col(f"_up_{v}")).alias(v) for v in values], *edges,
            F.col("_left").alias("_n"), "_kid", out.alias("_out")), "contract-inner")
        over = inner.where("_out").select(
            F.col("_kid.node").alias("node"), F.col("parent").alias("_over"), F.lit(True).alias("_moved"),
            *[(F.col(v) + F.col(e)).alias(f"_add_{v}") for v, e in zip(values, edges)])
        after = inner.where(~F.col("_out")).join(over, "node", "left").select(
            "node", F.when(F.col("_moved"), F.col("_over")).otherwise(F.col("parent")).alias("parent"), "level", *values, "_n",
            *[(F.col(e) + F.coalesce(f"_add_{v}", F.lit(0))).alias(e) for v, e in zip(values, edges)])
        rounds.append((live, inner))
        live = stored(after, "contract-live")
    known = live.select("node", *values)
    old = live
    for live, inner in reversed(rounds):
        spliced = inner.where("_out").select(
            "node", F.col("_kid.node").alias("_child"),
            *[(F.col(v) + F.col(f"_kid.{e}")).alias(f"_own_{v}") for v, e in zip(values, edges)])
        below = known.select(F.col("node").alias("_child"), *[F.col(v).alias(f"_sum_{v}") for v in values])
        again = spliced.join(below, "_child").select(
            "node", *[(F.col(f"_own_{v}") + F.col(f"_sum_{v}")).alias(v) for v in values])
        known = stored(known.unionByName(again).unionByName(live.where("_n = 0").select("node", *values)), "contract-sums")
        forget(live, inner, old)
        old = known
    return known
