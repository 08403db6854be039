"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import forget, stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): smallest node reachable, for all nodes of `edges` (a, b), from
    repeated large-star and small-star steps.

    Each step lets every node point its neighbours to the smallest of them; stars remain. Minima
    are aggregated before they meet the edges in a plain join, so that a node with very many
    edges is split by the engine. Each round is written to the shared folder. Edges with a null
    and loops count for nothing.
    """
    now = stored(edges.dropna().where("a != b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(most_rounds):
        if stars(now):
            pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component")).distinct()
            return pairs.unionByName(pairs.select(F.col("component").alias("node"), "component").distinct())
        # Large star: neighbours above a node point to the smallest near it, the node included.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        # Small star: a node and its smaller neighbours point to the smallest of those. These are
        # few, as each node has one for each smaller node it is joined to, so one exchange by
        # node serves the distinct rows, the minimum and the join.
        large = large.repartition("a").dropDuplicates()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        before, now = now, stored(large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a != b").dropDuplicates(), "edges")
        forget(before)
    raise RuntimeError(f"no stars after {most_rounds} rounds")


def stars(edges: DataFrame) -> bool:
    """Whether every node points to one other and none is pointed to that points itself."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("to")) \
        .unionByName(edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("to")))
    return ends.groupBy("node").agg(F.min("to").alias("low"), F.max("to").alias("high"),
                                    F.max(F.col("to").isNull()).alias("end")) \
        .where("low < high or low is not null and end").isEmpty()
