"""Exact quantiles without gathering the values in one place."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = (12, 8, 4, 0)  # four more decimal digits are settled in each round


def exact_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str, float]],
                    scale: int = 2) -> DataFrame:
    """One row with one column per wanted (column, probability).

    The value is the smallest one at or below which lies at least that share of the
    non-NULL values; NULL if there are none. Values must be exact at `scale` decimal
    places, and fit 15 digits.

    Equal values are counted together first, for all columns in one pass. Then the
    answers are found digit by digit, from the leading block of four to the last:
    each round groups the values that share the prefix found so far by their next
    four digits. So no task ever ranks more than about ten thousand groups, and the
    side that is broadcast has one row per wanted quantile.
    """
    columns = sorted({c for c, _ in wanted.values()})
    values = F.array(*[
        F.struct(F.lit(c).alias("c"),
                 (F.col(c).cast(f"decimal(20,{scale})") * 10**scale).cast("bigint").alias("v"))
        for c in columns])
    counts = (df.select(F.inline(values)).filter("v is not null")
              .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    asked = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(c).alias("c"),
                 F.lit(Decimal(str(p))).cast("decimal(10,8)").alias("p"))
        for name, (c, p) in wanted.items()])))
    totals = counts.groupBy("c").agg(F.sum("n").alias("total"))
    state = asked.join(totals, "c").select(
        "name", "c",
        F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("total"))).cast("bigint").alias("rank"))

    for power in ROUNDS:
        step = 10**power
        block = F.expr(f"(v - pmod(v, {step}L)) div {step}L")
        scope = counts.withColumn("block", block)
        # null-safe, since a plain equality would add a filter to the counts that differs
        # from round to round, and they would be counted anew each time
        match = scope["c"].eqNullSafe(state["c"])
        if power != ROUNDS[0]:
            match = match & F.expr("(block - pmod(block, 10000L)) div 10000L").eqNullSafe(
                state["prefix"])
        groups = (
            scope.join(F.broadcast(state), match)
            .groupBy(state["name"], state["c"], state["rank"], "block")
            .agg(F.sum("n").alias("n")))
        upto = F.sum("n").over(Window.partitionBy("name").orderBy("block").rowsBetween(
            Window.unboundedPreceding, Window.currentRow))
        state = (
            groups.withColumn("upto", upto)
            .filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
            .select("name", "c", F.col("block").alias("prefix"),
                    (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")))
    return state.agg(*[
        F.max(F.when(F.col("name") == name, F.col("prefix") / 10**scale)).alias(name)
        for name in wanted])
