"""Left join of a fact to a dimension that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.session import salt_count

HOT_SHARE = 1000


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE, least: int = 0) -> DataFrame:
    """Keys that hold more than 1/share of the rows, and more than `least`: about `share` keys at most, whatever
    the size of the data. One pass with a sketch of frequent items, which tasks merge, so
    neither all keys nor a hot one are a burden. Its counts may be a little too high."""
    found = df.filter(F.col(key).isNotNull()).agg(
        F.call_function("approx_top_k", F.col(key), F.lit(share), F.lit(10 * share)).alias("top"), F.count(F.lit(1)).alias("n"))
    items = found.select(F.explode("top").alias("e"), "n").filter(
        (F.col("e.count") * share > F.col("n")) & (F.col("e.count") > least))
    return items.select(F.col("e.item").alias(key))


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           share: int = HOT_SHARE, spread_by: Sequence[str] | None = None,
           split_hot: bool = False) -> DataFrame:
    """Fact rows with the columns of the dimension, NULL where the key is unknown.

    Fact and dimension are read once. Spark sends out a dimension it knows to be small
    and joins a larger one by a shuffle, in which it splits the rows of a hot key at run
    time (adaptive skew join), as the dimension has one row for it. Rows without a key
    would all be dealt to one task; they join as a number that spreads them and matches
    nothing. The number comes from the input partition and the columns `spread_by`, by
    default the first, which should tell rows apart; it is the same when a task is retried.

    With `split_hot` hot keys are found beforehand, by a pass over the keys of the fact, and
    dealt to all tasks in the plan itself: for sessions without adaptive execution, and for
    joins whose partitioning a later step relies on, which it leaves alone.
    """
    values = [c for c in dim.columns if c != dim_key]
    salts = salt_count(fact.sparkSession)
    kind = fact.schema[fact_key].dataType
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *(spread_by or fact.columns[:1])), F.lit(salts))
    hot = [r[0] for r in hot_keys(fact, fact_key, share).collect()] if split_hot else []

    def is_hot(c: str):
        return F.col(c).isin(hot) if hot else F.lit(False)

    left = fact.withColumn("_spread", spread).withColumns({
        "_join_key": F.coalesce(F.col(fact_key), F.col("_spread").cast(kind)), "_known": F.col(fact_key).isNotNull()})
    right = dim.select(F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(f"_dim_{i}") for i, c in enumerate(values)])
    match = (F.col("_join_key") == F.col("_dim_key")) & F.col("_known")
    if hot:  # hot rows of the dimension once for every salt
        left = left.withColumn("_salt", F.when(is_hot(fact_key), F.col("_spread")).otherwise(F.lit(0).cast("long")))
        right = right.withColumn("_dim_salt", F.explode(F.when(
            is_hot("_dim_key"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
            .otherwise(F.array(F.lit(0).cast("long")))))
        match = match & (F.col("_salt") == F.col("_dim_salt"))
    return left.join(right, match, "left").select(
        *[F.col(c) for c in fact.columns], *[F.col(f"_dim_{i}").alias(c) for i, c in enumerate(values)])
