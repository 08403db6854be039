"""Exact duplicates by a stream with keyed state that never expires.

The state, one entry per digest, is kept by the streaming engine in its on-disk store
(RocksDB) and holds the smallest document id, where that document lies (its input file) and
the number of documents. A hit in the state is no proof: the full bytes of each document in a
group are compared with those of the one that stays, and rows whose bytes differ (two texts
with one digest) are grouped again by the text itself. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.llm.common import SPACE, forget, free, may_have, remove, stored
from assayline.session import scratch

#: Settings of the stream: state on disk; a store is closed once its batch is committed, so that
#: open stores (some MB of disk each) do not grow with the number of partitions.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: Documents of one group that are compared with the same copy of the text that stays.
PER_SALT = 2000


def normal(text: str | Column) -> Column:
    """The text that copies share; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def keep_state(digests: DataFrame, files_per_batch: int) -> DataFrame:
    """Runs the stream over stored digests until all are read, then reads its state.

    `digests` has digest, doc_id, place. Returns a row per digest: digest, keep_id, place,
    group_size. The stream's own log and state lie in the shared folder.
    """
    spark = digests.sparkSession
    folder, log = scratch(spark, "digests"), scratch(spark, "dedup-state")
    digests.write.parquet(folder)
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        (spark.readStream.schema(digests.schema).option("maxFilesPerTrigger", files_per_batch)
         .parquet(folder).groupBy("digest")
         .agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("size"))
         .writeStream.format("noop").outputMode("update").option("checkpointLocation", log)
         .trigger(availableNow=True).start().awaitTermination())
        state = spark.read.format("statestore").load(log)
        names = state.schema["value"].dataType.names
        return stored(state.select(
            F.col("key.digest").alias("digest"),
            F.col(f"value.`{names[0]}`").alias("first"),
            F.col(f"value.`{names[1]}`").alias("group_size"))
            .select("digest", F.col("first.doc_id").alias("keep_id"),
                    F.col("first.place").alias("place"), "group_size"), "dedup-keys")
    finally:
        remove(spark, folder)
        remove(spark, log)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Stands for a missing id while the smallest is sought, so that it comes last.
NO_ID = (1 << 63) - 1


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest=sha256, files_per_batch: int = 1000) -> DataFrame:
    """A row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if the same after each run of white space became one blank; the row with
    the smallest id of equal texts stays. Null and empty texts form one group. Of several
    rows with the smallest id and equal text one stays: `kept` is true once per group. A row
    without an id stays only if no row of its group has one (ids below 2**63 - 1). No row is
    lost; an empty table gives no rows. Other columns are not read, so their names cannot
    clash. `digest` turns text into the key of the state; any function that gives equal texts
    equal values is right, as bytes decide.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("at"),
                       normal(F.col(text_col)).alias("text"), F.input_file_name().alias("place"))
    slim = stored(base.select("at", "place", digest(F.col("text")).alias("digest"),
                              sha256(F.col("text")).alias("text_sha256")), "dedup-docs")
    keys = keep_state(slim.select("digest", F.col("at").alias("doc_id"), "place"), files_per_batch)
    joined = slim.join(keys.select("digest", "keep_id", "group_size"), "digest")
    single = joined.where("group_size = 1").select(
        "at", "keep_id", "group_size", F.lit(True).alias("kept"), "text_sha256")
    # Full bytes of the rows in groups. The text that stays is laid out once for every
    # PER_SALT rows of its group, so many tasks compare a hot group.
    ids = joined.where("group_size > 1").select("at", "digest", "keep_id", "group_size").distinct()
    # Only texts that may be in a group go through the exchange of the join.
    ids = stored(ids, "dedup-ids")
    full = may_have(base.select("at", "text", digest(F.col("text")).alias("digest")), ids, "at", "digest")
    full = stored(full.join(ids.hint("shuffle_hash"), ["at", "digest"]), "dedup-hits")
    salts = F.ceil(F.col("group_size") / PER_SALT).cast("int")
    stays = full.where("at = keep_id").groupBy("digest", "group_size") \
        .agg(F.min("text").alias("stays")) \
        .select("digest", "stays", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    checked = stored(
        full.withColumn("salt", F.pmod(F.xxhash64("at"), salts).cast("int"))
        .join(stays, ["digest", "salt"])
        .select("at", "digest", sha256(F.col("text")).alias("text_sha256"),
                F.when(F.col("text") != F.col("stays"), F.col("text")).alias("other"),
                F.monotonically_increasing_id().alias("row")), "dedup-checked")
    forget(full, ids)
    # `other` is the text where it differs from the one that stays: a group of its own.
    groups = checked.groupBy("digest", "other").agg(
        F.min(F.struct("at", "row")).alias("first"), F.count("*").alias("group_size")) \
        .select(F.col("digest").alias("d"), F.col("other").alias("o"), "first", "group_size")
    several = checked.join(groups, (F.col("digest") == F.col("d"))
                           & F.col("other").eqNullSafe(F.col("o"))) \
        .select("at", F.col("first.at").alias("keep_id"), "group_size",
                (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")
    known = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n)
             for c, n in (("at", "doc_id"), ("keep_id", "keep_id"))]
    return single.unionByName(several).select(*known, "group_size", "kept", "text_sha256")


def keep_first(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Rows equal in id and text cannot
    be told apart by the groups; of those one is taken."""
    at, sha, kept, n = free(docs, "_at", "_sha", "_kept", "_n")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    marked = docs.withColumns({at: key, sha: sha256(normal("text"))})
    seen = groups.groupBy(key.alias(at), F.col("text_sha256").alias(sha)) \
        .agg(F.max("kept").alias(kept), F.count("*").alias(n)).where(~F.col(kept) | (F.col(n) > 1))
    alone = marked.join(seen.select(at, sha), [at, sha], "left_anti")
    again = marked.join(seen.where(kept).select(at, sha), [at, sha], "left_semi").dropDuplicates([at, sha])
    return alone.unionByName(again).select(*[F.col(f"`{c}`") for c in docs.columns])
