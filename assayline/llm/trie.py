"""Prefix trie of conversations, with totals of every subtree.

1. Turns are named by a digest of role and text, and equal ones of a conversation counted; only
   these narrow rows move from here on. A sort by range numbers the turns: places within a part
   of the sort, then an offset per part, so that one conversation may fill many parts.
2. A prefix is named by the exclusive or of one 128-bit hash per turn and place. As with places,
   it runs within a part and goes on from the parts before, and a node's parent is named by its
   own name and its last turn's hash.
3. Nodes are groups of equal names. Their subtree totals come from `contraction`.
4. The members that end at a node are sorted by range and joined to texts piece by piece; a
   node's pieces are then hashed one after the other, without holding them together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayline.llm.common import stored
from assayline.llm.contraction import subtree_sums

#: Fixed production parameters: conversations that begin like the first of their family, and the
#: number of turns (less one) they may share with it.
FAMILY = 100
SHARED = 6
#: Ids in one piece of a node's list of ends.
PIECE = 512


def digest(role: Column, text: Column) -> tuple[Column, Column]:
    """Two 60-bit numbers that name a turn."""
    h = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return tuple(F.conv(F.substring(h, i, 15), 16, 10).cast("long") for i in (1, 16))


def hashes(place: Column) -> tuple[Column, Column]:
    """Two 64-bit values of a turn (a, b) at a place."""
    return F.xxhash64(place, "a", "b"), F.xxhash64(place, "b", "a", F.lit(1))


def shared_turns(conv: Column, shared: int = SHARED) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv.cast("string").cast("binary")) % shared).cast("long")


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, parts): a row per turn with its place from 1, and per conversation and part of the
    sort the number of turns before it and in all. Order: turn (null first), then the digest."""
    order = [F.col("turn").asc_nulls_first(), F.col("a").asc(), F.col("b").asc()]
    slim = turns.groupBy("conv", "turn", "a", "b", "chars").agg(F.count("*").alias("n"))
    laid = stored(slim.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "trie-turns")
    parts = laid.groupBy("conv", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                         F.sum("n").over(Window.partitionBy("conv")).alias("own"))
    here = Window.partitionBy("conv", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return laid.withColumn("upto", F.sum("n").over(here)), parts


def rebuilt(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """A row per member and depth, the root's included: conv, depth, name (k1, k2), hash of the
    last turn (t1, t2), its code points (chars), and whether the member ends there."""
    laid, parts = numbered(turns)
    info = parts.groupBy("conv").agg(F.max("own").alias("own"))
    first = info.select(F.col("conv").alias("root"), F.col("own").alias("root_own"))
    c = F.col("conv")
    info = info.withColumns({"h": shared_turns(c, shared), "root": c - c % family}).join(first, "root", "left") \
        .withColumn("taken", F.least("h", F.coalesce("root_own", F.lit(0)))) \
        .withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h")))
    info = stored(info.select("conv", "root", "h", "taken", "length"), "trie-convs")
    placed = laid.join(parts.select("conv", "part", "before"), ["conv", "part"]).select(
        "conv", "part", "a", "b", "chars",
        F.explode(F.sequence(F.col("before") + F.col("upto") - F.col("n") + 1, F.col("before") + F.col("upto"))).alias("place"))
    placed = stored(placed, "trie-places")

    # The turns that a family shares: at most `shared` - 1 of its first conversation.
    t1, t2 = hashes(F.col("place"))
    run = Window.partitionBy("conv").orderBy("place")
    heads = placed.where((F.col("place") < shared) & (c % family == 0)).withColumns({"t1": t1, "t2": t2}).select(
        F.col("conv").alias("root"), "place", "t1", "t2", "chars",
        F.bit_xor("t1").over(run).alias("k1"), F.bit_xor("t2").over(run).alias("k2"))
    taken = stored(info.where("taken > 0").join(heads, "root").where("place <= taken").select(
        "conv", F.col("place").alias("depth"), "k1", "k2", "t1", "t2", "chars", (F.col("place") == F.col("length")).alias("ends"),
        (F.col("place") == F.col("taken")).alias("last")), "trie-shared")

    # A conversation's own turns, named on from those it shares.
    start = taken.where("last").select("conv", F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    spread = parts.select("conv", "part").join(info.select("conv", "h", "taken", "length"), "conv") \
        .join(start, "conv", "left").withColumns({k: F.coalesce(k, F.lit(0)) for k in ("s1", "s2")})
    own = placed.join(spread.select("conv", "part", "h", "taken", "length"), ["conv", "part"]).where("place > h") \
        .withColumn("depth", F.col("place") - F.col("h") + F.col("taken"))
    t1, t2 = hashes(F.col("depth"))
    own = stored(own.withColumns({"t1": t1, "t2": t2}).select(
        "conv", "part", "depth", "t1", "t2", "chars", (F.col("depth") == F.col("length")).alias("ends")), "trie-own")
    sums = own.groupBy("conv", "part").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv", "part", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(x) for x in ("x1", "x2")]) \
        .join(spread.select("conv", "part", "s1", "s2"), ["conv", "part"]) \
        .select("conv", "part", F.col("x1").bitwiseXOR(F.col("s1")).alias("x1"), F.col("x2").bitwiseXOR(F.col("s2")).alias("x2"))
    here = Window.partitionBy("conv", "part").orderBy("depth")
    own = own.withColumns({f"r{i}": F.bit_xor(f"t{i}").over(here) for i in (1, 2)}).join(sums, ["conv", "part"]).select(
        "conv", "depth", F.col("r1").bitwiseXOR(F.col("x1")).alias("k1"), F.col("r2").bitwiseXOR(F.col("x2")).alias("k2"),
        "t1", "t2", "chars", "ends")
    zero = F.lit(0).cast("long")
    roots = info.select("conv", zero.alias("depth"), *[zero.alias(k) for k in ("k1", "k2", "t1", "t2")],
                        F.lit(0).alias("chars"), (F.col("length") == 0).alias("ends"))
    return stored(roots.unionByName(taken.drop("last")).unionByName(own), "trie-members")


ENDS = "conv_id long, depth long, first long, ids string"


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, depth, conv) to texts of at most PIECE ids of one node."""
    for batch in batches:
        node, depth, conv = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(conv):
            continue
        cut = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (depth[1:] != depth[:-1])]))
        cut = np.unique(np.concatenate([s + np.arange(0, e - s, PIECE) for s, e in zip(cut, np.append(cut[1:], len(conv)))]))
        ends = np.append(cut[1:], len(conv))
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[cut]), pa.array(depth[cut]), pa.array(conv[cut]),
             pa.array([",".join(map(str, conv[i:j].tolist())) for i, j in zip(cut, ends)])],
            ["conv_id", "depth", "first", "ids"])


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, comma between, which come sorted."""
    now, sha = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([sha.hexdigest()])],
                                          ["conv_id", "depth", "many_sha256"])
    for batch in batches:
        for node, depth, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (node, depth) != now:
                if now:
                    yield row()
                now, sha = (node, depth), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
    if now:
        yield row()


def prefix_trie(conversations: DataFrame, family: int = FAMILY, shared: int = SHARED, conv_col: str = "conv_id",
                turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c becomes the first h original turns of conversation c - c % family, then its own
    turns after the first h, where h = crc32(decimal c) % shared; a node is a distinct sequence
    of the first turns (role, text) of such conversations, the root the empty one. Turns are
    ordered by `turn`, null first; turns that tie, by a digest of role and text, and rows equal
    in all of these are turns of their own. A null role or text is empty. Rows without a
    conversation id belong to none and count for nothing. A negative c has the remainder of its
    sign, as in SQL. An empty table has no node, not even the root. Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    a, b = digest(role, text)
    turns = conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                                 a.alias("a"), b.alias("b"), F.length(text).alias("chars")).where("conv is not null")
    members = rebuilt(turns, family, shared)
    nodes = stored(members.groupBy("depth", "k1", "k2").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("t1").alias("t1"), F.min("t2").alias("t2"),
        F.max("chars").alias("chars"), F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv"))).alias("end")),
        "trie-nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("conv_id").alias("parent_conv_id"))
    p1, p2 = F.col("k1").bitwiseXOR(F.col("t1")), F.col("k2").bitwiseXOR(F.col("t2"))
    tree = nodes.withColumns({"p1": p1, "p2": p2}).join(above, ["depth", "p1", "p2"], "left")
    tree = stored(tree.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_ends", "end",
                              ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")), "trie-tree")
    children = tree.where("depth > 0").groupBy("parent_conv_id", (F.col("depth") - 1).alias("depth")) \
        .agg(F.count("*").alias("n_children")).withColumnRenamed("parent_conv_id", "conv_id")
    # A node is named by its smallest member and its depth.
    tree = tree.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    node = F.struct("conv_id", "depth")
    parent = F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")))
    sums = subtree_sums(tree.select(node.alias("node"), parent.alias("parent"), F.col("depth").alias("level"), "saved",
                                    (F.col("n_children") == 0).cast("long").alias("leaf")), ["leaf", "saved"])
    sums = sums.select("node.*", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    several = nodes.where("n_ends > 1").select("depth", "k1", "k2", "conv_id")
    ends = members.where("ends").select("depth", "k1", "k2", "conv").join(several, ["depth", "k1", "k2"]) \
        .select("conv_id", "depth", "conv")
    many = ends.repartitionByRange("conv_id", "depth", "conv").sortWithinPartitions("conv_id", "depth", "conv").mapInArrow(joined, ENDS)
    many = many.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first") \
        .mapInArrow(hashed, "conv_id long, depth long, many_sha256 string")
    one = F.sha2(F.coalesce(F.col("end").cast("string"), F.lit("")).cast("binary"), 256)
    return tree.join(sums, ["conv_id", "depth"]).join(many, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("many_sha256", one).alias("ends_sha256"))
