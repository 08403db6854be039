"""Near duplicates among vectors by rotated binary codes with stored corrections.

Vectors are scaled to length 1 and turned by a random rotation fixed by a seed. A code keeps
the signs; stored with it is how much of the vector its code explains. From a code and that
factor follows an unbiased estimate of the inner product with any other vector, with a
confidence bound; a pair is recomputed exactly, in double precision, only where the bound
allows the threshold. Bits of codes are also the index: vectors that agree in all bits of a
table meet in a bucket, and enough tables are used to find a pair at the threshold with the
recall asked for. Equal vectors are one before anything else.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.llm.common import stored
from assayline.llm.components import components

#: Fixed production parameters: link from this cosine; chance to find a pair right at it;
#: vectors per bucket that the index aims at; standard deviations the bound allows.
COSINE = 0.98
RECALL = 0.995
BUCKET = 256
SIGMAS = 5.0
#: Vectors of one bucket that meet in one task, and rows that small buckets share a task for.
BLOCK = 1024
CELL = 4000
SEED = 20
MOST_BITS = 30


def rotation(dim: int, rows: int, seed: int = SEED) -> np.ndarray:
    """`rows` directions: random rotations, one under the other as far as needed."""
    rng = np.random.default_rng([seed, dim])
    parts = []
    while not parts or sum(len(p) for p in parts) < rows:
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        parts.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(parts)[:rows]


def tables(largest: int, cosine: float, recall: float, bucket: int) -> tuple[int, int]:
    """(tables, bits of each) for the largest group of vectors that may link.

    Two vectors at the threshold's angle differ in a bit with the chance angle / pi.
    """
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, largest) / bucket))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return (1, 0) if not bits else (math.ceil(math.log(1 - recall) / math.log(1 - same)), bits)


def keys_of(x: np.ndarray, directions: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of each vector in each table, from the signs of rotated vectors."""
    if not bits:
        return np.zeros((len(x), n), np.int64)
    signs = (x @ directions.T > 0).reshape(len(x), n, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def unit_keys(n: int, bits: int):
    """Adds the buckets of each vector; vectors are doubles, little-endian."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned: dict[int, np.ndarray] = {}
        for batch in batches:
            data = batch.column("vector").to_pylist()
            keys: list = [None] * len(data)
            sizes = np.array([len(d) // 8 for d in data])
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                x = np.frombuffer(b"".join(data[i] for i in own)).reshape(len(own), dim)
                if dim not in turned:
                    turned[dim] = rotation(int(dim), n * bits)
                for i, k in zip(own, keys_of(x / np.linalg.norm(x, axis=1)[:, None], turned[dim], n, bits)):
                    keys[i] = k.tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.list_(pa.int64()))], [*batch.schema.names, "keys"])
    return run


class Codes:
    """Binary codes of some vectors: signs, the share of a vector its code explains, and the
    spread of the estimate."""

    def __init__(self, x: np.ndarray):
        dim = x.shape[1]
        self.turned = x @ rotation(dim, dim).T
        self.signs = np.where(self.turned >= 0, 1.0, -1.0).astype(np.float32) / np.float32(math.sqrt(dim))
        self.factor = np.abs(self.turned).sum(1) / math.sqrt(dim)
        left = np.maximum(0.0, 1 - self.factor**2) / self.factor**2
        self.spread = np.sqrt(left / max(1, dim - 1))

    def maybe(self, i: slice, other: "Codes", j: slice, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (of rows i of this, j of other) whose bound reaches the threshold."""
        estimate = (self.signs[i] @ other.turned[j].T.astype(np.float32)) / self.factor[i, None]
        return np.nonzero(estimate + SIGMAS * self.spread[i, None] + 1e-5 >= cosine)


def pairs_in(a: pd.DataFrame, b: pd.DataFrame | None, table: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (positions in a and in b, or twice in a) that no earlier table has."""
    def read(f: pd.DataFrame):
        x = np.frombuffer(b"".join(f["vector"])).reshape(len(f), -1)
        return x, np.linalg.norm(x, axis=1), np.stack(f["keys"].to_numpy())
    x, nx, kx = read(a)
    y, ny, ky = (x, nx, kx) if b is None else read(b)
    cx = Codes(x / nx[:, None])
    cy = cx if b is None else Codes(y / ny[:, None])
    found = []
    for at in range(0, len(x), 256):
        i, j = cx.maybe(slice(at, at + 256), cy, slice(None), cosine)
        i = i + at
        if b is None:
            i, j = i[i < j], j[i < j]
        if table and len(i):
            new = ~(kx[i, :table] == ky[j, :table]).any(1)
            i, j = i[new], j[new]
        for k in range(0, len(i), 1 << 16):  # exactly, where the bound leaves it open
            p, q = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
            right = np.einsum("ij,ij->i", x[p], y[q]) / (nx[p] * ny[q]) >= cosine
            found.append((p[right], q[right]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


def forest(p: np.ndarray, q: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Pairs enough to connect all that the pairs connect."""
    up = list(range(n))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    kept = []
    for i, j in zip(p.tolist(), q.tolist()):
        a, b = find(i), find(j)
        if a != b:
            up[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


FOUND = "a long, b long, links long"


def linker(cosine: float):
    """Links of the buckets in a group of rows: connecting pairs, and how many rows of the
    input each vector links with."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (table, _, _, _), own in group.groupby(["table", "label", "dim", "key"], sort=False):
            own = own.sort_values(["side", "rep"])
            sides = [s for _, s in own.groupby("side", sort=True)]
            pair = own["pair"].iloc[0]
            if pair and len(sides) < 2:
                continue
            a, b = sides[0], sides[1] if pair else None
            p, q = pairs_in(a, b, int(table), cosine)
            if not len(p):
                continue
            reps = own["rep"].to_numpy()
            weight = own["copies"].to_numpy()
            q = q + len(a) if pair else q
            links = np.bincount(p, weight[q], len(reps)) + np.bincount(q, weight[p], len(reps))
            some = np.flatnonzero(links)
            out.append(pd.DataFrame({"a": reps[some], "b": reps[some], "links": links[some].astype(np.int64)}))
            edges = forest(p, q, len(reps))
            out.append(pd.DataFrame({"a": reps[[i for i, _ in edges]], "b": reps[[j for _, j in edges]], "links": 0}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "links": []}, dtype=np.int64)
    return run


def pack_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; null for those that link with nothing: null, empty or zero ones and
    those that hold a null, a NaN or an infinity."""
    for batch in batches:
        column = batch.column("embedding")
        out = []
        for v in column.to_pylist():
            x = None
            if v and all(e is not None for e in v):
                x = np.array(v, np.float64) + 0.0  # no negative zeros
                most = np.abs(x).max()
                # A power of two brings all lengths near 1 and changes no cosine.
                x = np.ldexp(x, -np.frexp(most)[1]).tobytes() if np.isfinite(x).all() and most > 0 else None
            out.append(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(out, pa.binary())], ["vec_id", "label", "vector"])


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, bucket: int = BUCKET,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null, they have as many components, and
    their cosine is at least `cosine`. `n_links` counts the other rows a vector links with;
    `component_id` is the smallest id reachable. Vectors that are null, empty or zero, or hold
    a null or a value that is not finite, link with nothing, as do rows without a label. Rows
    without an id have no component and are not kept, but count as links; rows that share an
    id are one node. Other columns are not read; an empty table gives no rows.
    """
    rows = stored(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                                 F.col(vector_col).cast("array<double>").alias("embedding"))
                  .mapInArrow(pack_vectors, "vec_id long, label string, vector binary"), "vectors")
    good = rows.where("vector is not null and label is not null")
    # Equal vectors are one class, with the number of its rows; classes are named by their id.
    classes = stored(good.groupBy("label", "vector").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first"))
        .withColumn("dim", (F.length("vector") / 8).cast("int")).withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    n, bits = tables(largest, cosine, recall, bucket)
    schema = T.StructType([*classes.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))])
    keyed = stored(classes.mapInArrow(unit_keys(n, bits), schema), "vector-keys")
    met = keyed.select("rep", "label", "dim", "copies", "vector", "keys", F.posexplode("keys").alias("table", "key"))
    sizes = met.groupBy("table", "label", "dim", "key").agg(F.count("*").alias("size")).where("size > 1")
    met = stored(met.join(sizes, ["table", "label", "dim", "key"]), "vector-buckets")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cells = max(1, math.ceil((met.where(F.col("size") <= BLOCK).count()) / CELL))
    small = met.where(F.col("size") <= BLOCK).select(
        "*", F.pmod(F.xxhash64("table", "label", "dim", "key"), F.lit(cells)).alias("cell"), F.lit(0).alias("i"),
        F.lit(0).alias("j"), F.lit(0).alias("side"), F.lit(False).alias("pair"))
    # A large bucket is cut into blocks; every two blocks (and each with itself) meet in a task.
    large = met.where(F.col("size") > BLOCK).withColumn("cell", F.xxhash64("table", "label", "dim", "key")) \
        .withColumn("own", F.pmod(F.xxhash64("rep"), blocks).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    large = large.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")) \
        .withColumn("side", (F.col("own") > F.col("other")).cast("int")) \
        .withColumn("pair", F.col("own") != F.col("other")).drop("own", "other")
    found = stored(small.unionByName(large).groupBy("cell", "i", "j").applyInPandas(linker(cosine), FOUND), "vector-links")
    links = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    groups = components(found.where("links = 0").select("a", "b"))
    # Components were named by class; they get the smallest id of their rows.
    named = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    verdict = named.join(least, "component").join(links, "rep", "left").select(
        "label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = good.join(verdict, ["label", "vector"])
    alone = rows.where("vector is null or label is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", "n_links", F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"))
    return out.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
