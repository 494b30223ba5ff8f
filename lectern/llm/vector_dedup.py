"""Near-duplicate vectors by random-hyperplane signs, exact cosine and components.

In each of several tables a vector's key is its signs against random hyperplanes. The
number of planes follows the number of vectors, so that unrelated vectors fill a bucket
with a few, and the number of tables follows the planes, so that a pair at the threshold
meets with at least the stated chance; closer pairs meet more surely.

A bucket's pairs are verified by their cosine in double precision. A pair counts in the
first table in which it meets and nowhere else, which both vectors' keys tell, so links
are counted without ever writing pairs: a bucket gives a number per vector and a spanning
forest. A bucket larger than ``BLOCK`` is cut into blocks that are compared two by two in
tasks of their own. Equal vectors are one vector with a number of copies.

Defined results: vectors that are null, zero or hold null or non-finite components link
with nothing, have 0 links and are their own component. Rows that repeat an id are
vectors of their own for links; an id is linked to the rows beside it. Vectors of one
table must have one length. An empty table gives an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .components import components
from .vectors import distinct_vectors, matrix, usable

COSINE = 0.95
#: Chance that a pair exactly at the threshold meets in some table.
RECALL = 0.998
#: Vectors that share a bucket by chance, on average.
FILL = 64
BLOCK = 1024
SEED = 9


def shape(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Planes of a table and number of tables for so many different vectors."""
    planes = min(60, max(6, math.ceil(math.log2(max(vectors, 2) / FILL))))
    meet = (1 - math.acos(cosine) / math.pi) ** planes
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def with_keys(distinct: DataFrame, planes: int, tables: int) -> DataFrame:
    """Adds ``keys``, the key of each table."""

    def run(batches):
        normals = None
        for batch in batches:
            x = matrix(batch.column("embedding"))
            if normals is None:
                normals = np.random.default_rng(SEED).normal(size=(x.shape[1], planes * tables)) if len(x) else None
            if not len(x):
                continue
            signs = (x @ normals > 0).reshape(len(x), tables, planes)
            keys = signs.astype(np.int64) @ (1 << np.arange(planes, dtype=np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * tables, pa.int32()), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "keys"])

    return distinct.mapInArrow(run, distinct.withColumn("keys", F.array(F.lit(0).cast("long"))).schema)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def count_links(table: int, x, keys, copies, left, right, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each vector to others first met in ``table``, and a forest of them.

    ``left`` and ``right`` mark the vectors of the two blocks; one block meets itself.
    """
    n = len(x)
    links, root = np.zeros(n, np.int64), np.arange(n)
    rows, cols = np.nonzero(left)[0], np.nonzero(right)[0]
    near = x[rows] @ x[cols].T >= cosine
    near &= rows[:, None] != cols[None, :]
    a, b = np.nonzero(near)
    if not len(a):
        return links, root
    first = np.ones(len(a), dtype=bool)
    for at in range(0, len(a), 200_000):
        part = slice(at, at + 200_000)
        first[part] = ~(keys[rows[a[part]], :table] == keys[cols[b[part]], :table]).any(axis=1)
    a, b = rows[a[first]], cols[b[first]]
    np.add.at(links, a, copies[b])
    if (left != right).any():
        np.add.at(links, b, copies[a])
    while True:  # least node of each component of the links
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return links, root
        root = new


def links(distinct: DataFrame, cosine: float = COSINE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Of vectors ``(n, embedding, copies)``: rows ``(n, links, other)``.

    A vector's links add up over its rows; ``other``, where there is one, is linked to it.
    """
    planes, tables = shape(distinct.count(), cosine, recall)
    keyed = settle(with_keys(distinct, planes, tables), "keys")
    met = keyed.select("n", F.posexplode("keys").alias("table", "key"))
    sizes = met.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    where = settle(met.join(sizes, ["table", "key"]).select("n", "table", "key", blocks.alias("blocks")), "buckets")
    mine = F.when(F.col("blocks") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(F.col("mine"), o).alias("i"), F.greatest(F.col("mine"), o).alias("j")),
    )
    dealt = where.withColumn("mine", mine).select("n", "table", "key", "mine", F.explode(pairs).alias("pair"))
    full = dealt.join(keyed, "n").select("table", "key", "pair.i", "pair.j", "mine", "n", "embedding", "copies", "keys")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("n")
        table = group.column("table")[0].as_py()
        x = _unit(matrix(group.column("embedding").combine_chunks()))
        keys = group.column("keys").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        mine, number, copies = (group.column(c).to_numpy() for c in ("mine", "n", "copies"))
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        found, root = count_links(table, x, keys, copies, mine == i, mine == j, cosine)
        there = np.nonzero((found > 0) | (root != np.arange(len(x))))[0]
        return pa.table({"n": number[there], "links": found[there], "other": number[root[there]]})

    return full.groupBy("table", "key", "i", "j").applyInArrow(run, "n long, links long, other long")


def dedup(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """Per vector its number of links, its component's least id and whether it stays."""
    distinct = distinct_vectors(vectors)
    found = settle(links(distinct, cosine, recall), "links")
    roots = components(found.where("n != other").select(F.col("n").alias("a"), F.col("other").alias("b")))
    sums = found.groupBy("n").agg(F.sum("links").alias("links"))
    rooted = distinct.join(sums, "n", "left").join(roots.withColumnRenamed("node", "n"), "n", "left").select(
        F.col("embedding").alias("held"), F.coalesce("root", "n").alias("root"), "least",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    rooted = settle(rooted, "vector-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = settle(rooted.join(least, "root").select("held", "component", "links"), "vector-classes")
    part = F.when(usable(F.col("embedding")), F.col("embedding"))
    lone = vectors.where(~usable(F.col("embedding"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    rest = vectors.select("vec_id", part.alias("embedding")).where("embedding IS NOT NULL").join(classes, F.col("embedding") == F.col("held"))
    every = rest.select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id")).union(lone)
    return every.select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
