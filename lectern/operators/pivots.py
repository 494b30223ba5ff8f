"""Exact nearest vectors of many queries out of clusters that bounds leave open.

Vectors are put with the nearest of at most ``PIVOTS`` vectors of the table; a cluster is
cut into blocks, and for each the farthest of its vectors from the pivot is known. By the
triangle inequality a unit query can't score more in a block than it scores with the
pivot plus that distance. Every query is first scored against the clusters of its nearest
pivots, which gives it a score its ``k`` best reach at least; blocks whose bound is below
that, or below the floor, are never joined with the query. So neither side is copied over
all blocks of the other, and the result is that of comparing everything.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import matrix_of
from ..session import settle

#: Most pivots; they are sent to all tasks.
PIVOTS = 4096
#: Vectors of a block, queries scored together, clusters a query is scored against first.
BLOCK = 512
QUERIES = 2048
FIRST = 2
_SLACK = 1e-9


def _units(x: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(x, axis=1)
    return x / np.where(lengths == 0, 1.0, lengths)[:, None]


def cluster(vectors: DataFrame, block: int = BLOCK, most: int = PIVOTS) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Blocks of ``vectors (id, v)``, what is known of them, and the pivots.

    ``(id, v, cluster, block)`` and ``(cluster, block, radius)``, both written; the pivots
    are the vectors whose ids have the smallest hashes, in that order.
    """
    count = vectors.count()
    wanted = max(1, min(most, math.ceil(count / block)))
    first = vectors.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v").toArrow()  # at most PIVOTS rows
    pivots = matrix_of(first.column("v").combine_chunks()) if len(first) else np.zeros((1, 0))
    squares = np.einsum("ij,ij->i", pivots, pivots)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("v"), pivots.shape[1] or None)
            near = np.empty(len(x), dtype=np.int32)
            for at in range(0, len(x), 1024):
                part = x[at:at + 1024]
                near[at:at + 1024] = np.argmin(squares[None, :] - 2 * part @ pivots.T, axis=1)
            # The distance itself from the difference, so that equal vectors are at 0.
            far = np.linalg.norm(x - pivots[near], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(far)], [*batch.schema.names, "cluster", "far"])

    schema = vectors.withColumns({"cluster": F.lit(0), "far": F.lit(0.0)}).schema
    placed = settle(vectors.mapInArrow(run, schema), "clustered")
    parts = placed.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    # As many rows as there are pivots at most.
    dealt = placed.join(F.broadcast(settle(parts, "parts")), "cluster")
    part = F.pmod(F.xxhash64("id", F.lit(3)), F.col("parts"))
    blocks = dealt.select("id", "v", "cluster", part.alias("block"), "far")
    known = settle(blocks.groupBy("cluster", "block").agg(F.max("far").alias("radius")), "radii")
    return blocks.drop("far"), known, pivots


def _scored(blocks: DataFrame, pairs: DataFrame, queries: DataFrame, k: int, floor: float, per_group: int) -> DataFrame:
    """The ``k`` best of each of ``pairs (query_id, cluster, block)``."""
    kinds = dict(queries.dtypes)["query_id"], dict(blocks.dtypes)["id"]
    groups = max(1, math.ceil(queries.count() / per_group))
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("qb")
    asked = pairs.join(queries, "query_id").select("cluster", "block", group, "query_id", "q")
    meets = pairs.select("cluster", "block", group).distinct()
    held = blocks.join(meets, ["cluster", "block"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"query_id": right.column("query_id")[:0], "id": left.column("id")[:0], "score": pa.array([], pa.float64())})
        left, right = left.sort_by("id").combine_chunks(), right.combine_chunks()
        x = matrix_of(left.column("v").combine_chunks())
        q = _units(matrix_of(right.column("q").combine_chunks(), x.shape[1]))
        scores = np.round(q @ x.T, 15)
        best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        rows, cols = np.repeat(np.arange(len(q)), best.shape[1]), best.ravel()
        keep = scores[rows, cols] >= floor
        rows, cols = rows[keep], cols[keep]
        return pa.table({"query_id": right.column("query_id").take(pa.array(rows)), "id": left.column("id").take(pa.array(cols)), "score": scores[rows, cols]})

    keys = ["cluster", "block", "qb"]
    return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, f"query_id {kinds[0]}, id {kinds[1]}, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def topk_vectors(vectors: DataFrame, queries: DataFrame, k: int, floor: float, block: int = BLOCK, first: int = FIRST, per_group: int = QUERIES) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` best of ``vectors (id, v)`` for every query, none below ``floor``."""
    queries = settle(queries.select("query_id", F.col("vector").alias("q")), "queries")
    blocks, known, pivots = cluster(vectors, block)
    reach = {r["cluster"]: r["radius"] for r in known.groupBy("cluster").agg(F.max("radius").alias("radius")).collect()}  # at most PIVOTS
    radius = np.array([reach.get(i, -np.inf) for i in range(len(pivots))])
    kind = dict(queries.dtypes)["query_id"]

    def open_clusters(table: DataFrame, nearest: int | None) -> DataFrame:
        """``(query_id, cluster, near)``: the nearest clusters, or the others that ``least`` leaves open."""

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                near = _units(matrix_of(batch.column("q"), pivots.shape[1] or None)) @ pivots.T
                near[:, ~np.isfinite(radius)] = -np.inf
                order = np.argsort(-near, axis=1, kind="stable")[:, :first]
                early = np.zeros(near.shape, dtype=bool)
                np.put_along_axis(early, order, True, axis=1)
                early &= np.isfinite(near)
                take = early if nearest else ~early & (near + radius + _SLACK >= batch.column("least").to_numpy()[:, None])
                rows, cols = np.nonzero(take)
                yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(rows)), pa.array(cols.astype(np.int32)), pa.array(near[rows, cols])], ["query_id", "cluster", "near"])

        return table.mapInArrow(run, f"query_id {kind}, cluster int, near double")

    start = open_clusters(queries.withColumn("least", F.lit(floor)), first).join(known, "cluster")
    start = settle(start.where(F.col("near") + F.col("radius") + _SLACK >= floor).select("query_id", "cluster", "block"), "first-blocks")
    found = settle(_best(_scored(blocks, start, queries, k, floor, per_group), k), "first-found")
    reached = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select("query_id", "least")
    asked = queries.join(reached, "query_id", "left").withColumn("least", F.greatest(F.coalesce("least", F.lit(floor)), F.lit(floor)))
    rest = open_clusters(asked, None).join(known, "cluster").join(asked.select("query_id", "least"), "query_id")
    rest = settle(rest.where(F.col("near") + F.col("radius") + _SLACK >= F.col("least")).select("query_id", "cluster", "block"), "open-blocks")
    if rest.isEmpty():
        return found
    more = _scored(blocks, rest, queries, k, floor, per_group)
    return _best(found.select("query_id", "id", "score").unionByName(more), k)
