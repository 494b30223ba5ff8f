"""Nearest neighbours by inner product over robust-pruned directed graphs.

Vectors are dealt into shards by a range of norms and a hash. In a shard a graph is grown in batches: a greedy
beam search of the graph so far proposes neighbours for each new vector, and robust
pruning keeps an edge only while no kept neighbour is closer to its end by the factor
``ALPHA``, so the edges stay few and point into different directions. Edges also lead
back, and a node with too many is pruned the same way. Largest inner product is smallest
distance once every vector has one more coordinate that gives all of them one norm.
Distances are in double precision on vectors scaled by the shard's largest norm, and the
norms of a shard differ by a factor of ``2 ** RANGE`` at most, so a few very long vectors
take nothing from the distances among the others. Queries are scaled to norm one.

Every query searches every shard with a beam. Queries travel in blocks, and a task has
one shard's index and one block. What the beams return is scored in double precision on
the original vectors and ranked; equal vectors are one node with their smallest ids.

Defined results: vectors that are null, zero or hold null or non-finite components take
no part, neither as query nor as candidate. Ties go to the smaller id. A query's own id is
no candidate. With fewer than ``k`` candidates all that are found are returned. Vectors
of one table must have one length. Without queries or candidates the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .vectors import least_ids, matrix, usable

K = 20
SHARD = 4096
QUERY_BLOCK = 4096
#: Powers of two between the least and the largest norm of a shard.
RANGE = 10
DEGREE = 48
BEAM = 96
ALPHA = 1.2
#: Nodes a query opens at a time, and queries searched together.
WIDTH = 4
TOGETHER = 512
SEED = 5


def _distances(x: np.ndarray, norms: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own ids, less the query's own norm."""
    return norms[ids] - 2 * np.matmul(x[ids], q[:, :, None])[:, :, 0]


def beam_search(x, norms, graph, entry: int, q, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the nearest nodes found, nearest first; -1 where there are none."""
    n, rows = len(x), np.arange(len(q))
    ids = np.full((len(q), beam), n, dtype=np.int64)
    near = np.full((len(q), beam), np.inf)
    open_ = np.zeros((len(q), beam), dtype=bool)
    seen = np.zeros((len(q), n + 1), dtype=bool)
    seen[:, [entry, n]] = True
    ids[:, 0], open_[:, 0] = entry, True
    near[:, 0] = _distances(x, norms, q, ids[:, :1])[:, 0]
    active = rows
    while len(active):
        # The nearest open nodes of each active query; the beam is sorted.
        own = open_[active]
        rank = np.cumsum(own, axis=1)
        take = own & (rank <= WIDTH)
        picked = np.full((len(active), WIDTH), n, dtype=np.int64)
        a, b = np.nonzero(take)
        picked[a, rank[a, b] - 1] = ids[active[a], b]
        open_[active] = own & ~take
        new = graph[picked].reshape(len(active), -1)
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = n
        new[seen[active[:, None], new]] = n
        seen[active[:, None], new] = True
        # Only the columns that hold something.
        new.sort(axis=1)
        new = new[:, : max(1, int((new < n).sum(axis=1).max()))]
        far = _distances(x, norms, q[active], np.minimum(new, n - 1))
        far[new == n] = np.inf
        all_ids = np.concatenate([ids[active], new], axis=1)
        all_near = np.concatenate([near[active], far], axis=1)
        all_open = np.concatenate([open_[active], new < n], axis=1)
        order = np.argsort(all_near, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, order, axis=1)
        near[active] = np.take_along_axis(all_near, order, axis=1)
        open_[active] = np.take_along_axis(all_open, order, axis=1)
        active = active[open_[active].any(axis=1)]
    ids[ids == n] = -1
    return ids, near


def robust_prune(x, norms, points, candidates, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each point out of its candidates (-1: none), ``len(x)`` filling up."""
    n = len(x)
    bad = (candidates < 0) | (candidates >= n) | (candidates == points[:, None])
    ids = np.where(bad, 0, candidates)
    p = x[points]
    far = norms[points][:, None] + _distances(x, norms, p, ids)
    far[bad] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
    own = x[ids]
    between = norms[ids][:, :, None] + norms[ids][:, None, :] - 2 * np.matmul(own, own.transpose(0, 2, 1))
    alive, rows = np.isfinite(far), np.arange(len(points))
    chosen = np.full((len(points), degree), n, dtype=np.int64)
    for place in range(degree):
        best = alive.argmax(axis=1)
        there = alive[rows, best]
        if not there.any():
            break
        chosen[there, place] = ids[rows, best][there]
        gone = alpha * alpha * np.maximum(between[rows, best], 0) <= far
        alive &= ~(gone & there[:, None])
        alive[rows, best] = False
    return chosen


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Graph (one row of neighbours a node, ``len(x)`` filling up) and the node to start at."""
    n = len(x)
    norms = np.einsum("ij,ij->i", x, x)
    entry = int(np.argmin(norms - 2 * x @ x.mean(axis=0)))
    graph = np.full((n + 1, degree), n, dtype=np.int64)
    order = np.random.default_rng(SEED).permutation(n)
    order = order[order != entry]
    at = 0
    while at < len(order):
        points = order[at:at + min(TOGETHER, max(1, at))]
        at += len(points)
        found, _ = beam_search(x, norms, graph, entry, x[points], beam)
        graph[points] = robust_prune(x, norms, points, found, degree, alpha)
        _lead_back(x, norms, graph, points, degree, alpha)
    return graph, entry


def _lead_back(x, norms, graph, points, degree: int, alpha: float) -> None:
    """Edges from the neighbours of new points back to them."""
    n = len(x)
    to, since = graph[points].reshape(-1), np.repeat(points, degree)
    since, to = since[to < n], to[to < n]
    order = np.argsort(to, kind="stable")
    nodes, starts, more = np.unique(to[order], return_index=True, return_counts=True)
    held = (graph[nodes] < n).sum(axis=1)
    fits = held + more <= degree
    for node, start, count, full in zip(nodes[fits], starts[fits], more[fits], held[fits]):
        graph[node, full:full + count] = since[order[start:start + count]]
    rest = np.nonzero(~fits)[0]
    rest = rest[np.argsort(more[rest], kind="stable")]
    for at in range(0, len(rest), 256):
        own = rest[at:at + 256]
        candidates = np.full((len(own), degree + int(more[own].max())), n, dtype=np.int64)
        candidates[:, :degree] = graph[nodes[own]]
        for row, k in enumerate(own):
            candidates[row, degree:degree + more[k]] = since[order[starts[k]:starts[k] + more[k]]]
        graph[nodes[own]] = robust_prune(x, norms, nodes[own], candidates, degree, alpha)


def one_norm(x: np.ndarray) -> np.ndarray:
    """Vectors scaled by the largest norm and one more coordinate, so that all have norm one."""
    x = x / np.abs(x).max()  # first by the largest component, so that no square overflows
    norms = np.einsum("ij,ij->i", x, x)
    x, norms = x / np.sqrt(norms.max()), norms / norms.max()
    return np.column_stack([x, np.sqrt(np.maximum(1 - norms, 0))])


def _units(q: np.ndarray) -> np.ndarray:
    q = q / np.abs(q).max(axis=1, keepdims=True)
    return q / np.sqrt(np.einsum("ij,ij->i", q, q))[:, None]


def nearest(x, graph, entry: int, least, q, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the ``k`` best nodes found: query's place, node, exact inner product."""
    flat = one_norm(x)
    norms = np.einsum("ij,ij->i", flat, flat)
    places, nodes, scores = [], [], []
    for at in range(0, len(q), TOGETHER):
        own = q[at:at + TOGETHER]
        found, _ = beam_search(flat, norms, graph, entry, np.pad(_units(own), ((0, 0), (0, 1))), beam)
        exact = np.matmul(x[np.maximum(found, 0)], own[:, :, None])[:, :, 0]
        exact[found < 0] = -np.inf
        order = np.lexsort((least[np.maximum(found, 0)], -exact), axis=1)[:, :k]
        found, exact = np.take_along_axis(found, order, axis=1), np.take_along_axis(exact, order, axis=1)
        a, b = np.nonzero(found >= 0)
        places.append(at + a), nodes.append(found[a, b]), scores.append(exact[a, b])
    return tuple(np.concatenate(v) if v else np.zeros(0, np.int64) for v in (places, nodes, scores))


def _norm_range(vector: Column) -> Column:
    """Number of the range of norms a vector is in."""
    largest = F.aggregate(vector, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))
    squares = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x.cast("double") / largest) * (x.cast("double") / largest))
    return F.floor((F.log2(largest) + F.log2(squares) / 2) / RANGE).cast("int")


def deal(distinct: DataFrame, shard: int) -> tuple[DataFrame, int]:
    """``distinct`` with its ``shard``, and how many there are; each holds one range of norms."""
    ranged = settle(distinct.select("n", "embedding", "ids", _norm_range(F.col("embedding")).alias("range")), "ranges")
    counts = sorted((r["range"], r["count"]) for r in ranged.groupBy("range").count().collect())  # few: ranges of exponents
    first, dealt, shards = F.lit(0), F.lit(1), 0
    for number, count in counts:
        here = -(-count // shard)
        first, dealt = F.when(F.col("range") == number, shards).otherwise(first), F.when(F.col("range") == number, here).otherwise(dealt)
        shards += here
    return ranged.withColumn("shard", (first + F.pmod(F.xxhash64("n"), dealt)).cast("int")).drop("range"), max(1, shards)


def build_index(distinct: DataFrame, shards: int, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """One row a ``shard``: its nodes' numbers and least ids, vectors and graph, as bytes."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("n")
        x = matrix(group.column("embedding").combine_chunks())
        graph, entry = build(one_norm(x), degree, beam, alpha)
        parts = [group.column("n").to_numpy(), group.column("least").to_numpy(), x, graph.astype(np.int32)]
        cells = {k: [np.ascontiguousarray(v).tobytes()] for k, v in zip(("numbers", "least", "vectors", "graph"), parts)}
        return pa.table({"shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), **cells, "entry": pa.array([entry], pa.int32()), "size": pa.array([len(x)], pa.int32())})

    dealt = distinct.select(
        "shard", "n", "embedding",
        F.coalesce(F.element_at("ids", 1), F.lit(2**63 - 1)).alias("least"),
    )
    schema = "shard int, numbers binary, least binary, vectors binary, graph binary, entry int, size int"
    return dealt.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(run, schema)


def _blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """One row a block of queries, each of about ``QUERY_BLOCK``."""
    dealt = queries.select(F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block"), "q", "embedding")
    return dealt.groupBy("block").agg(F.collect_list(F.struct("q", "embedding")).alias("queries"))


def _search(pairs: DataFrame, k: int, beam: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {c: batch.column(c)[row] for c in batch.schema.names}
                size = cell["size"].as_py()
                numbers, least = (np.frombuffer(cell[c].as_py(), np.int64) for c in ("numbers", "least"))
                x = np.frombuffer(cell["vectors"].as_py(), np.float64).reshape(size, -1)
                graph = np.frombuffer(cell["graph"].as_py(), np.int32).reshape(size + 1, -1).astype(np.int64)
                asked = cell["queries"].values
                places, nodes, scores = nearest(x, graph, cell["entry"].as_py(), least, matrix(asked.field("embedding")), k, beam)
                found = [asked.field("q").to_numpy()[places], numbers[nodes], least[nodes], scores]
                yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["q", "n", "least", "score"])

    return pairs.mapInArrow(run, "q long, n long, least long, score double")


def search(vectors: DataFrame, asked: Column, k: int = K, shard: int = SHARD, degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """The ``k`` nearest of every row that ``asked`` picks, among all other rows."""
    distinct = least_ids(vectors, k + 1)
    queries = settle(
        vectors.where(asked & usable(F.col("embedding"))).select(F.monotonically_increasing_id().alias("q"), F.col("vec_id").alias("query_id"), "embedding"),
        "queries",
    )
    dealt, shards = deal(distinct, shard)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    index = settle(build_index(dealt, shards, degree, max(beam, k + 1)), "index")
    tasks = 2 * min(shards * blocks, 50_000)
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, "shard", "block")
    right = _blocks(queries, blocks).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(tasks, "shard", "block")
    found = _search(left.join(right, ["shard", "block"]), k + 1, max(beam, k + 1))
    by_vector = Window.partitionBy("q").orderBy(F.col("score").desc(), "least")
    best = settle(found.withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= k + 1).drop("place", "least"), "found")
    ids = best.join(distinct.select("n", "ids"), "n").select("q", "score", F.explode("ids").alias("vec_id"))
    others = ids.join(queries.select("q", "query_id"), "q").where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    ranked = others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
