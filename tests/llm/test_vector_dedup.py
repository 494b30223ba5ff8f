"""Links and components against all cosines."""

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import vector_dedup
from tests.llm.test_ann import SCHEMA, table


def brute(rows):
    """vec_id -> (links, least reachable id) for distinct ids."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    near = (x @ x.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None, :] >= 0.95
    np.fill_diagonal(near, False)
    root = ids.copy()
    while True:
        new = np.minimum(root, np.where(near, root[None, :], ids.max() + 1).min(axis=1))
        if (new == root).all():
            return {int(i): (int(n), int(r)) for i, n, r in zip(ids, near.sum(axis=1), root)}
        root = new


def check(vectors, found, least=0.995):
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()}
    assert set(got) == set(want) and all(kept == (i == root) for i, (_, root, kept) in got.items())
    assert all(got[i][0] <= want[i][0] for i in want)  # no link below the threshold, none twice
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _, _ in got.values()) >= least * links
    assert np.mean([got[i][1] == want[i][1] for i in want]) >= least


def test_whole_table(spark):
    for folder in ("sf0.01", "sf0.1"):
        vectors = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
        check(vectors, vector_dedup.dedup(vectors))


def test_large_groups(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 16))
    x[100:400] = x[100] + 0.02 * rng.normal(size=(300, 16))
    x[400:600] = x[400]
    x[600:700] = x[600] * rng.uniform(0.5, 3, size=(100, 1))
    vectors = table(spark, x.astype(np.float32).astype(float))
    distinct = vector_dedup.distinct_vectors(vectors)
    sums = {r.n: r.s for r in vector_dedup.links(distinct, block=50).groupBy("n").agg(F.sum("links").alias("s")).collect()}
    again = {r.n: r.s for r in vector_dedup.links(distinct).groupBy("n").agg(F.sum("links").alias("s")).collect()}
    assert {k: v for k, v in sums.items() if v} == {k: v for k, v in again.items() if v}
    check(vectors, vector_dedup.dedup(vectors))


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [None, 1.0], 1), (6, [float("inf"), 1.0], 1),
            (7, [2.0, 0.0], 1), (8, [1.0, 0.0], None), (9, [0.0, 1.0], 1), (9, [0.0, 5.0], 1), (None, [-1.0, 0.0], 1), (10, [1e-30, 0.0], 1), (11, [3e38, 0.0], 1)]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumn("links", F.lit(1)).withColumn("n", F.lit(1))
    got = sorted((tuple(r) for r in vector_dedup.dedup(vectors).collect()), key=str)
    five = [(i, 4, 1, i == 1) for i in (1, 7, 8, 10, 11)]
    want = five + [(i, 0, i, True) for i in (2, 3, 4, 5, 6)] + [(9, 1, 9, True)] * 2 + [(None, 0, None, False)]
    assert got == sorted(want, key=str)
    assert vector_dedup.dedup(vectors.limit(0)).count() == 0


def test_shape_meets_its_recall():
    for n in (100, 10_000, 10**9):
        planes, tables = vector_dedup.shape(n)
        meet = (1 - np.arccos(0.95) / np.pi) ** planes
        assert 1 - (1 - meet) ** tables >= vector_dedup.RECALL
