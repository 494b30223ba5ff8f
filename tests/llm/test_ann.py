"""Nearest neighbours against all inner products."""

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"
ASKED = "vec_id % 20 = 0"


def table(spark, x, ids=None):
    return spark.createDataFrame([(int(i), v, 0) for i, v in zip(range(len(x)) if ids is None else ids, x.tolist())], SCHEMA)


def check(vectors, found, k=20, least=0.95):
    rows = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in vectors.collect() if r.embedding is not None]
    rows = [(i, v) for i, v in rows if None not in v.tolist() and np.isfinite(v).all() and v.any()]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for q in np.nonzero(ids % 20 == 0)[0]:
        scores = x @ x[q]
        others = np.nonzero(ids != ids[q])[0]
        best = others[np.lexsort((ids[others], -scores[others]))][:k]
        mine = sorted(got.pop(int(ids[q]), []))
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and len(mine) == min(k, len(others))
        at = {int(i): float(s) for i, s in zip(ids, scores)}
        assert all(abs(at[i] - s) < 1e-12 * max(1, abs(s)) for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit, total = hit + len({m[1] for m in mine} & set(ids[best].tolist())), total + len(best)
    assert not got and hit >= least * total
    return hit / max(1, total)


def test_whole_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    check(vectors, ann.search(vectors, F.expr(ASKED)))


def test_many_shards_and_norms(spark):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(12, 24))
    x = middles[rng.integers(12, size=3000)] + 0.4 * rng.normal(size=(3000, 24))
    x *= rng.lognormal(0, 0.6, size=(3000, 1))
    vectors = table(spark, x.astype(np.float32).astype(float))
    ann.QUERY_BLOCK, held = 40, ann.QUERY_BLOCK
    found = ann.search(vectors, F.expr(ASKED), shard=500)
    check(vectors, found)
    ann.QUERY_BLOCK = held


def test_a_few_very_long_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[7] *= 1e4
    x[8] *= 1e7
    x[9] *= 1e25
    x[40] *= 1e-12
    vectors = table(spark, x.astype(np.float32).astype(float))
    check(vectors, ann.search(vectors, F.expr(ASKED)))


def test_copies_and_ties(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8)).round(1)
    x[50:350] = x[50]
    vectors = table(spark, x)
    check(vectors, ann.search(vectors, F.expr(ASKED), shard=64), least=0.999)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (20, None, 1), (40, [0.0, 0.0], 1), (60, [float("nan"), 1.0], 1), (80, [None, 1.0], 1),
            (100, [float("inf"), 1.0], 1), (3, [0.5, 0.5], 1), (7, [0.5, 0.5], 1), (120, [-1.0, 2.0], None)]
    vectors = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(1)).withColumn("rank", F.lit(2))
    got = sorted(tuple(r) for r in ann.search(vectors, F.expr(ASKED)).collect())
    assert got == [(0, 1, 3, 0.5), (0, 2, 7, 0.5), (0, 3, 120, -1.0), (120, 1, 3, 0.5), (120, 2, 7, 0.5), (120, 3, 0, -1.0)]
    assert ann.search(vectors.limit(0), F.expr(ASKED)).count() == 0
    assert ann.search(vectors, F.lit(False)).count() == 0
    assert ann.search(vectors.where("vec_id = 0"), F.expr(ASKED)).count() == 0


def test_pruned_edges_point_apart():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6)).astype(np.float32)
    norms = (x * x).sum(axis=1)
    near = np.argsort(((x[0] - x) ** 2).sum(axis=1))[1:80]
    kept = ann.robust_prune(x, norms, np.array([0]), near[None, :], 12, 1.2)[0]
    kept, want = kept[kept < 300], []
    for c in near:
        d = ((x[c] - x[0]) ** 2).sum()
        if len(want) < 12 and all(1.44 * ((x[c] - x[w]) ** 2).sum() > d for w in want):
            want.append(c)
    assert kept.tolist() == want
