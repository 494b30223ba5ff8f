"""The classifier by its accuracy on rows it never learned from."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import quality
from tests.llm.odd import LABELS, no_docs, odd_docs

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    return quality.judge(docs, labels).join(labels, "doc_id", "left").collect()


def test_held_out_rows(judged):
    late = [r for r in judged if r.held_out and r.quality is not None]
    assert len(judged) == 10_000 and len(late) > 500
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in judged)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in judged)
    assert np.mean([r.predicted == r.quality for r in late]) >= 0.97
    good, bad = ([r.score for r in late if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_context_sums_against_counting(spark):
    texts = ["a b c a", "", None, "b", "c c c c c c c"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    places, signs = quality.index_vectors()
    index = np.zeros((quality.ROWS, quality.DIM))
    for r in range(quality.ROWS):
        for p, s in zip(places[r], signs[r]):
            index[r, p] += s
    want, seen = np.zeros_like(index), np.zeros(quality.ROWS)
    for t in texts:
        rows = [zlib.crc32(w.encode()) % quality.ROWS for w in (t or "").split()]
        for i, r in enumerate(rows):
            seen[r] += 1
            for j in range(max(0, i - 2), min(len(rows), i + 3)):
                if i != j:
                    want[r] += index[rows[j]]
    held = quality.BLOCK
    for block in (3, held):
        quality.BLOCK = block
        sums, counts = quality.context_sums(docs)
        assert (sums == want).all() and (counts == seen).all()


def test_temperature_helps():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = (x[:, 0] + rng.normal(size=600) > 0).astype(float)
    net = quality.train(x, y)
    assert net.temperature > 0
    late = net.scores(x)
    assert np.mean((late > 0.5) == y) > 0.7


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 1, 1), (2, 0, 0), (99, 1, 0)], LABELS)
    rows = quality.judge(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    kept = quality.accepted(docs, labels, threshold=0.0)
    assert kept.dtypes == docs.dtypes and kept.count() == docs.count()
    assert {r.score for r in quality.judge(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.judge(no_docs(spark), labels).count() == 0


def test_scores_ignore_other_columns(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    score = lambda df: {r.text: r.score for r in quality.scored(df.select("text"), model, ["text"]).collect()}
    assert score(docs) == score(docs.withColumn("source", F.lit("x")).repartition(7))


def test_pooling_by_blocks():
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(quality.ROWS, 4)).astype(np.float32)
    text = b" ".join(rng.choice([b"a", b"bb", b"c", b"dd"], size=25).tolist())
    held, quality.BLOCK = quality.BLOCK, 200_000
    whole = quality.pooled(text, vectors)
    quality.BLOCK = 4
    parts = quality.pooled(text, vectors)
    quality.BLOCK = held
    v = vectors[quality.word_rows(text)].astype(float)
    want = [*v.mean(axis=0), *(v[:-1] * v[1:]).mean(axis=0), (v[:-1] * v[1:]).sum(axis=1).mean(), np.log1p(25)]
    assert np.allclose(whole, want, atol=1e-5) and np.allclose(parts, want, atol=1e-5)


def test_repeated_labelled_id_trains_once(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0").first()
    again = docs.where(docs.doc_id == known.doc_id)
    copies = again.crossJoin(spark.range(3000)).drop("id")
    held = docs.union(copies.withColumn("text", F.concat("text", F.lit(" more"))))
    x = []
    kept_train, quality.train = quality.train, lambda a, y: x.append(a) or kept_train(a, y)
    try:
        quality.fit(held, labels)
    finally:
        quality.train = kept_train
    assert len(x[0]) <= labels.select("doc_id").distinct().count()
