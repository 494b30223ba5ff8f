"""The classifier by rows it never learned from, its counts and sums by brute force."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import toxicity
from tests.llm.odd import DOCS, LABELS, no_docs, odd_docs

FOLDER = "/root/testdata/sf0.1"


def plain(text):
    return " " + " ".join((text or "").lower().split()) + " "


def number(gram):
    """The hash of one n-gram, step by step."""
    mask, mix = (1 << 64) - 1, 0x9E3779B97F4A7C15
    h = ord(gram[0]) + 1
    for ch in gram[1:]:
        h = (((h * mix) & mask) ^ (h >> 31)) + ord(ch) & mask
    return (h * mix & mask) >> 64 - toxicity.BITS


def brute(text):
    p = plain(text)
    return sorted({number(p[i:i + n]) for n in range(toxicity.SHORTEST, toxicity.LONGEST + 1) for i in range(len(p) - n + 1)})


@pytest.mark.parametrize("block", [1, 7, toxicity.BLOCK])
def test_grams(block):
    held, toxicity.BLOCK = toxicity.BLOCK, block
    try:
        for text in ["", None, "a", "Some  Words,\n and MORE words", "ß\U0001f600é" * 9]:
            assert toxicity.different(None if text is None else text.encode()).tolist() == brute(text)
    finally:
        toxicity.BLOCK = held


def test_counts_and_ratios(spark):
    rows = [(1.0, "you scum"), (1.0, "scum you"), (0.0, "you there"), (0.0, "there, there"), (0.0, None), (0.4, "you")]
    found = toxicity.counts(spark.createDataFrame(rows, "toxic double, text string").repartition(3))
    want = {k: Counter(g for t, x in rows if (t >= 0.5) == k for g in brute(x)) for k in (True, False)}
    got = {r.gram: (r.toxic, r.other) for r in found.collect()}
    assert got == {g: (want[True][g], want[False][g]) for g in {*want[True], *want[False]}}
    features, ratio = toxicity.ratios(found, 2, 4, 2, 0.5)
    for g, r in zip(features, ratio):
        a, b = got[g]
        assert a + b >= 2 and abs(r) >= 0.5 and np.isclose(r, np.log((a + 1) / 4) - np.log((b + 1) / 6))
    assert number(" scum"[:4]) in features.tolist()


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    judged = toxicity.judge(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(judged) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in judged)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in judged)
    late = [r for r in judged if r.held_out and r.toxic is not None]
    bad, fine = ([r.score for r in late if r.toxic == t] for t in (1, 0))
    assert len(late) > 500 and np.mean([b > f for b in bad for f in fine]) >= 0.98
    assert np.mean([b >= 0.5 for b in bad]) >= 0.8 and np.mean([f >= 0.5 for f in fine]) <= 0.01


def test_scores_are_sums_of_weights(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    again = toxicity.fit(docs.repartition(7), labels)
    assert (model.features == again.features).all() and np.allclose(model.weights, again.weights)
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    got = {r.doc_id: r.score for r in toxicity.scored(docs.withColumn("source", F.lit("x")), model).collect()}
    for r in docs.orderBy("doc_id").limit(60).collect():
        z = sum(weight.get(g, 0.0) for g in brute(r.text)) + model.start
        assert np.isclose(got[r.doc_id], 1 / (1 + np.exp(-np.clip(model.scale * z + model.shift, -40, 40))), atol=1e-4)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, None, None), (None, 1, 1), (2, 0, 1), (99, 1, 0)], LABELS)
    for some in (labels, labels.limit(0), labels.where("toxic = 0")):
        rows = toxicity.judge(docs, some).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in toxicity.judge(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.judge(no_docs(spark), labels).count() == 0


def test_repeated_labelled_id_is_learned_once(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], LABELS)
    rows = [(i, f"{'bad' if i % 2 else 'good'} words {i}", "en", "a", 0) for i in range(40)]
    rows += [(rows[1][0], "other words of the same id", "en", "a", 0)] * 5000
    held = toxicity.learned(spark.createDataFrame(rows, DOCS), labels, 1000)
    ids = [r.doc_id for r in held.collect()]
    assert len(ids) == len(set(ids)) <= 40
