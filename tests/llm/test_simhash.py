"""SimHash classes against comparing every pair."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lectern.llm import simhash
from lectern.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def slow_print(text, words=3):
    """Bit by bit, as the contract says it."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts, now = [], ""
    for c in low + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            parts += [now] if now else []
            now = ""
        else:
            now += c
    shingles = [" ".join(parts[i:i + words]) for i in range(len(parts) - words + 1)] or ([" ".join(parts)] if parts else [])
    value = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s.encode(), 42) >> bit & 1 for s in shingles)
        value |= (2 * ones > len(shingles)) << bit
    return value


def slow_classes(prints):
    """doc_id -> smallest id reachable, by union over all pairs."""
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.assign(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: slow_print(t) for i, t in texts.items()}
    want = slow_classes(prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in texts}


@pytest.mark.parametrize("list_rows", [2, 512])
def test_links_find_all_pairs(spark, list_rows):
    rng = random.Random(5)
    values = {0, 1, (1 << 64) - 1}
    for _ in range(30):
        near = rng.getrandbits(64)
        for _ in range(12):
            near ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            values.add(near)
    base = rng.getrandbits(64)
    values |= {base ^ sum(1 << b for b in rng.sample(range(16), 5)) for _ in range(300)}
    signed = np.array(sorted(values), dtype=np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = simhash.links(fps, list_rows=list_rows)
    got = {r.node: r.root for r in components(edges).collect()}
    want = slow_classes({v: v & ((1 << 64) - 1) for v in signed})
    assert {v: got.get(v, v) for v in signed} == want


def test_odd_rows(spark):
    rows = [
        (1, "One two three four five", "en", "a", 1), (2, "one TWO three four\x0bfive ", None, None, None), (3, None, "en", "a", 0),
        (4, "", "en", "a", 0), (None, " \t ", "en", "a", 0), (1, "One two three four five", "en", "a", 1),
        (6, "word " * 400_000, "en", "a", 0), (None, "alone in the whole wide world", "x", "y", 5), (7, "É é", "", "", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("mine")).withColumn("n", F.lit(1)).withColumn("row", F.lit(2))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.assign(docs).collect()), key=str)
    prints = {i: f"{slow_print(t):016x}" for i, t in [(1, rows[0][1]), (6, "word " * 5), (7, "É é"), (0, rows[7][1])]}
    zero = "0" * 16
    want = [(1, prints[1], 1)] * 2 + [(2, prints[1], 1), (3, zero, 3), (4, zero, 3), (None, zero, 3), (6, prints[6], 6), (7, prints[7], 7), (None, prints[0], None)]
    assert got == sorted(want, key=str)
    kept = simhash.dedup(docs)
    assert kept.dtypes == docs.dtypes
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["1", "3", "6", "7", "None"]


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert simhash.assign(docs).count() == 0
    assert simhash.dedup(docs).count() == 0


def test_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(edges.union(spark.createDataFrame([(900, 901), (5, 5)], "a long, b long")))
    got = {r.node: r.root for r in found.collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 901: 900}


