"""Runs against brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lectern.llm import runs
from lectern.llm.queries import planted_runs
from tests.llm.odd import DOCS, no_docs, odd_docs


def brute(words):
    """All runs by trying every period and stretch."""
    found, n = set(), len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            a, b = i, j + q
            if b - a >= max(6, 4 * q) and not any(all(words[x] == words[x + d] for x in range(a, b - d)) for d in range(1, q)):
                found.add((a, q, b - a))
            i = j
    return sorted(found)


def left(words, spans):
    gone = {i for a, q, size in spans for i in range(a + q, a + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def check(docs, rows, rewrite=None):
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(([(s.start, s.period, s.length) for s in r.runs], r.collapsed, r.told))
    for doc_id, text in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        if rewrite:
            words = [w.decode() for w in rewrite(doc_id, [w.encode() for w in words])]
        want = brute(words)
        assert (want, left(words, want) if want else None, hashlib.sha256(" ".join(words).encode()).hexdigest()) in by[doc_id], (doc_id, words[:50])


def periodic(rng, size):
    """Words with runs of many periods, some inside others, some broken by one word."""
    words = []
    while len(words) < size:
        unit = rng.choices("abcdef", k=rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 40]))
        if rng.random() < 0.3:
            unit = unit * rng.randrange(2, 6) + rng.choices("xy", k=1)
        part = (unit * rng.randrange(1, 9))[: rng.randrange(1, 400)]
        if rng.random() < 0.2:
            part[rng.randrange(len(part))] = "z"
        words += part + [str(rng.random())] * (rng.random() < 0.3)
    return words


@pytest.mark.parametrize("tile", [1, 64, runs.TILE])
def test_tiles_against_all_periods(tile):
    rng = random.Random(tile)
    for size in [0, 1, 5, 6, 7, 30, 200, 200, 200, 700, 700]:
        for _ in range(6):
            words = periodic(rng, size)[:size] if size else []
            ids = runs.numbers_of([w.encode() for w in words])
            spans = [(q, a, b) for t in runs.cut(ids, tile) for q, a, b in runs.solve(*t)]
            for q, a, b in spans:
                assert all(words[i] == words[i + q] for i in range(a, b - q))
            got = []
            for q in {s[0] for s in spans}:
                held = []
                for a, b in sorted(s[1:] for s in spans if s[0] == q):
                    if held and a + q <= held[-1][1]:
                        held[-1][1] = max(b, held[-1][1])
                    else:
                        held.append([a, b])
                got += [(a, q, b - a) for a, b in held if b - a >= max(6, 4 * q)]
            assert sorted(got) == brute(words), words


def test_table_with_small_tiles(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(periodic(rng, rng.choice([10, 100, 600])))) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS).repartition(5)
    for spread in (0, 50):
        check(rows, runs.detect(docs, tile=32, spread=spread).collect())


def test_whole_table_by_the_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text) < 40_000]
    found = runs.detect(docs, planted_runs)
    check(rows, found.collect(), planted_runs)
    by = {r.doc_id: r for r in runs.digest(found).collect()}
    assert len(by) == docs.count()
    for doc_id, text in rows:
        words = planted_runs(doc_id, text.encode().split())
        spans, r = brute(words), by[doc_id]
        lines = "".join(f"{a},{size},{q}\n" for a, q, size in spans)
        best = min(spans, key=lambda s: (-s[2], s[0], s[1]), default=None)
        assert r.n_runs == len(spans) and r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert (r.start, r.period, r.length) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[2] // best[1] if best else None)
        assert r.collapsed_sha256 == hashlib.sha256(left([w.decode() for w in words], spans).encode()).hexdigest()


def test_planted_words():
    words = [b"w%d" % i for i in range(50)]
    hit = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g = zlib.crc32(str(hit).encode()) // 10
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert planted_runs(hit, words) == [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    miss = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10)
    assert planted_runs(miss, words) == words and planted_runs(hit, []) == [] and planted_runs(None, words) == words


def test_long_text_in_many_tiles(spark):
    rng = random.Random(9)
    unit = [str(rng.random()) for _ in range(3000)]
    words = unit * 20 + ["a"] * 70_000 + ["b", "c"] * 30_000
    rows = runs.detect(spark.createDataFrame([(1, " ".join(words), "en", "a", 0)], DOCS)).collect()
    assert [tuple(s) for s in rows[0].runs] == [(0, 3000, 60_000), (60_000, 1, 70_000), (130_000, 2, 60_000)]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = runs.detect(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect() if r.doc_id != 6], rows)
    assert len(rows) == docs.count() and runs.detect(no_docs(spark)).count() == 0
    long = next(r for r in rows if r.doc_id == 6)
    assert [tuple(s) for s in long.runs] == [(0, 1, 60_000)] and long.collapsed == "wort"
    out = runs.digest(runs.detect(docs))
    assert out.where("n_runs = 0 AND start IS NOT NULL").count() == 0 and out.where("collapsed_sha256 IS NULL OR runs_sha256 IS NULL").count() == 0
    assert np.unique([r.n_runs for r in out.collect()]).tolist() == [0, 1]
