"""Packing against the tokenizers library and the bounds of bin packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lectern.llm import packing
from lectern.llm.tokens import Encoder
from tests.llm.odd import no_docs, odd_docs


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(docs, rows, whole, size=1024):
    """Every document is whole, every sequence gapless and not too long."""
    want = defaultdict(int)
    for d in docs:
        ids = whole.encode(d.text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(d.doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    got = defaultdict(int)
    bins = defaultdict(list)
    for r in rows:
        got[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        bins[r.sequence_id].append((r.offset, r.length))
        if r.ids is not None:
            assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert got == want
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    return len(bins), -(-sum(r.length for r in rows) // size)


def test_whole_table(spark, whole):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    used, least = check(docs.collect(), packing.pack(docs).collect(), whole)
    assert used <= least + 2


def test_odd_rows(spark, whole):
    docs = odd_docs(spark)
    check(docs.collect(), packing.pack(docs).collect(), whole)
    assert packing.pack(docs, ids=False).where("ids IS NOT NULL").count() == 0
    assert packing.pack(no_docs(spark)).count() == 0


def test_same_ids_as_the_library(spark, whole):
    encode = Encoder(kept_words=50)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(150).collect()]
    rng = random.Random(3)
    parts = [" ", "  ", "\n", " \n", "\t ", "a", "Bc", "'s", "1", "23", "!?", "ß", " ", " ", "<|endoftext|>", "\U0001f600", ",", "é"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(1, 12))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_plan_is_tight():
    rng = random.Random(1)
    for _ in range(20):
        size = rng.choice([16, 100, 1024])
        counts = {k: rng.randrange(1, 60) for k in rng.sample(range(1, size + 1), rng.choice([1, 2, size // 8, size // 2, size]))}
        steps = packing.plan(dict(counts), size)
        placed = defaultdict(int)
        for times, chosen in steps:
            assert sum(k * n for k, n in chosen.items()) <= size
            for k, n in chosen.items():
                placed[k] += n * times
        assert placed == counts
        rooms = []  # first-fit decreasing
        for k in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
            at = next((i for i, room in enumerate(rooms) if room >= k), None)
            if at is None:
                rooms.append(size - k)
            else:
                rooms[at] -= k
        if len(counts) > size // 4:  # as corpora have it: many lengths
            assert sum(t for t, _ in steps) <= 1.02 * len(rooms)


def test_fullest_is_best():
    rng = random.Random(2)
    for _ in range(200):
        counts = {k: rng.randrange(1, 4) for k in rng.sample(range(1, 20), 4)}
        room = rng.randrange(1, 40)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1) if s + k * i <= room}
        chosen = packing.fullest(counts, room)
        assert sum(k * n for k, n in chosen.items()) == max(sums)
        assert all(n <= counts[k] for k, n in chosen.items())
