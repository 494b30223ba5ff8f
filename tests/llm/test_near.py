"""Near-duplicates against all pairs of shingle sets."""

import random
from collections import defaultdict
from itertools import combinations

import corpus_pipeline
from tests.llm.odd import DOCS, no_docs, odd_docs


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def kept(rows):
    """Smallest id of every component of the pairs that share 0.8 of their shingles."""
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by[x].append(i)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in {p for held in by.values() for p in combinations(sorted(held), 2)}:
        n = len(sets[a] & sets[b])
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n) and top(a) != top(b):
            root[max(top(a), top(b))] = min(top(a), top(b))
    return sorted(i for i in root if root[i] == i)


def left(docs):
    return sorted(r.doc_id for r in corpus_pipeline.drop_copies(docs.sparkSession, docs, "").collect())


def test_copies_of_all_degrees(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(60):
        base = rng.choices(words, k=rng.choice([8, 30, 120, 600]))
        for _ in range(rng.randrange(1, 5)):
            # Some changes in a row of words: similarities on both sides of 0.8.
            new, at = list(base), rng.randrange(len(base))
            for i in range(at, min(len(base), at + rng.randrange(max(2, len(base) // 6)))):
                new[i] = rng.choice(words)
            rows.append(" ".join(new))
    hot = rng.choices(words, k=200)
    rows += [" ".join(hot[:i] + ["x"] + hot[i:]) for i in range(60)]  # near copies of one text
    half = rng.choices(words, k=150)
    rows += [" ".join(half + rng.choices(words, k=60)) for _ in range(60)]  # a shared passage, not similar
    rows += ["One two Three", "one  two three", "one two four", "", " \n"]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS)
    assert left(docs) == kept(rows)


def test_pipeline_stage_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert left(docs) == kept([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = corpus_pipeline.drop_copies(spark, docs, "")
    assert out.dtypes == docs.dtypes
    # Texts without words are one class; the rows of one text are one.
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "5", "6", "7", "None"]
    assert corpus_pipeline.drop_copies(spark, no_docs(spark), "").count() == 0


def test_fingerprints_are_majorities_of_drawn_shingles():
    import numpy as np

    from lectern.llm import near

    rng = random.Random(3)
    words = [f"w{i}".encode() for i in rng.sample(range(10_000), 204)]
    prints = lambda ws: np.frombuffer(near.signature(ws, b" ".join(ws)), np.uint64)
    (hashes,) = near._hashes(words, b" ".join(words))
    folded = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = (near._TIMES * folded + near._PLUS).min(axis=1)
    drawn = near._mixed(least + (np.arange(len(least), dtype=np.uint64) << np.uint64(32))).reshape(near.BANDS, near.DRAWN)
    for got, hashed in zip(prints(words), drawn):
        ones = [sum(int(h) >> i & 1 for h in hashed) for i in range(64)]
        assert [int(got) >> i & 1 for i in range(64)] == [int(2 * n > near.DRAWN) for n in ones]
    # 200 shingles, of which 22 are others: a similarity of 0.8; and no shingle shared.
    close = words[:80] + [b"x%d" % i for i in range(18)] + words[98:]
    far = [b"y" + w for w in words]
    bits = lambda ws: int(np.bitwise_count(prints(words) ^ prints(ws)).sum())
    assert bits(close) <= near.MOST_BITS and 900 < bits(far) < 1150
