import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern import canon
from lectern.operators import blockmax, index, retrieve

STOP = set(canon.STOPWORDS)


def words(text):
    return [w for w in re.findall("[a-z0-9]+", text.lower()) if w not in STOP and len(w) > 1]


def brute(docs, query, k=5):
    """Straightforward scoring of a small corpus, for comparison."""
    counts = {i: words(t) for i, t in docs}
    n, avg = len(docs), sum(map(len, counts.values())) / len(docs)
    terms = list(dict.fromkeys(words(query)))
    df = {t: sum(t in c for c in counts.values()) for t in terms}
    if not terms or sum(df[t] > 0 for t in terms) / len(terms) < 0.8:
        return []
    score = {}
    for i, c in counts.items():
        s = 0.0
        for t in terms:
            f = c.count(t)
            if f:
                s += math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * len(c) / avg))
        score[i] = s
    ranked = sorted(score, key=lambda i: (-score[i], i))[:k]
    if not ranked or score[ranked[0]] < 0.5:
        return []
    return [(i, round(score[i], 6)) for i in ranked if score[i] > 0]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["soul", "faith", "the", "and"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(60)]
    docs += [(60, docs[3][1]), (61, docs[3][1]), (62, ""), (63, "the and of")]
    return docs, spark.createDataFrame(docs, "id long, text string").repartition(5)


QUERIES = ["soul faith w3", "w1 w1 w2 the", "absent words only", "soul faith w3 w4 absent", "the and", "", "w5"]


@pytest.mark.parametrize("query", QUERIES)
def test_search_matches_brute_force(corpus, query):
    docs, df = corpus
    got = [(r.id, round(r.score, 6)) for r in retrieve.search(df, query).orderBy(F.desc("score"), "id").collect()]
    assert got == brute(docs, query)


@pytest.fixture(scope="module")
def stored(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lexical") / "index")
    index.write_index(corpus[1], path)
    return index.read_index(spark, path)


@pytest.mark.parametrize("query", QUERIES)
def test_stored_index_matches_brute_force(corpus, stored, query):
    got = [(r.id, round(r.score, 6)) for r in retrieve.search_index(stored, query).orderBy(F.desc("score"), "id").collect()]
    assert got == brute(corpus[0], query)


@pytest.mark.parametrize("from_index", [False, True])
def test_batch_matches_brute_force(spark, corpus, stored, from_index):
    docs, df = corpus
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, query string")
    ranked, gate = retrieve.search_batch(None if from_index else df, queries, 5, held=stored if from_index else None)
    got = {}
    for r in ranked.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.score, 6)))
    want = {i: brute(docs, q) for i, q in enumerate(QUERIES)}
    assert got == {i: w for i, w in want.items() if w}
    assert {r.query_id: r.refused for r in gate.collect()} == {i: not w for i, w in want.items()}


def test_copies_tie_by_id(corpus):
    docs, df = corpus
    ids = [r.id for r in retrieve.search(df, docs[3][1], k=3, min_coverage=0.0).orderBy(F.desc("score"), "id").collect()]
    assert ids == [3, 60, 61]


def test_weak_top_hit_is_refused(spark):
    df = spark.createDataFrame([(i, "common") for i in range(50)], "id long, text string")
    assert retrieve.search(df, "common").count() == 0


def test_index_tables(spark):
    df = spark.createDataFrame([(1, "soul soul faith"), (2, "faith"), (3, "the")], "id long, text string")
    analyzed = index.analyze(df)
    assert index.corpus_stats(analyzed).first().asDict() == {"n": 3, "avgdl": pytest.approx(4 / 3)}
    assert {(r.term, r.df) for r in index.doc_frequency(index.term_frequency(analyzed)).collect()} == {("soul", 1), ("faith", 2)}
    assert index.corpus_stats(analyzed.filter("id < 0")).first().avgdl == 0.0


@pytest.mark.parametrize("block", [2048, 3])
def test_cosine_matches_brute_force(spark, block):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(80, 16)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[40] = v[7]
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vector array<float>").repartition(4)
    queries = spark.createDataFrame([(i, (v[i] * 3).tolist()) for i in range(0, 80, 8)] + [(7, v[7].tolist())], "query_id long, vector array<float>")
    got = {}
    for r in retrieve.semantic_search_batch(vectors, queries, 4, floor=0.2, block=block).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    for q in [*range(0, 80, 8), 7]:
        sims = np.round(v.astype(float) @ v[q].astype(float), 12)
        want = [i for i in sorted(range(80), key=lambda i: (-sims[i], i))[:4] if sims[i] >= 0.2]
        assert got[q] == want
    one = retrieve.semantic_search(vectors, v[7].tolist(), 3).collect()
    assert [r.id for r in one][:2] == [7, 40]


def test_eval(spark):
    ranked = spark.createDataFrame([(1, 1, 10, 2.0), (2, 1, 11, 2.0)], "query_id long, rank int, id long, score double")
    gate = spark.createDataFrame([(1, False), (2, False), (3, True), (4, False)], "query_id long, refused boolean")
    accepted = spark.createDataFrame([(1, 10), (2, 99)], "query_id long, id long")
    row = retrieve.eval_hit_at_k(ranked, gate, accepted).first()
    assert (row.answerable, row.hits, row.refused, row.leaked, row.hit_rate) == (2, 1, 1, 1, 0.5)


def test_dispatch():
    assert retrieve.search_dispatch(True, True) == "semantic"
    assert retrieve.search_dispatch(True, False) == "lexical"
    assert retrieve.search_dispatch(True, True, prefer_semantic=False) == "lexical"


def test_blocks_that_cannot_win_are_left_out(spark, monkeypatch):
    """Same rows as scoring everything, from fewer pairs of questions and blocks."""
    from lectern.operators import blockmax

    rng = random.Random(8)
    rows = [(i // 16, f"t{(i // 64) * 5 + rng.randrange(6)}", i, rng.random()) for i in range(1600) for _ in range(4)]
    rows = [(b, t, i, w) for (b, t, i), w in {(b, t, i): w for b, t, i, w in rows}.items()]
    blocks = blockmax.settle(blockmax.posting_blocks(spark.createDataFrame(rows, "block long, term string, id long, w double")))
    asked = [(q, f"t{q * 3 + j}", rng.random() + 0.1) for q in range(40) for j in range(5)]
    weights = blockmax.settle(spark.createDataFrame(asked, "query_id int, term string, idf double"))
    scored = []
    real = blockmax.score_blocks
    monkeypatch.setattr(blockmax, "score_blocks", lambda b, pairs, *rest: scored.append(pairs.count()) or real(b, pairs, *rest))
    got = {}
    for r in blockmax.topk_blocks(blocks, weights, 3, first=1, questions=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, round(r.score, 9)))
    idf = {}
    for q, t, x in asked:
        idf.setdefault(q, {})[t] = x
    for q, terms in idf.items():
        total = {}
        for _, t, i, w in rows:
            if t in terms:
                total[i] = total.get(i, 0) + round(terms[t] * w, 12)
        best = sorted(total, key=lambda i: (-total[i], i))[:3]
        assert got.get(q, []) == [(i, round(total[i], 9)) for i in best]
    assert sum(scored) < 0.7 * blockmax.bounds(blocks, weights).count()


def test_clusters_that_cannot_win_are_left_out(spark, monkeypatch):
    from lectern.operators import pivots

    rng = np.random.default_rng(12)
    centers = rng.normal(size=(25, 12))
    v = np.repeat(centers, 40, axis=0) + 0.05 * rng.normal(size=(1000, 12))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[11] = v[10]
    vectors = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(3)
    queries = spark.createDataFrame([(i, (2 * v[i]).tolist()) for i in range(0, 1000, 10)], "query_id long, vector array<double>")
    met = []
    real = pivots._scored
    monkeypatch.setattr(pivots, "_scored", lambda b, pairs, *rest: met.append(pairs.count()) or real(b, pairs, *rest))
    got = {}
    for r in pivots.topk_vectors(vectors, queries, 5, 0.3, block=16, per_group=30).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    for q in range(0, 1000, 10):
        s = np.round(v @ v[q], 13)
        assert got[q] == [i for i in sorted(range(1000), key=lambda i: (-s[i], i))[:5] if s[i] >= 0.3]
    blocks = pivots.cluster(vectors, 16)[1].count()
    assert sum(met) < 0.4 * 100 * blocks


def test_an_index_stores_what_is_asked_of_it(spark, tmp_path, monkeypatch):
    """Documents are tokenized after they are ranged, and either kind of postings is stored alone."""
    docs = spark.createDataFrame([(i, f"grace and nature {'virtue ' * (i % 3)} w{i}") for i in range(60)], "id int, text string")
    seen, ranged = [], blockmax.with_blocks
    monkeypatch.setattr(blockmax, "with_blocks", lambda df: seen.append(df.columns) or ranged(df))
    index.write_index(docs, str(tmp_path / "all"))
    assert seen == [["id", "text"]]
    whole = index.read_index(spark, str(tmp_path / "all"))
    flat = lambda df: sorted(map(str, df.collect()))
    for kind, other in (("postings", "blocks"), ("blocks", "postings")):
        index.write_index(docs, str(tmp_path / kind), stored=(kind,))
        assert {p.name for p in (tmp_path / kind).iterdir()} == {"terms", "stats", kind}
        held = index.read_index(spark, str(tmp_path / kind), (kind,))
        assert getattr(held, other) is None
        assert all(flat(getattr(held, n)) == flat(getattr(whole, n)) for n in ("terms", "stats", kind))


def test_terms_counted_in_batches_are_those_counted_in_rows(spark, monkeypatch):
    """Odd texts, and pieces that end at any text."""
    texts = ["Soul soul, FAITH the a b", None, "", "é souléKlm İx ß9 x9 y9", "the and of", "w1 w1 w22 w1x", "end", "ends here", "?!", "10 1 100 10"]
    rows = [(None if i == 7 else i % 8, t) for i, t in enumerate(texts * 3)] + [(99, "grace " * 3000 + "nature")]
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    analyzed = index.analyze(docs)
    sentinels = analyzed.select("id", "dl", F.lit(index.SENTINEL).alias("term"), F.col("dl").alias("f"))
    flat = lambda df: sorted(map(str, df.select("id", "dl", "term", "f").collect()))
    want = flat(index.term_frequency(analyzed).unionByName(sentinels))
    for piece in (1 << 21, 20, 1):
        monkeypatch.setattr(index, "PIECE", piece)
        assert flat(index.counted(docs)) == want
    for few in ([], [(1, None)], [(1, ""), (2, "?")]):
        assert [tuple(r) for r in index.counted(spark.createDataFrame(few, "id long, text string")).orderBy("id").collect()] == [(i, None if t is None else 0, "", None if t is None else 0) for i, t in few]


def _planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_that_no_question_asks_for_are_not_shuffled(spark, corpus, monkeypatch):
    plans = {}
    real = retrieve.settle
    monkeypatch.setattr(retrieve, "settle", lambda df, label="table": plans.setdefault(label, _planned(df)) and None or real(df, label))
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, query string")
    retrieve.search_batch(corpus[1].coalesce(2), queries, 5)
    assert "BroadcastHashJoin" in plans["hits"] and "SortMergeJoin" not in plans["hits"]
    assert "hashpartitioning(term" not in plans["hits"]


def test_postings_are_dealt_by_block_and_put_together_there(spark):
    rng = random.Random(4)
    rows = [(b, f"t{rng.randrange(9)}", rng.choice([None, *range(12)]), rng.random()) for b in (0, 3, 7) for _ in range(80)]
    found = blockmax.posting_blocks(spark.createDataFrame(rows, "block long, term string, id long, w double").repartition(4))
    plan = _planned(found)
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(block" in plan and "collect_list" not in plan
    want = {}
    for b, t, i, w in rows:
        want.setdefault((b, t), []).append((math.inf if i is None else i, w))
    got = {(r.block, r.term): (r.most, [math.inf if i is None else i for i in r.ids], r.ws) for r in found.collect()}
    assert got == {k: (max(w for _, w in v), [i for i, _ in sorted(v)], [w for _, w in sorted(v)]) for k, v in want.items()}
