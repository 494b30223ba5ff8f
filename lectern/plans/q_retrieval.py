"""Queries over the lexical and vector retrieval operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import index, retrieve
from ..session import new_path, settle
from .oracle import with_
from .registry import query

QUESTION = "the tion of erst and thre that ther onon"
FOREIGN_QUESTION = "how do I configure a kubernetes ingress controller"


def _analyzed(t):
    return index.analyze(t.documents, "text", "doc_id")


def _hits(t):
    terms = settle(retrieve.query_terms(t.questions), "terms")
    hits = retrieve.query_hits(index.counted(t.documents, "text", "doc_id"), terms)
    return terms, hits, settle(retrieve.hit_df(hits), "df")


def _open_terms(t, terms, df):
    coverage = retrieve.query_coverage(t.questions, terms, df)
    return terms.join(coverage.filter("coverage >= 0.8"), "query_id", "left_semi")


@query("term_frequency", with_("tf") + "SELECT id, term, f FROM tf")
def term_frequency(t):
    return index.term_frequency(_analyzed(t)).select("id", "term", "f")


@query("doc_frequency", with_("df") + "SELECT term, df FROM df")
def doc_frequency(t):
    return index.doc_frequency(index.term_frequency(_analyzed(t)))


@query("corpus_stats", with_("st") + "SELECT n, round(avgdl, 6) AS avgdl FROM st")
def corpus_stats(t):
    return index.corpus_stats(_analyzed(t)).withColumn("avgdl", F.round("avgdl", 6))


@query(
    "bm25_term",
    with_("df", "tf", "dl", "st")
    + """SELECT id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (f * 2.5) / (f + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS weight
    FROM tf JOIN df USING (term) JOIN dl USING (id), st GROUP BY 1""",
)
def bm25_term(t):
    analyzed = settle(_analyzed(t), "index")
    tf, stats = index.term_frequency(analyzed), index.corpus_stats(analyzed)
    n, avgdl = stats.select("n").scalar(), stats.select("avgdl").scalar()
    # A written table: while it is small by its size the postings stay where they are, and
    # a document's parts are added up before anything is shuffled.
    weighted = tf.join(settle(index.doc_frequency(tf), "df"), "term")
    part = retrieve.bm25_term(F.col("f"), F.col("dl"), F.col("df"), n, avgdl)
    return weighted.groupBy("id").agg(F.round(retrieve.exact_sum(part), 6).alias("weight"))


@query("lexical_score_join", with_("score") + "SELECT query_id, id, round(score, 6) AS score FROM score")
def lexical_score_join(t):
    terms, hits, df = _hits(t)
    scores = retrieve.lexical_scores(hits, _open_terms(t, terms, df), df, settle(retrieve.hit_stats(hits), "stats"))
    return scores.withColumn("score", F.round("score", 6))


@query(
    "topk_score",
    with_("score")
    + """SELECT query_id, CAST(rank AS INT) AS rank, id, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM score) WHERE rank <= 8""",
)
def topk_score(t):
    terms, hits, df = _hits(t)
    best = retrieve.lexical_topk(hits, _open_terms(t, terms, df), df, settle(retrieve.hit_stats(hits), "stats"), 8)
    return best.withColumn("score", F.round("score", 6))


@query("query_coverage", with_("cov") + "SELECT query_id, round(coverage, 6) AS coverage FROM cov")
def query_coverage(t):
    terms, _, df = _hits(t)
    return retrieve.query_coverage(t.questions, terms, df).withColumn("coverage", F.round("coverage", 6))


@query(
    "refusal_gate",
    with_("cov", "score")
    + """SELECT query_id, round(coverage, 6) AS coverage, round(top, 6) AS top_score, coverage < 0.8 OR coalesce(top, 0) < 0.5 AS refused
    FROM cov LEFT JOIN (SELECT query_id, max(score) AS top FROM score GROUP BY 1) USING (query_id)""",
)
def refusal_gate(t):
    _, gate = retrieve.search_batch(t.documents, t.questions, 5, "doc_id")
    return gate.select("query_id", F.round("coverage", 6).alias("coverage"), F.round("top_score", 6).alias("top_score"), "refused")


_ACCEPTED = """, acc AS (SELECT DISTINCT item_id * 2 AS query_id, doc_id AS id FROM
    (SELECT item_id, unnest(string_split(text, chr(10))) AS l FROM benchmark) JOIN (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) USING (l))"""


def _accepted(t, ranked):
    """Documents among the ranked that hold a whole line of the question's text.

    Questions that some document answers have a row without an id besides. Only lines that
    a question has are kept of the documents, each once, so a line that every document has
    is one row; and only ranked documents are looked into.
    """
    asked = t.benchmark.select((F.col("item_id") * 2).alias("query_id"), F.explode(F.split("text", "\n", -1)).alias("line"))
    asked = settle(asked.distinct(), "asked-lines")
    held = t.lines.select("line").join(settle(asked.select("line").distinct(), "line-list"), "line", "left_semi").distinct()
    answerable = asked.join(held, "line", "left_semi").select("query_id", F.lit(None).cast("long").alias("id"))
    few = settle(ranked.select("query_id", "id"), "ranked-pairs")
    lines = t.lines.select(F.col("doc_id").alias("id"), "line").join(few.select("id").distinct(), "id", "left_semi")
    found = few.join(lines, "id").join(asked, ["query_id", "line"], "left_semi").select("query_id", "id")
    return answerable.unionByName(found).distinct()


@query(
    "eval_hit_at_k",
    with_("top5", "cov")
    + _ACCEPTED
    + """, g AS (SELECT query_id, query_id IN (SELECT query_id FROM acc) AS a, query_id NOT IN (SELECT query_id FROM top5) AS refused,
        query_id IN (SELECT query_id FROM top5 JOIN acc USING (query_id, id)) AS h FROM cov)
    SELECT count(*) FILTER (WHERE a) AS answerable, count(*) FILTER (WHERE a AND h) AS hits, count(*) FILTER (WHERE NOT a AND refused) AS refused,
      count(*) FILTER (WHERE NOT a AND NOT refused) AS leaked, coalesce(round(count(*) FILTER (WHERE a AND h) / nullif(count(*) FILTER (WHERE a), 0), 4), 0.0) AS hit_rate FROM g""",
)
def eval_hit_at_k(t):
    ranked, gate = retrieve.search_batch(t.documents, t.questions, 5, "doc_id")
    return retrieve.eval_hit_at_k(ranked, gate, _accepted(t, ranked))


def _search_sql(text: str, k: int) -> str:
    from .oracle import tokens

    return (
        with_("tf", "df", "dl", "st")
        + f""", q AS (SELECT DISTINCT unnest({tokens("'" + text + "'")}) AS term),
    c AS (SELECT avg(CASE WHEN df.term IS NULL THEN 0.0 ELSE 1.0 END) AS coverage FROM q LEFT JOIN df USING (term)),
    s AS (SELECT id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (f * 2.5) / (f + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
      FROM q JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (id), st GROUP BY 1)
    SELECT id, source, lang, round(score, 6) AS score FROM s JOIN documents ON doc_id = id, c
    WHERE coverage >= 0.8 AND (SELECT max(score) FROM s) >= 0.5 AND score > 0 ORDER BY score DESC, id LIMIT {k}"""
    )


@query("search", _search_sql(QUESTION, 5))
def search(t):
    found = retrieve.search(t.documents, QUESTION, 5, "doc_id", "text", ("source", "lang"))
    return found.withColumn("score", F.round("score", 6))


@query("search_refused", _search_sql(FOREIGN_QUESTION, 5))
def search_refused(t):
    found = retrieve.search(t.documents, FOREIGN_QUESTION, 5, "doc_id", "text", ("source", "lang"))
    return found.withColumn("score", F.round("score", 6))


@query("search_batch", with_("top5") + "SELECT query_id, CAST(rank AS INT) AS rank, id, round(score, 6) AS score FROM top5")
def search_batch(t):
    ranked, _ = retrieve.search_batch(t.documents, t.questions, 5, "doc_id")
    return ranked.withColumn("score", F.round("score", 6))


def _stored(t, *stored):
    path = new_path(t.spark, "lexical-index")
    index.write_index(t.documents, path, "text", "doc_id", stored)
    return index.read_index(t.spark, path, stored)


@query("search_stored_index", _search_sql(QUESTION, 5).replace("SELECT id, source, lang, round", "SELECT id, round"))
def search_stored_index(t):
    """An index written, read back and asked."""
    return retrieve.search_index(_stored(t, "postings"), QUESTION, 5).withColumn("score", F.round("score", 6))


@query("search_batch_stored_index", with_("top5") + "SELECT query_id, CAST(rank AS INT) AS rank, id, round(score, 6) AS score FROM top5")
def search_batch_stored_index(t):
    ranked, _ = retrieve.search_batch(None, t.questions, 5, held=_stored(t, "blocks"))
    return ranked.withColumn("score", F.round("score", 6))


# --- vectors ---------------------------------------------------------------------

_DOT = "list_dot_product(CAST(q.v AS DOUBLE[]), CAST(e.embedding AS DOUBLE[]))"
_COSINE = f"({_DOT} / sqrt(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(q.v AS DOUBLE[]))))"
_LABEL_QUERY = "q AS (SELECT CAST(label AS BIGINT) AS query_id, arg_min(embedding, vec_id) AS v FROM embeddings GROUP BY label)"


def _first_vector(t):
    return t.embeddings.orderBy("vec_id").select("embedding").first()[0]


def _label_queries(t):
    return t.embeddings.groupBy(F.col("label").cast("long").alias("query_id")).agg(
        F.min_by("embedding", "vec_id").alias("vector")
    )


@query(
    "vector_score_join",
    f"SELECT vec_id, round({_DOT}, 6) AS score FROM embeddings e, (SELECT arg_min(embedding, vec_id) AS v FROM embeddings) q",
)
def vector_score_join(t):
    from ..functions.vectors import dot_with

    return t.embeddings.select("vec_id", F.round(dot_with(F.col("embedding"), _first_vector(t)), 6).alias("score"))


@query(
    "topk_cosine",
    f"""WITH {_LABEL_QUERY} SELECT query_id, CAST(rank AS INT) AS rank, id, round(score, 6) AS score FROM (
      SELECT query_id, vec_id AS id, {_COSINE} AS score, row_number() OVER (PARTITION BY query_id ORDER BY {_COSINE} DESC, vec_id) AS rank FROM embeddings e, q)
    WHERE rank <= 10 AND score >= 0.1""",
)
def topk_cosine(t):
    found = retrieve.semantic_search_batch(t.embeddings, _label_queries(t), 10, "vec_id", "embedding", 0.1)
    return found.withColumn("score", F.round("score", 6))


@query(
    "semantic_search",
    f"""SELECT id, round(score, 6) AS score FROM (SELECT vec_id AS id, {_COSINE} AS score FROM embeddings e,
      (SELECT arg_min(embedding, vec_id) AS v FROM embeddings) q ORDER BY 2 DESC, 1 LIMIT 5) WHERE score >= 0.40""",
)
def semantic_search(t):
    found = retrieve.semantic_search(t.embeddings, _first_vector(t), 5, "vec_id", "embedding")
    return found.withColumn("score", F.round("score", 6))


@query(
    "search_dispatch",
    f"""WITH {_LABEL_QUERY}, s AS (SELECT query_id, vec_id AS id, {_COSINE} AS score, row_number() OVER (PARTITION BY query_id ORDER BY {_COSINE} DESC, vec_id) AS rank FROM embeddings e, q)
    SELECT 'semantic' AS mode, query_id, id, round(score, 6) AS score FROM s WHERE rank <= 5 AND score >= 0.40""",
)
def search_dispatch(t):
    mode = retrieve.search_dispatch(have_vectors=not t.embeddings.isEmpty(), have_embedder=True)
    if mode == "semantic":
        found = retrieve.semantic_search_batch(t.embeddings, _label_queries(t), 5, "vec_id", "embedding")
    else:
        found, _ = retrieve.search_batch(t.documents, t.questions, 5, "doc_id")
    return found.select(F.lit(mode).alias("mode"), "query_id", "id", F.round("score", 6).alias("score"))
