"""Retrieval: BM25 with a coverage gate, cosine top-k with a floor, evaluation."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import canon
from ..functions.text import term_counts, tokenize
from ..functions.vectors import dot_with
from ..session import settle
from . import blockmax, pivots
from .index import SENTINEL, Index, counted, term_saturation


def term_idf(df, n) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def bm25_term(f, dl, df, n, avgdl) -> Column:
    return term_idf(df, n) * term_saturation(f, dl, avgdl)


def exact_sum(part: Column) -> Column:
    """Sum of decimals, so the order rows arrive in cannot change a score.

    Copies of a text get equal scores and their tie is settled by id, also when a lost
    task is run again.
    """
    return F.sum(part.cast("decimal(28,12)")).cast("double")


# --- one query -------------------------------------------------------------------


def question_terms(query: str) -> list[str]:
    """A question's different index terms, in order."""
    stop = set(canon.STOPWORDS)
    return list(dict.fromkeys(t for t in re.findall("[a-z0-9]+", query.lower()) if t not in stop and len(t) > 1))


def _gated(scored: DataFrame, k: int, min_score: float) -> DataFrame:
    """The best ``k`` rows, or none of them if the best score is too low.

    Scores are tested only after the limit: a filter on a computed column would be pushed
    down to the scan and score every text twice. At most k rows remain here.
    """
    best = scored.orderBy(F.desc("score"), "id").limit(k)
    top = F.max("score").over(Window.partitionBy(F.lit(1)))
    return best.withColumn("top", top).filter((F.col("top") >= min_score) & (F.col("score") > 0)).drop("top")


def search(
    docs: DataFrame,
    query: str,
    k: int = 5,
    id_col: str = "id",
    text: Column | str = "text",
    keep: tuple[str, ...] = (),
    min_coverage: float = canon.MIN_COVERAGE,
    min_score: float = canon.MIN_SCORE,
) -> DataFrame:
    """Best ``k`` documents for one question, or no row when it is refused.

    For a table that has no stored index; ``search_index`` reads only the asked terms.
    Every document is scored inside its own row, so nothing but ``k`` rows per task moves.
    Counts come from a scalar subquery over the same scan, one map with an entry for each
    of the question's terms, so the plan is the same for any question. Ties go to the
    lower id, which stands for the reading order.
    """
    text = F.col(text) if isinstance(text, str) else text
    terms = question_terms(query)
    if not terms:
        empty = docs.select(F.col(id_col).alias("id"), *keep, F.lit(0.0).alias("score"))
        return empty.filter(F.lit(False))
    tokens = docs.select(F.col(id_col).alias("id"), *keep, tokenize(text).alias("tokens"))
    counted = tokens.select(
        "id", *keep, F.size("tokens").cast("double").alias("dl"),
        term_counts(F.filter("tokens", lambda t: t.isin(terms))).alias("hits"),
    )
    # The empty term stands for the document itself.
    each_term = counted.select("dl", F.explode(F.concat(F.array(F.lit(SENTINEL)), F.transform("hits", lambda h: h["term"]))).alias("term"))
    by_term = each_term.groupBy("term").agg(F.count("*").cast("double").alias("df"), F.sum("dl").alias("words"))
    held = F.map_from_entries(F.collect_list(F.struct("term", F.struct("df", "words"))))
    met = counted.withColumn("totals", by_term.agg(held.alias("totals")).scalar())
    df = lambda term: F.element_at("totals", term)["df"]
    n, words = df(F.lit(SENTINEL)), F.element_at("totals", F.lit(SENTINEL))["words"]
    known = F.size(F.map_keys("totals")) - 1
    score = F.aggregate(
        "hits", F.lit(0.0), lambda sum_, h: sum_ + bm25_term(h["f"], F.col("dl"), df(h["term"]), n, words / n)
    )
    enough = known / F.lit(len(terms)) >= min_coverage
    return _gated(met.filter(enough).select("id", *keep, score.alias("score")), k, min_score)


# --- one query, stored index -------------------------------------------------------


def search_index(
    held: Index, query: str, k: int = 5, min_coverage: float = canon.MIN_COVERAGE, min_score: float = canon.MIN_SCORE
) -> DataFrame:
    """``(id, score)`` of the best ``k`` documents out of a stored index.

    The postings are sorted by term, so the filter on the asked terms reaches the scan and
    skips the rest. Scores of a document are partly added before they are shuffled.
    """
    terms = question_terms(query)
    asked = F.col("term").isin(terms) if terms else F.lit(False)
    stats = held.stats.select(F.struct(F.col("n").cast("double").alias("n"), "avgdl").alias("s")).scalar()
    weights = held.terms.filter(asked).select("term", term_idf(F.col("df"), stats["n"]).alias("idf"))
    known = held.terms.filter(asked).agg(F.count("*").alias("known")).scalar()
    postings = held.postings.filter(asked & (known / F.lit(max(1, len(terms))) >= min_coverage))
    part = F.col("idf") * term_saturation(F.col("f"), F.col("dl"), stats["avgdl"])
    # As many weights as the question has terms.
    scores = postings.join(F.broadcast(weights), "term").groupBy("id").agg(exact_sum(part).alias("score"))
    return _gated(scores, k, min_score)


# --- many queries ----------------------------------------------------------------


def query_terms(queries: DataFrame, text: str = "query") -> DataFrame:
    """``(query_id, term)``, distinct terms per query."""
    return queries.select("query_id", F.explode(F.array_distinct(tokenize(F.col(text)))).alias("term"))


def query_hits(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the queries' vocabulary plus one sentinel row per document.

    ``counts`` as of ``index.counted``, out of one pass over the text; what later steps
    read is this much smaller table. The sentinel (empty term, f = dl) carries document
    count and lengths along. The vocabulary is a written table: while it is small by its
    size the other postings go where they are made, and none is shuffled or sorted.
    """
    sentinel = terms.sparkSession.range(1).select(F.lit(SENTINEL).alias("term"))
    vocabulary = settle(terms.select("term").unionByName(sentinel).distinct(), "vocabulary")
    return settle(counts.select("id", "dl", "term", "f").join(vocabulary, "term", "left_semi"), "hits")


def hit_stats(hits: DataFrame) -> DataFrame:
    docs = hits.filter(F.col("term") == SENTINEL)
    return docs.agg(F.count("*").cast("double").alias("n"), F.avg(F.col("dl").cast("double")).alias("avgdl"))


def hit_df(hits: DataFrame) -> DataFrame:
    return hits.filter(F.col("term") != SENTINEL).groupBy("term").agg(F.count("*").alias("df"))


def query_coverage(queries: DataFrame, terms: DataFrame, df: DataFrame) -> DataFrame:
    """``(query_id, coverage)``: share of a query's terms the corpus holds, 0 if none."""
    known = terms.join(df, "term", "left").groupBy("query_id")
    shares = known.agg(F.avg(F.col("df").isNotNull().cast("double")).alias("coverage"))
    return queries.select("query_id").join(shares, "query_id", "left").fillna(0.0, ["coverage"])


def query_weights(terms: DataFrame, df: DataFrame, stats: DataFrame) -> DataFrame:
    """``(query_id, term, idf)`` of the terms the corpus holds, written once."""
    n = stats.select("n").scalar()
    return settle(terms.join(df, "term").select("query_id", "term", term_idf(F.col("df"), n).alias("idf")), "weights")


def hit_blocks(hits: DataFrame, stats: DataFrame) -> DataFrame:
    """The postings of ``hits`` in blocks of documents with their largest saturations, written once."""
    avgdl, documents = stats.select("avgdl").scalar(), int(stats.first()["n"])
    w = term_saturation(F.col("f"), F.col("dl"), avgdl).alias("w")
    block = blockmax.hashed_block(F.col("id"), documents).alias("block")
    return settle(blockmax.posting_blocks(hits.filter(F.col("term") != SENTINEL).select(block, "term", "id", w)), "posting-blocks")


def lexical_scores(hits: DataFrame, terms: DataFrame, df: DataFrame, stats: DataFrame) -> DataFrame:
    """``(query_id, id, score)`` for every query and document that share a term.

    Blocks of documents meet blocks of queries; a task adds up all terms of its pairs, so
    what is shuffled is the postings and the queries, and never a row for a pair.
    """
    blocks, weights = hit_blocks(hits, stats), query_weights(terms, df, stats)
    pairs = blocks.select("block", "term").join(weights.select("query_id", "term"), "term").select("query_id", "block").distinct()
    return blockmax.score_blocks(blocks, settle(pairs, "pairs"), weights)


def lexical_topk(hits: DataFrame, terms: DataFrame, df: DataFrame, stats: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, id, score)`` of the ``k`` best, by bounds of blocks."""
    return blockmax.topk_blocks(hit_blocks(hits, stats), query_weights(terms, df, stats), k)


def topk(scores: DataFrame, k: int, order: str = "score", tie: str = "id") -> DataFrame:
    """Best ``k`` rows per query; the rank filter prunes inside each task first."""
    w = Window.partitionBy("query_id").orderBy(F.desc(order), tie)
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search_batch(
    docs: DataFrame | None,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "id",
    text: Column | str = "text",
    min_coverage: float = canon.MIN_COVERAGE,
    min_score: float = canon.MIN_SCORE,
    held: Index | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(ranked, gate)`` for a table of ``(query_id, query)``.

    ``ranked`` is ``(query_id, rank, id, score)``; ``gate`` has one row per query with
    its coverage, top score and refusal, so a refused query is still visible. With a
    stored index ``held`` no text is read: its blocks meet the asked terms, and only those
    that can hold one of a query's best ``k``.
    """
    terms = settle(query_terms(queries), "terms")
    if held is None:
        hits = query_hits(counted(docs, text, id_col), terms)
        df, stats = settle(hit_df(hits), "df"), settle(hit_stats(hits), "stats")
    else:
        df, stats = held.terms, held.stats.select(F.col("n").cast("double").alias("n"), "avgdl")
    coverage = settle(query_coverage(queries, terms, df), "coverage")
    open_terms = terms.join(coverage.filter(F.col("coverage") >= min_coverage), "query_id", "left_semi")
    if held is None:
        best = lexical_topk(hits, open_terms, df, stats, k)
    else:
        best = blockmax.topk_blocks(held.blocks, query_weights(open_terms, df, stats), k)
    best = settle(best, "ranked")
    tops = best.groupBy("query_id").agg(F.max("score").alias("top_score"))
    gate = coverage.join(tops, "query_id", "left").withColumn(
        "refused", (F.col("coverage") < min_coverage) | (F.coalesce("top_score", F.lit(0.0)) < min_score)
    )
    allowed = gate.filter(~F.col("refused"))
    ranked = best.filter(F.col("score") > 0).join(allowed, "query_id", "left_semi")
    return ranked, gate


def eval_hit_at_k(ranked: DataFrame, gate: DataFrame, accepted: DataFrame) -> DataFrame:
    """One row: answerable queries, those hit, the rate, refusals, leaks.

    ``accepted`` is ``(query_id, id)``; a query without an accepted document counts as
    out of domain and must be refused.
    """
    found = ranked.join(accepted, ["query_id", "id"], "left_semi").select("query_id").distinct()
    answerable = accepted.select("query_id").distinct().withColumn("answerable", F.lit(True))
    marked = (
        gate.join(answerable, "query_id", "left")
        .join(found.withColumn("hit", F.lit(True)), "query_id", "left")
        .select("refused", F.coalesce("answerable", F.lit(False)).alias("a"), F.coalesce("hit", F.lit(False)).alias("h"))
    )
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    out = marked.agg(
        count(F.col("a")).alias("answerable"),
        count(F.col("a") & F.col("h")).alias("hits"),
        count(~F.col("a") & F.col("refused")).alias("refused"),
        count(~F.col("a") & ~F.col("refused")).alias("leaked"),
    )
    return out.withColumn(
        "hit_rate", F.round(F.when(F.col("answerable") > 0, F.col("hits") / F.col("answerable")).otherwise(0.0), 4)
    )


# --- vectors ---------------------------------------------------------------------


def semantic_search(
    vectors: DataFrame, query: list[float], k: int = 5, id_col: str = "id", vector: str = "vector",
    floor: float = canon.COSINE_FLOOR,
) -> DataFrame:
    """Best ``k`` unit vectors for one query vector, none below ``floor``."""
    length = math.sqrt(sum(x * x for x in query)) or 1.0
    unit = [x / length for x in query]
    scored = vectors.select(F.col(id_col).alias("id"), dot_with(F.col(vector), unit).alias("score"))
    return scored.orderBy(F.desc("score"), "id").limit(k).filter(F.col("score") >= floor)


def semantic_search_batch(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "id", vector: str = "vector",
    floor: float = canon.COSINE_FLOOR, block: int = pivots.BLOCK,
) -> DataFrame:
    """``(query_id, rank, id, score)`` for a table of ``(query_id, vector)``.

    Vectors stand in blocks around pivots; a query meets the blocks in which one of its
    ``k`` best may be. Neither side passes through the driver, and both are of bounded
    size in a task. Rows without a vector take no part.
    """
    held = vectors.filter(F.col(vector).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector).alias("v"))
    return pivots.topk_vectors(held, queries.filter(F.col("vector").isNotNull()), k, floor, block)


def search_dispatch(have_vectors: bool, have_embedder: bool, prefer_semantic: bool = True) -> str:
    """Which retrieval answers: vectors when both parts are there, else keywords."""
    return "semantic" if prefer_semantic and have_vectors and have_embedder else "lexical"
