"""Entry-point operators: each answers a table of requests with rows.

Requests come as ``(request_id, ...)``. Answers stay long (one row per verse, citer or
fragment), so a verse cited by a third of the corpus is many rows and no giant string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import each
from ..functions.refs import citation_to_id, first_key, gospel_spans, normalize_ref, typed_citation_to_id, verse_number
from ..operators.align import date_asof_forward, gospel_verses, lookup_verses
from ..session import settle

ANSWER = ["request_id", "section", "ord", "ref", "citation", "title", "text"]


def none() -> Column:
    return F.lit(None).cast("string")


def _rows(df: DataFrame, section: str, ord: Column, ref: Column, citation, title, text) -> DataFrame:
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(
        "request_id", F.lit(section).alias("section"), ord.cast("string").alias("ord"), ref.alias("ref"),
        as_col(citation).alias("citation"), as_col(title).alias("title"), as_col(text).alias("text"),
    )


def with_refusals(requests: DataFrame, answers: DataFrame, reason: Column, met: DataFrame | None = None, **shown: Column) -> DataFrame:
    """The answers and, for each request that has none, one row that says why.

    ``reason`` and ``shown`` are columns over the requests; they fill columns of the
    answers, all others stay empty. The answers are written once, as they are read twice,
    unless ``met (request_id)`` tells the requests that have some.
    """
    held = settle(answers, "answers") if met is None else answers
    silent = requests.join((held if met is None else met).select("request_id").distinct(), "request_id", "left_anti")
    cells = {"request_id": F.col("request_id"), **shown}
    filled = {c: cells.get(c, F.lit(None)).cast(held.schema[c].dataType).alias(c) for c in held.columns}
    said = silent.select(*filled.values(), reason.alias("reason"))
    return held.withColumn("reason", none()).unionByName(said)


def _refuse_reference(requests: DataFrame, answers: DataFrame, missing: str, met: DataFrame | None = None) -> DataFrame:
    read = requests.withColumn("norm", normalize_ref(F.col("reference")))
    reason = F.when(F.col("norm").isNull(), "unreadable reference").otherwise(missing)
    return with_refusals(read, answers, reason, met, section=F.lit("refused"), ord=F.lit(""), ref=F.col("norm.ref"))


def resolve_article(requests: DataFrame, meta: DataFrame, col: str = "citation") -> DataFrame:
    """Requests with ``article_id``: an exact citation, else the id its text spells."""
    exact = meta.select(F.col("citation").alias(col), F.col("id").alias("_exact"))
    joined = requests.join(exact, col, "left")
    return joined.withColumn("article_id", F.coalesce("_exact", citation_to_id(F.col(col)))).drop("_exact")


def get_article(requests: DataFrame, nodes: DataFrame) -> DataFrame:
    """The whole article per request; ``refused`` where there is none."""
    return articles_of(resolve_article(requests, nodes.select("id", "citation")), nodes)


def articles_of(resolved: DataFrame, nodes: DataFrame) -> DataFrame:
    """The whole article of each ``article_id``; ``refused`` where there is none."""
    held = nodes.select(F.col("id").alias("article_id"), F.col("citation").alias("found"), "title", "text")
    out = resolved.join(held, "article_id", "left")
    return out.select("request_id", "article_id", F.col("found").alias("citation"), "title", "text",
                      F.col("found").isNull().alias("refused"))


def lookup_verse(requests: DataFrame, verses: DataFrame, latin: DataFrame, index: DataFrame,
                 fathers: DataFrame) -> DataFrame:
    """Verse text with its Latin, the citing articles, and whether commentary exists.

    A range shows all its verses but the citers of its first verse only; a chapter
    shows the citers of the chapter. Commentary is keyed by verse.
    """
    asked = requests.withColumn("norm", normalize_ref(F.col("reference"))).filter(F.col("norm").isNotNull())
    # Written once: a small table of known size, so the Latin edition is not shuffled.
    text = lookup_verses(asked, verses.select("verse_key", "verse", "citation", "text"))
    text = settle(text.select("request_id", "norm", "verse_key", "verse", "citation", "text"), "verses")
    both = text.join(latin.select("verse_key", F.col("text").alias("latin")), "verse_key", "left")
    number = F.lpad(F.col("verse").cast("string"), 6, "0")
    shown = _rows(both, "verse", number, F.col("norm.ref"), "citation", F.coalesce("latin", F.lit("")), "text")
    keyed = asked.withColumn("key", first_key(F.col("norm")))
    citers = _rows(keyed.join(index, "key"), "citer", F.col("id"), F.col("norm.ref"), "citation", "title", none())
    noted = keyed.join(fathers.select("key").distinct(), "key", "left_semi")
    hints = _rows(noted, "commentary", F.lit(""), F.col("norm.ref"), none(), none(), none())
    return _refuse_reference(requests, shown.unionByName(citers).unionByName(hints), "no such verse is held")


def verse_pericopes(requests: DataFrame, fathers: DataFrame) -> DataFrame:
    """``(request_id, ref, id, first_key)``: pericopes on a verse, range or chapter.

    One row per pericope, at the first of the request's verses it comments on.
    """
    asked = requests.withColumn("norm", normalize_ref(F.col("reference"))).filter(F.col("norm").isNotNull())
    single = asked.filter(F.col("norm.verse_start").isNotNull()).select("request_id", "norm", F.col("norm.chapter_key").alias("chapter_key"))
    under = fathers.withColumn("chapter_key", F.substring_index("key", "/", 2))
    number = verse_number(F.col("key"))
    met = single.join(under, "chapter_key").filter(number.between(F.col("norm.verse_start"), F.col("norm.verse_end")))
    pos = (number - F.col("norm.verse_start")).cast("string")
    hits = met.select("request_id", F.col("norm.ref").alias("ref"), "id", F.lpad(pos, 9, "0").alias("first"))
    whole = asked.filter(F.col("norm.verse_start").isNull()).select(
        "request_id", F.col("norm.ref").alias("ref"), F.col("norm.chapter_key").alias("chapter_key")
    )
    chapter_hits = whole.join(under, "chapter_key").select("request_id", "ref", "id", F.col("key").alias("first"))
    every = hits.unionByName(chapter_hits)
    return every.groupBy("request_id", "ref", "id").agg(F.min("first").alias("first"))


def verse_fathers(requests: DataFrame, fathers: DataFrame, pericopes: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Lemma and commentary fragments per request, in chain order.

    ``asked`` is ``verse_pericopes`` of the requests, where that is written already.
    """
    # The chains asked for are few; whole pericopes meet them before they are unfolded.
    asked = asked or settle(verse_pericopes(requests, fathers), "chains")
    # A lemma and its fragments come out of one meeting, as parts of one list.
    part = lambda section, at, title, text: F.struct(
        F.lit(section).alias("section"), at.alias("at"), title.alias("title"), text.cast("string").alias("text"))
    said = F.transform(F.coalesce("segments", F.array()), lambda s, i: part("fragment", F.lpad(i.cast("string"), 6, "0"), s["father"], s["text"]))
    parts = F.concat(F.array(part("lemma", F.lit(""), none(), F.col("lemma"))), said)
    held = pericopes.select("id", "citation", parts.alias("parts")).join(asked, "id")
    each_part = held.select("request_id", "ref", "id", "first", "citation", F.explode("parts").alias("p"))
    order = F.concat_ws("|", F.col("first"), F.col("id"), F.col("p.at"))
    answers = each_part.select("request_id", "p.section", order.alias("ord"), "ref", "citation", "p.title", "p.text")
    # Every pericope met has a lemma, so who is answered is known without the answers.
    met = asked.select("request_id", "id").join(pericopes.select("id"), "id", "left_semi")
    return _refuse_reference(requests, answers, "no commentary is held on it", met)


def _refuse_article(resolved: DataFrame, held: DataFrame, answers: DataFrame, empty: str, **shown: Column) -> DataFrame:
    known = held.select(F.col("id").alias("article_id"), F.lit(True).alias("_held")).distinct()
    read = resolved.join(known, "article_id", "left")
    reason = F.when(F.col("_held"), empty).when(F.col("article_id").isNull(), "unreadable citation").otherwise("no such article is held")
    return with_refusals(read, answers, reason, article_id=F.col("article_id"), **shown)


def article_scripture(requests: DataFrame, meta: DataFrame, refs: DataFrame) -> DataFrame:
    """References an article rests on, one row each."""
    return scripture_of(resolve_article(requests, meta.select("id", "citation")), meta, refs)


def scripture_of(resolved: DataFrame, known: DataFrame, refs: DataFrame) -> DataFrame:
    """The references of each ``article_id``; ``known (id)`` says which articles are held."""
    held = refs.select(F.col("id").alias("article_id"), each("refs").alias("ref"))
    found = resolved.filter(F.col("article_id").isNotNull()).join(held, "article_id").select("request_id", "article_id", "ref")
    return _refuse_article(resolved, known, found, "no references in it")


def cross_references(requests: DataFrame, meta: DataFrame, edges: DataFrame) -> DataFrame:
    """Articles an article cites and those that cite it; ``edges`` carry both metas."""
    return references_of(resolve_article(requests, meta.select("id", "citation")), meta, edges, edges)


def references_of(resolved: DataFrame, known: DataFrame, cites: DataFrame, cited: DataFrame) -> DataFrame:
    """Edges from and to each ``article_id``; the two tables of edges may be different parts."""
    asked = resolved.filter(F.col("article_id").isNotNull()).select("request_id", "article_id")
    out = asked.join(cites.withColumnRenamed("src", "article_id"), "article_id").select(
        "request_id", "article_id", F.lit("cites").alias("direction"), F.col("dst").alias("other_id"),
        F.col("dst_citation").alias("other_citation"),
    )
    back = asked.join(cited.withColumnRenamed("dst", "article_id"), "article_id").select(
        "request_id", "article_id", F.lit("cited_by").alias("direction"), F.col("src").alias("other_id"),
        F.col("src_citation").alias("other_citation"),
    )
    return _refuse_article(resolved, known, out.unionByName(back), "no references to or from it", direction=F.lit("refused"))


def todays_reading(
    requests: DataFrame, readings: DataFrame, verses: DataFrame, fathers: DataFrame, chapters: DataFrame | None = None
) -> DataFrame:
    """Per asked date: the reading's verses and the pericopes on them.

    ``(asked, held, gospel, section, ord, key, text)``. ``chapters`` as for ``gospel_verses``.
    """
    matched = date_asof_forward(requests, readings).join(readings.withColumnRenamed("date", "held"), "held")
    parsed = matched.withColumn("g", gospel_spans(F.col("gospel"))).select(
        "asked", "held", "gospel", F.col("g.slug").alias("slug"), F.col("g.spans").alias("spans")
    )
    text = settle(gospel_verses(settle(parsed, "readings"), verses, chapters).drop("spans", "s"), "reading-verses")
    order = F.concat_ws("|", F.lpad(F.col("span_no").cast("string"), 4, "0"),
                        F.lpad(F.col("chapter").cast("string"), 4, "0"), F.lpad(F.col("verse").cast("string"), 6, "0"))
    shown = text.select("asked", "held", "gospel", F.lit("verse").alias("section"), order.alias("ord"),
                        F.col("verse_key").alias("key"), F.col("verse_text").alias("text"))
    on = text.select("asked", "held", "gospel", F.col("verse_key").alias("key"), order.alias("ord"))
    chains = on.join(fathers, "key").groupBy("asked", "held", "gospel", "id", "father_summary").agg(F.min("ord").alias("ord"))
    listed = chains.select("asked", "held", "gospel", F.lit("commentary").alias("section"), "ord",
                           F.col("id").alias("key"), F.col("father_summary").alias("text"))
    return shown.unionByName(listed)


def query_router(requests: DataFrame, meta: DataFrame, held_keys: DataFrame) -> DataFrame:
    """Route typed text: a known citation, a reference we hold, else a search.

    ``held_keys`` is ``(key)``: verse and chapter keys with text or citers.
    """
    typed = F.trim(F.col("request"))
    asked = requests.filter(typed != "").withColumn("article_id", typed_citation_to_id(typed)).withColumn(
        "norm", normalize_ref(typed)
    )
    plain = F.col("norm.verse_start").eqNullSafe(F.col("norm.verse_end"))
    asked = asked.withColumn("key", F.when(plain, first_key(F.col("norm"))))
    known = meta.select(F.col("id").alias("article_id")).distinct().withColumn("_a", F.lit(True))
    held = held_keys.select("key").distinct().withColumn("_k", F.lit(True))
    out = asked.join(known, "article_id", "left").join(held, "key", "left")
    route = F.when(F.col("_a"), "article").when(F.col("_k"), "verse").otherwise("search")
    target = F.when(F.col("_a"), F.col("article_id")).when(F.col("_k"), F.col("key")).otherwise(typed)
    return out.select("request_id", route.alias("route"), target.alias("target"))
