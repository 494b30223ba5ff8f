"""Queries over the entry-point operators, asked with tables of requests.

The tools answer out of a shelf: each of its tables is stored once per session and folder,
by the first query that reads it, and every request after that is a lookup.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import shelf
from .oracle import with_
from .registry import query

_SHELVES: dict[tuple[str, str], shelf.Shelf] = {}


def _shelf(t) -> shelf.Shelf:
    name = (t.spark.sparkContext.applicationId, t.folder)
    if name not in _SHELVES:
        held = shelf.sources(t.articles, t.english, t.latin, t.pericopes, "noted_text")
        _SHELVES[name] = shelf.Shelf(t.spark, sources=held)
    return _SHELVES[name]


@query(
    "get_article",
    with_("citr", "art") + "SELECT request_id, article_id, art.citation, title, text, art.citation IS NULL AS refused FROM citr LEFT JOIN art ON art.id = article_id",
)
def get_article(t):
    return _shelf(t).get_article(t.citation_requests)


def _refusals(missing: str) -> str:
    """Answers of ``ans`` and a row for every request without one."""
    return f""" SELECT *, NULL AS reason FROM ans UNION ALL SELECT request_id, 'refused', '', CASE WHEN ok THEN ref END, NULL, NULL, NULL,
      CASE WHEN ok THEN '{missing}' ELSE 'unreadable reference' END FROM refn WHERE request_id NOT IN (SELECT request_id FROM ans)"""


_TEXT = """SELECT request_id, 'verse' AS section, lpad('' || e.verse, 6, '0') AS ord, ref, e.citation, coalesce(l.text, '') AS title, e.text FROM refn r JOIN eng e
  ON ok AND r.slug = e.slug AND r.chapter = e.chapter AND (v1 IS NULL OR e.verse BETWEEN v1 AND v2) LEFT JOIN lat l USING (verse_key)"""


@query(
    "lookup_verse",
    with_("refn", "eng", "lat", "idx", "fidx")
    + ", ans AS (" + _TEXT
    + """ UNION ALL SELECT request_id, 'citer', id, r.ref, citation, title, NULL FROM refn r JOIN idx ON ok AND idx.key = verse_keys[1]
    UNION ALL SELECT request_id, 'commentary', '', ref, NULL, NULL, NULL FROM refn WHERE ok AND verse_keys[1] IN (SELECT key FROM fidx))"""
    + _refusals("no such verse is held"),
)
def lookup_verse(t):
    return _shelf(t).lookup_verse(t.references)


@query(
    "verse_fathers",
    with_("refn", "fidx", "per", "frag")
    + """, k AS (SELECT request_id, ref, unnest(verse_keys) AS key, lpad('' || (generate_subscripts(verse_keys, 1) - 1), 9, '0') AS o FROM refn WHERE ok AND v1 IS NOT NULL
      UNION ALL SELECT request_id, ref, f.key, f.key FROM refn JOIN (SELECT DISTINCT key FROM fidx) f ON ok AND v1 IS NULL AND starts_with(f.key, chapter_key || '/')),
    p AS (SELECT request_id, ref, id, min(o) AS o FROM k JOIN fidx USING (key) GROUP BY 1, 2, 3),
    ans AS (SELECT request_id, 'fragment' AS section, o || '|' || p.id || '|' || lpad('' || i, 6, '0') AS ord, ref, per.citation, father AS title, frag.text
    FROM p JOIN per ON per.id = p.id JOIN frag USING (doc_id)
    UNION ALL SELECT request_id, 'lemma', o || '|' || p.id || '|', ref, per.citation, NULL, string_split(documents.text, chr(10))[1]
    FROM p JOIN per ON per.id = p.id JOIN documents USING (doc_id))"""
    + _refusals("no commentary is held on it"),
)
def verse_fathers(t):
    return _shelf(t).verse_fathers(t.references)


_NO_ARTICLE = """CASE WHEN article_id IN (SELECT id FROM art) THEN '{}' WHEN article_id IS NULL THEN 'unreadable citation' ELSE 'no such article is held' END
    FROM citr WHERE request_id NOT IN (SELECT request_id FROM ans)"""


@query(
    "article_scripture",
    with_("citr", "scr", "art")
    + """, ans AS (SELECT DISTINCT request_id, article_id, ref FROM citr JOIN scr ON scr.id = article_id WHERE ok)
    SELECT *, NULL AS reason FROM ans UNION ALL SELECT request_id, article_id, NULL, """ + _NO_ARTICLE.format("no references in it"),
)
def article_scripture(t):
    return _shelf(t).article_scripture(t.citation_requests)


@query(
    "cross_references",
    with_("citr", "res", "art")
    + """, ans AS (SELECT request_id, article_id, 'cites' AS direction, dst AS other_id, art.citation AS other_citation FROM citr JOIN res ON src = article_id JOIN art ON art.id = dst
    UNION ALL SELECT request_id, article_id, 'cited_by', src, art.citation FROM citr JOIN res ON dst = article_id JOIN art ON art.id = src)
    SELECT *, NULL AS reason FROM ans UNION ALL SELECT request_id, article_id, 'refused', NULL, NULL, """ + _NO_ARTICLE.format("no references to or from it"),
)
def cross_references(t):
    return _shelf(t).cross_references(t.citation_requests)


@query(
    "todays_reading",
    with_("read", "alias", "eng", "fidx")
    + r""", a AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS asked FROM lineitem),
    m AS (SELECT asked, coalesce((SELECT min(date) FROM read WHERE date >= asked), (SELECT max(date) FROM read)) AS held FROM a),
    p AS (SELECT date AS held, gospel, slug, CAST(regexp_extract(gospel, ' ([0-9]+):', 1) AS INT) AS ch, unnest(string_split(regexp_extract(gospel, ':(.*)$', 1), ',')) AS item,
            generate_subscripts(string_split(regexp_extract(gospel, ':(.*)$', 1), ','), 1) - 1 AS k FROM read JOIN alias ON alias = lower(split_part(gospel, ' ', 1))),
    g AS (SELECT *, regexp_extract(item, '^([0-9]+)(?:-(?:([0-9]+):)?([0-9]+))?$', ['a', 'c', 'z']) AS x FROM p),
    s AS (SELECT held, gospel, slug, k, ch AS c1, CAST(x.a AS INT) AS v1, coalesce(TRY_CAST(x.c AS INT), ch) AS c2, coalesce(TRY_CAST(x.z AS INT), CAST(x.a AS INT)) AS v2 FROM g),
    v AS (SELECT held, gospel, verse_key, text, lpad('' || k, 4, '0') || '|' || lpad('' || e.chapter, 4, '0') || '|' || lpad('' || e.verse, 6, '0') AS ord FROM s JOIN eng e ON e.slug = s.slug AND e.chapter BETWEEN c1 AND c2
          AND (e.chapter > c1 OR e.verse >= v1) AND (e.chapter < c2 OR e.verse <= v2)),
    w AS (SELECT asked, held, gospel, 'verse' AS section, ord, verse_key AS key, text FROM m JOIN v USING (held)
      UNION ALL SELECT asked, held, gospel, 'commentary', min(ord), id, father_summary FROM m JOIN v USING (held) JOIN fidx ON fidx.key = verse_key GROUP BY asked, held, gospel, id, father_summary)
    SELECT CAST(asked AS VARCHAR) AS asked, CAST(held AS VARCHAR) AS held, gospel, section, ord, key, text FROM w""",
)
def todays_reading(t):
    asked = t.lineitem.select(F.to_date("l_shipdate").alias("date"))
    found = _shelf(t).todays_reading(asked, t.readings)
    return found.withColumn("asked", F.col("asked").cast("string")).withColumn("held", F.col("held").cast("string"))
