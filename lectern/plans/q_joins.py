"""Queries over projections, lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import canon
from ..functions import refs, text
from ..functions.columns import each_at, let
from ..operators import align, graph, project
from ..session import settle
from . import corpus, oracle, tools
from .oracle import with_
from .registry import query

LICENSE_SQL = "CASE WHEN source = 'src3' THEN NULL ELSE 'cc-by' END"


def license_of():
    return F.when(F.col("source") == "src3", None).otherwise(F.lit("cc-by"))


def _cites(t):
    return graph.scripture_citations(t.articles)


# --- projections -----------------------------------------------------------------


@query(
    "project_article",
    with_("art") + f"SELECT id, citation, slug AS part, coalesce(title, '') AS title, text, 'summa-theologiae' AS work, coalesce({LICENSE_SQL}, 'public-domain') AS license FROM art",
)
def project_article(t):
    nodes = t.articles.withColumn("work", F.lit(None).cast("string")).withColumn("source", F.struct(license_of().alias("license")))
    return project.project_article(nodes)


@query(
    "project_verse",
    with_("eng", "lat")
    + """SELECT id, citation, book, chapter, verse, verse_key, text, 'public-domain' AS license, book AS book_printed, NULL AS lang FROM eng
    UNION ALL SELECT id, citation, book, chapter, verse, verse_key, text, 'public-domain', 'Liber ' || book, 'la' FROM lat""",
)
def project_verse(t):
    bare = F.struct(F.lit(None).cast("string").alias("license"))
    english = project.project_verse(t.english.withColumn("source", bare))
    latin = project.project_verse(t.latin.withColumn("source", bare), latin=True)
    return english.withColumn("lang", F.lit(None).cast("string")).unionByName(latin)


@query(
    "project_catechism",
    with_("art") + f"SELECT id, citation, CASE WHEN lang = 'en' THEN 'Part ' || lang ELSE '' END AS part, title, text, 'roman-catechism' AS work, coalesce({LICENSE_SQL}, 'public-domain') AS license FROM art",
)
def project_catechism(t):
    path = F.when(F.col("lang") == "en", F.array(F.lit("Work"), F.concat(F.lit("Part "), "lang"))).otherwise(F.array(F.lit("Work")))
    nodes = t.articles.withColumn("path", path).withColumn("work", F.lit(None).cast("string"))
    return project.project_catechism(nodes.withColumn("source", F.struct(license_of().alias("license"))))


@query(
    "project_pericope",
    with_("per", "fsum", "lin")
    + """SELECT id, citation, 'Gospel of ' || name AS gospel, (string_split(text, chr(10)))[1] AS lemma, replace(text, chr(10), chr(10) || chr(10)) AS text, coalesce(named, '') AS fathers,
      CAST(len(string_split(text, chr(10))) AS INT) AS n_fragments, array_to_string(keys, ' ') AS commented_verse_keys, 'public-domain' AS license FROM per JOIN fsum USING (doc_id)""",
)
def project_pericope(t):
    nodes = t.pericopes.withColumn("source", F.struct(F.lit(None).cast("string").alias("license")))
    return project.project_pericope(nodes).withColumn("commented_verse_keys", F.array_join("commented_verse_keys", " "))


# --- lookups ---------------------------------------------------------------------


@query("point_lookup", with_("art", "citq") + "SELECT request_id, id, title FROM citq JOIN art USING (citation)")
def point_lookup(t):
    return t.citation_requests.join(t.articles.select("citation", "id", "title"), "citation").select("request_id", "id", "title")


@query(
    "prefix_lookup",
    with_("refn", "idx") + "SELECT request_id, key, count(*) AS citers FROM refn JOIN idx ON ok AND starts_with(key, chapter_key || '/') GROUP BY 1, 2",
)
def prefix_lookup(t):
    asked = align.lookup_keys(t.references).filter(F.col("norm").isNotNull())
    asked = asked.select("request_id", F.col("norm.chapter_key").alias("chapter_key"))
    counts = graph.inverted_index(t.articles, ("id",)).groupBy("key").agg(F.count("*").alias("citers"))
    return align.prefix_lookup(asked, counts).select("request_id", "key", "citers")


@query(
    "range_lookup",
    with_("refn", "eng") + "SELECT request_id, e.verse_key, e.verse FROM refn r JOIN eng e ON ok AND v1 IS NOT NULL AND r.slug = e.slug AND r.chapter = e.chapter AND e.verse BETWEEN v1 AND v2",
)
def range_lookup(t):
    asked = align.lookup_keys(t.references).filter(F.col("norm.verse_start").isNotNull())
    spans = asked.select("request_id", F.col("norm.slug").alias("slug"), F.col("norm.chapter").alias("chapter"),
                         F.col("norm.verse_start").alias("first"), F.col("norm.verse_end").alias("last"))
    found = align.range_lookup(spans, t.english.select("slug", "chapter", "verse", "verse_key"))
    return found.select("request_id", "verse_key", "verse")


@query("default_enrich", with_("idx", "eng") + "SELECT key AS verse_key, coalesce(text, '') AS text FROM (SELECT DISTINCT key FROM idx WHERE len(string_split(key, '/')) = 3) LEFT JOIN eng ON verse_key = key")
def default_enrich(t):
    cited = graph.inverted_index(t.articles, ("id",)).filter(refs.is_verse_key(F.col("key")))
    keys = cited.select(F.col("key").alias("verse_key")).distinct()
    return align.default_enrich(keys, t.english, "verse_key", "text")


@query("citation_to_id", with_("citr") + "SELECT request_id, asked, article_id FROM citr")
def citation_to_id(t):
    found = tools.resolve_article(t.citation_requests, t.articles.select("id", "citation"))
    return found.select("request_id", F.col("citation").alias("asked"), "article_id")


@query(
    "query_router",
    with_("refn", "art", "eng", "idx", "citq")
    + r""", held AS (SELECT verse_key AS key FROM eng UNION SELECT key FROM idx),
    r AS (SELECT request_id, 'r' AS kind, reference AS said, CASE WHEN ok AND (v1 IS NULL OR v1 = v2) THEN verse_keys[1] END AS key, NULL AS aid FROM refn
      UNION ALL SELECT request_id, 'c', citation, NULL, CASE WHEN regexp_matches(citation, '(?i)^st ') THEN 'summa.st.' || lower(regexp_extract(citation, '(?i)^st (i-ii|ii-ii|iii|suppl|i)', 1)) || '.q' ||
        regexp_extract(citation, 'q\.([0-9]+)', 1) || '.a' || regexp_extract(citation, 'a\.([0-9]+)', 1) END FROM citq)
    SELECT request_id, kind, CASE WHEN aid IN (SELECT id FROM art) THEN 'article' WHEN key IN (SELECT key FROM held) THEN 'verse' ELSE 'search' END AS route,
      CASE WHEN aid IN (SELECT id FROM art) THEN aid WHEN key IN (SELECT key FROM held) THEN key ELSE said END AS target FROM r""",
)
def query_router(t):
    held = t.english.select(F.col("verse_key").alias("key")).unionByName(graph.inverted_index(t.articles, ("id",)).select("key"))
    asked = t.references.select(F.struct("request_id", F.lit("r").alias("kind")).alias("request_id"), F.col("reference").alias("request"))
    typed = t.citation_requests.select(F.struct("request_id", F.lit("c").alias("kind")).alias("request_id"), F.col("citation").alias("request"))
    out = tools.query_router(asked.unionByName(typed), t.articles.select("id"), held)
    return out.select("request_id.request_id", "request_id.kind", "route", "target")


# --- joins -----------------------------------------------------------------------


@query("verse_text_join", with_("vkey", "eng") + "SELECT v.id, pos, verse_key, text FROM vkey v JOIN eng ON verse_key = key")
def verse_text_join(t):
    found = align.verse_text_join(_cites(t), t.english.select("verse_key", "text"))
    return found.select("id", "pos", "verse_key", "text")


@query("parallel_text_join", with_("eng", "lat") + "SELECT e.verse_key, e.text, coalesce(l.text, '') AS latin FROM eng e LEFT JOIN lat l USING (verse_key)")
def parallel_text_join(t):
    return align.parallel_text_join(t.english.select("verse_key", "text"), t.latin)


@query(
    "parallel_alignment",
    with_("eng", "lat")
    + """SELECT count(l.k) AS left_keys, count(r.k) AS right_keys, count(*) FILTER (WHERE l.k IS NOT NULL AND r.k IS NOT NULL) AS shared, count(*) FILTER (WHERE r.k IS NULL) AS left_only,
      count(*) FILTER (WHERE l.k IS NULL) AS right_only, round(count(*) FILTER (WHERE l.k IS NOT NULL AND r.k IS NOT NULL) / count(r.k), 4) AS rate
    FROM (SELECT DISTINCT verse_key AS k FROM lat) l FULL OUTER JOIN (SELECT DISTINCT verse_key AS k FROM eng) r ON l.k = r.k""",
)
def parallel_alignment(t):
    return align.parallel_alignment(t.latin, t.english)


@query(
    "citation_coverage",
    with_("idx", "eng")
    + """SELECT count(*) AS cited, count(*) FILTER (WHERE held) AS resolved, round(count(*) FILTER (WHERE held) / count(*), 4) AS rate
    FROM (SELECT DISTINCT key, key IN (SELECT verse_key FROM eng) AS held FROM idx WHERE len(string_split(key, '/')) = 3)""",
)
def citation_coverage(t):
    return align.citation_coverage(graph.inverted_index(t.articles, ("id",)), t.english)


@query("fk_check", with_("fidx", "eng") + "SELECT id, key FROM fidx WHERE key NOT IN (SELECT verse_key FROM eng)")
def fk_check(t):
    keys = graph.fathers_index(t.pericopes).select("id", "key")
    return keys.join(t.english.select(F.col("verse_key").alias("key")).distinct(), "key", "left_anti").select("id", "key")


@query(
    "clamp_keys",
    with_("fidx", "eng") + "SELECT id, key AS verse_key, key IN (SELECT verse_key FROM eng) AS kept FROM fidx",
)
def clamp_keys(t):
    kept, dropped = align.clamp_keys(t.pericopes.withColumnRenamed("commented_verse_keys", "label_keys"), t.english)
    return kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False)))


@query(
    "verse_to_chain",
    with_("refn", "fidx", "per", "frag")
    + """, k AS (SELECT request_id, unnest(verse_keys) AS key, generate_subscripts(verse_keys, 1) AS o FROM refn WHERE ok AND v1 IS NOT NULL
      UNION ALL SELECT request_id, f.key, row_number() OVER (PARTITION BY request_id ORDER BY f.key) FROM refn JOIN (SELECT DISTINCT key FROM fidx) f ON ok AND v1 IS NULL AND starts_with(f.key, chapter_key || '/')),
    p AS (SELECT DISTINCT request_id, id FROM k JOIN fidx USING (key))
    SELECT request_id, p.id, i AS pos, father, frag.text FROM p JOIN per ON per.id = p.id JOIN frag USING (doc_id)""",
)
def verse_to_chain(t):
    index = graph.fathers_index(t.pericopes).select("key", "id")
    chains = settle(tools.verse_pericopes(t.references, index).select("request_id", "id"), "chains")
    held = t.pericopes.select("id", "segments").join(chains, "id")
    return held.select("request_id", "id", each_at("segments").alias("pos", "s")).select("request_id", "id", "pos", "s.father", "s.text")


@query(
    "date_asof_forward",
    with_("read")
    + """, a AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS asked FROM lineitem)
    SELECT CAST(asked AS VARCHAR) AS asked, CAST(coalesce((SELECT min(date) FROM read WHERE date >= asked), (SELECT max(date) FROM read)) AS VARCHAR) AS held FROM a""",
)
def date_asof_forward(t):
    asked = t.lineitem.select(F.to_date("l_shipdate").alias("date"))
    found = align.date_asof_forward(asked, t.readings)
    return found.select(F.col("asked").cast("string").alias("asked"), F.col("held").cast("string").alias("held"))


# --- sets ------------------------------------------------------------------------


@query("intersect_keys", with_("eng", "lat") + "SELECT verse_key FROM eng INTERSECT SELECT verse_key FROM lat")
def intersect_keys(t):
    return t.english.select("verse_key").join(t.latin.select("verse_key"), "verse_key", "left_semi").distinct()


@query("difference_keys", with_("eng", "lat") + "SELECT verse_key FROM lat EXCEPT SELECT verse_key FROM eng")
def difference_keys(t):
    return t.latin.select("verse_key").subtract(t.english.select("verse_key"))


@query(
    "union_corpora",
    with_("art") + "SELECT id, citation, title, type, length(text) AS n FROM (SELECT id, citation, title, 'article' AS type, text FROM art UNION ALL SELECT 'page.' || page_id, url, NULL, 'page', html FROM pages)",
)
def union_corpora(t):
    pages = t.pages.select(
        F.concat(F.lit("page."), corpus.text_of(F.col("page_id"))).alias("id"), F.col("url").alias("citation"),
        F.lit("page").alias("type"), F.col("html").alias("text"),
    )
    both = project.union_corpora(t.articles.select("id", "citation", "title", "type", "text"), pages)
    return both.select("id", "citation", "title", "type", F.length("text").cast("long").alias("n"))


@query(
    "upsert_by_date",
    """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, nullif(min(o_orderkey) % 5, 0) AS v FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
    n AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_orderkey) AS v FROM lineitem GROUP BY 1)
    SELECT CAST(coalesce(o.date, n.date) AS VARCHAR) AS date, coalesce(o.v, n.v) AS v FROM o FULL JOIN n ON o.date = n.date""",
)
def upsert_by_date(t):
    """Some of the old rows are empty; the new ones fill them where they can."""
    old = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.nullif(F.min("o_orderkey") % 5, F.lit(0)).alias("v"))
    new = t.lineitem.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.max("l_orderkey").alias("v"))
    return align.upsert_by_date(old, new, value="v").withColumn("date", F.col("date").cast("string"))


@query(
    "prefer_first",
    """SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY CASE role WHEN 'assistant' THEN 0 ELSE 1 END, turn) AS r FROM conversations) WHERE r = 1""",
)
def prefer_first(t):
    order = F.struct(F.when(F.col("role") == "assistant", 0).otherwise(1), F.col("turn"))
    return align.prefer_first(t.conversations, "conv_id", order, ["turn", "role"])


@query(
    "parse_gospel_segments",
    with_("read", "alias")
    + r""", p AS (SELECT date, gospel, split_part(gospel, ' ', 1) AS b, CAST(regexp_extract(gospel, ' ([0-9]+):', 1) AS INT) AS ch, regexp_extract(gospel, ':(.*)$', 1) AS body FROM read),
    s AS (SELECT date, gospel, slug, ch, unnest(string_split(body, ',')) AS item, generate_subscripts(string_split(body, ','), 1) AS k FROM p JOIN alias ON alias = lower(b)),
    g AS (SELECT *, regexp_extract(item, '^([0-9]+)(?:-(?:([0-9]+):)?([0-9]+))?$', ['a', 'c', 'z']) AS x FROM s)
    SELECT CAST(date AS VARCHAR) AS date, gospel, slug, CAST(k - 1 AS INT) AS span_no, ch AS ch1, CAST(x.a AS INT) AS v1, coalesce(TRY_CAST(x.c AS INT), ch) AS ch2, coalesce(TRY_CAST(x.z AS INT), CAST(x.a AS INT)) AS v2,
      CASE WHEN bool_or(x.c <> '') OVER (PARTITION BY date) THEN 'cross-chapter' ELSE 'single-chapter' END AS parse_status FROM g""",
)
def parse_gospel_segments(t):
    parsed = t.readings.select(F.col("date").cast("string").alias("date"), "gospel", refs.gospel_spans(F.col("gospel")).alias("g"))
    rows = parsed.select("date", "gospel", "g.slug", F.posexplode("g.spans").alias("span_no", "s"), "g.parse_status")
    return rows.select("date", "gospel", "slug", "span_no", "s.*", "parse_status")
