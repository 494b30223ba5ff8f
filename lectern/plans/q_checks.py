"""Queries over the integrity checks; each returns what breaks the rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import canon
from ..functions.columns import each, pick
from ..functions.text import clean_latin
from ..operators import quality
from . import corpus, oracle
from .oracle import collapse, with_
from .registry import query


@query("unique_id", "SELECT lower(string_split(text, chr(10))[1]) AS id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def unique_id(t):
    return quality.unique_id(t.articles.select(F.lower("title").alias("id")))


@query("unique_text", "SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def unique_text(t):
    return quality.unique_text(t.documents)


_AFTER = "regexp_replace(line, '^[^,.]*[,.]?', '')"


@query("nonempty_text", with_("lin") + f"SELECT doc_id, i FROM (SELECT doc_id, i, {_AFTER} AS rest FROM lin) WHERE trim(rest) = ''")
def nonempty_text(t):
    rest = t.lines.select("doc_id", "i", F.regexp_replace("line", r"^[^,.]*[,.]?", "").alias("rest"))
    return quality.nonempty_text(rest, "rest").select("doc_id", "i")


@query("license_present", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE CASE quality WHEN 1 THEN 'cc-by' WHEN 0 THEN '' END IS NULL OR quality = 0")
def license_present(t):
    held = t.labels.select("doc_id", "quality")
    license = F.when(F.col("quality") == 1, "cc-by").when(F.col("quality") == 0, "")
    return quality.license_present(t.documents.select("doc_id").join(held, "doc_id", "left"), license).select("doc_id")


@query("lossless_rejoin", "SELECT doc_id FROM documents WHERE coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda l: length(l) > 9), chr(10) || chr(10)), '') <> replace(text, chr(10), chr(10) || chr(10))")
def lossless_rejoin(t):
    segments = F.transform(F.filter("lines", lambda l: F.length(l) > 9), lambda l: F.struct(l.alias("text")))
    nodes = t.doc_lines.select("doc_id", segments.alias("segments"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return quality.lossless_rejoin(nodes).select("doc_id")


@query(
    "id_citation_agree",
    with_("art") + "SELECT id, cited AS citation FROM (SELECT id, CASE WHEN lang = 'de' THEN replace(citation, 'q.', 'q.1') WHEN lang = 'es' THEN lower(citation) ELSE citation END AS cited, lang FROM art) WHERE lang IN ('de', 'es')",
)
def id_citation_agree(t):
    cited = F.when(F.col("lang") == "de", F.replace("citation", F.lit("q."), F.lit("q.1"))).when(
        F.col("lang") == "es", F.lower("citation")
    ).otherwise(F.col("citation"))
    return quality.id_citation_agree(t.articles.select("id", cited.alias("citation")))


@query("verse_position_agree", with_("lat") + "SELECT id, CASE WHEN verse % 2 = 0 THEN verse_key ELSE replace(verse_key, '-', '') END AS verse_key FROM lat WHERE verse % 2 = 1 AND contains(slug, '-')")
def verse_position_agree(t):
    key = F.when(F.col("verse") % 2 == 0, F.col("verse_key")).otherwise(F.replace("verse_key", F.lit("-"), F.lit("")))
    return quality.verse_position_agree(t.latin.withColumn("verse_key", key), "vg").select("id", "verse_key")


# The commentary's ids end in the document they came from.
_CHAIN_ID = quality.COMMENTARY_ID.replace(r"\z", r"\.[0-9]+\z")


@query(
    "commentary_position_agree",
    with_("per") + "SELECT id, replace(citation, ':', ':1') AS citation FROM per JOIN documents USING (doc_id) WHERE lang = 'de'",
)
def commentary_position_agree(t):
    langs = t.documents.select("doc_id", "lang")
    cited = F.when(F.col("lang") == "de", F.replace("citation", F.lit(":"), F.lit(":1"))).otherwise(F.col("citation"))
    nodes = t.pericopes.select("doc_id", "id", "citation").join(langs, "doc_id").withColumn("citation", cited)
    return quality.commentary_position_agree(nodes, _CHAIN_ID).select("id", "citation")


@query(
    "keys_in_gospel",
    with_("per") + "SELECT id, replace(key, 'mark/1', 'luke/1') AS verse_key FROM (SELECT id, slug, unnest(keys) AS key FROM per) WHERE starts_with(key, 'mark/1')",
)
def keys_in_gospel(t):
    moved = F.transform("commented_verse_keys", lambda k: F.replace(k, F.lit("mark/1"), F.lit("luke/1")))
    return quality.keys_in_gospel(t.pericopes.select("id", moved.alias("commented_verse_keys")))


_GOSPELS = ", ".join(f"'{g}'" for g in canon.GOSPELS)


@query(
    "commentary_chapters",
    with_("per", "book")
    + f"""SELECT b.slug, CAST(b.chapter AS INT) AS chapter FROM (SELECT slug, unnest(range(1, chapters + 1)) AS chapter FROM book WHERE slug IN ({_GOSPELS})) b
    LEFT JOIN (SELECT DISTINCT CASE WHEN slug = 'john' THEN 'mark' ELSE slug END AS slug, ch FROM per) p ON p.slug = b.slug AND p.ch = b.chapter WHERE p.slug IS NULL""",
)
def commentary_chapters(t):
    """One gospel's commentary stands under another one."""
    return quality.commentary_chapters(t.pericopes.withColumn("id", F.replace("id", F.lit(".john."), F.lit(".mark."))))


@query("teaching_part_agree", with_("art") + f"SELECT id, citation FROM ({corpus.TEACHING_SQL}) WHERE lang = 'es' OR title = ''")
def teaching_part_agree(t):
    return quality.teaching_part_agree(t.teaching).select("id", "citation")


@query("missing_parts", with_("art") + f"SELECT '' || p AS part FROM (SELECT unnest(range(1, 5)) AS p) WHERE p NOT IN (SELECT CASE WHEN doc_id % 4 < 2 THEN doc_id % 4 + 1 ELSE 1 END FROM ({corpus.TEACHING_SQL}))")
def missing_parts(t):
    """Two parts' nodes say that they are of the first."""
    moved = F.regexp_replace("id", r"^catechism\.p[34]", "catechism.p1")
    return quality.missing_parts(t.teaching.withColumn("id", moved))


@query(
    "missing_units",
    with_("art") + f"""SELECT kind, CAST(number AS INT) AS number FROM (SELECT kind, unnest(range(1, n + 1)) AS number
      FROM (VALUES {", ".join(f"('{k}', {n})" for k, n in canon.TEACHING_UNITS.items())}) s(kind, n))
    WHERE kind <> 'article' OR number NOT IN (SELECT CASE WHEN doc_id % 12 < 7 THEN doc_id % 12 + 1 ELSE 1 END FROM ({corpus.TEACHING_SQL}))""",
)
def missing_units(t):
    """Five articles' nodes say that they are of the first."""
    moved = F.regexp_replace("id", r"\.art([89]|1[0-2])\.", ".art1.")
    return quality.missing_units(t.teaching.withColumn("id", moved))


@query(
    "coverage_complete",
    with_("lat", "book") + "SELECT b.slug, CAST(b.chapter AS INT) AS chapter FROM (SELECT slug, unnest(range(1, chapters + 1)) AS chapter FROM book) b LEFT JOIN (SELECT DISTINCT slug, chapter FROM lat) l USING (slug, chapter) WHERE l.slug IS NULL",
)
def coverage_complete(t):
    return quality.coverage_complete(t.latin, quality.expected_chapters(t.spark), ["slug", "chapter"])


_SPEC = ", ".join(f"('{p[0]}', {p[3]})" for p in canon.PARTS)


@query(
    "coverage_questions",
    with_("art")
    + f"SELECT part, CAST(question AS INT) AS question FROM (SELECT part, unnest(range(1, n + 1)) AS question FROM (VALUES {_SPEC}) s(part, n)) WHERE NOT EXISTS (SELECT 1 FROM art WHERE slug = part AND q = question)",
)
def coverage_questions(t):
    present = t.articles.select(
        F.split_part("id", F.lit("."), F.lit(3)).alias("part"),
        F.substring(F.split_part("id", F.lit("."), F.lit(4)), 2, 9).cast("int").alias("question"),
    )
    return quality.coverage_complete(present, quality.expected_questions(t.spark), ["part", "question"])


@query(
    "contiguity_check",
    """SELECT l_orderkey, min(l_linenumber) AS first, max(l_linenumber) AS last, count(*) AS rows, count(DISTINCT l_linenumber) AS numbers FROM lineitem GROUP BY 1
    HAVING count(*) <> count(DISTINCT l_linenumber) OR max(l_linenumber) - min(l_linenumber) + 1 <> count(DISTINCT l_linenumber) OR min(l_linenumber) <> 1""",
)
def contiguity_check(t):
    return quality.contiguity(t.lineitem, ["l_orderkey"], "l_linenumber")


@query(
    "contiguity",
    with_("eng")
    + """SELECT slug, chapter, min(verse) AS first, max(verse) AS last, count(*) AS rows, count(DISTINCT verse) AS numbers FROM (SELECT slug, chapter, CASE WHEN length(text) > 9 THEN verse ELSE verse + 1 END AS verse FROM eng) GROUP BY 1, 2
    HAVING count(*) <> count(DISTINCT verse) OR max(verse) - min(verse) + 1 <> count(DISTINCT verse) OR min(verse) <> CASE WHEN slug = 'psalms' AND chapter = 115 THEN 10 WHEN slug = 'psalms' AND chapter = 147 THEN 12 ELSE 1 END""",
)
def contiguity(t):
    """Short verses have the number of the next one."""
    start = quality.late_start(F.col("slug"), F.col("chapter"))
    verse = F.when(F.length("text") > 9, F.col("verse")).otherwise(F.col("verse") + 1)
    return quality.contiguity(t.english.withColumn("verse", verse), ["slug", "chapter"], "verse", start)


@query(
    "number_gaps",
    """WITH p AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), s AS (SELECT l_orderkey, unnest(range(min(l_linenumber), max(l_linenumber) + 1)) AS l_linenumber FROM p GROUP BY 1)
    SELECT l_orderkey, CAST(l_linenumber AS INT) AS l_linenumber FROM s EXCEPT SELECT * FROM p""",
)
def number_gaps(t):
    return quality.gaps(t.lineitem, ["l_orderkey"], "l_linenumber")


@query("charset_whitelist", r"SELECT conv_id, turn FROM conversations WHERE regexp_matches(text, '[/\\\[\]<>]|[^\x00-\x7fæÆœë]')")
def charset_whitelist(t):
    return quality.charset_whitelist(t.conversations).select("conv_id", "turn")


@query(
    "substring_of_source",
    with_("lin") + f"SELECT doc_id, i FROM lin JOIN (SELECT doc_id, {collapse('text')} AS flat FROM documents) USING (doc_id) WHERE NOT contains(flat, replace(line, 'eaou', 'Eaou'))",
)
def substring_of_source(t):
    rows = t.lines.select("doc_id", "i", F.replace("line", F.lit("eaou"), F.lit("Eaou")).alias("text"))
    sources = t.documents.select("doc_id", F.col("text").alias("source_text"))
    return quality.substring_of_source(rows, sources, ["doc_id"]).select("doc_id", "i")


@query(
    "rederive_equals",
    with_("lat") + "SELECT verse_key, stored FROM (SELECT verse_key, text, replace(text, 'die', 'Die') AS stored FROM lat) WHERE stored <> text",
)
def rederive_equals(t):
    stored = t.latin.select("verse_key", F.replace("text", F.lit("die"), F.lit("Die")).alias("text"))
    broken = quality.rederive_equals(stored, t.latin_raw, ["verse_key"])
    return broken.select("verse_key", F.col("text").alias("stored"))


@query("every_segment_has_father", with_("frag", "per") + "SELECT DISTINCT id FROM frag JOIN per USING (doc_id) WHERE father = ''")
def every_segment_has_father(t):
    return quality.every_segment_has_father(t.pericopes).select("id")


@query("title_suffix", with_("art") + "SELECT id, title FROM (SELECT id, title, 'Part I, ' || CASE WHEN lang = 'fr' THEN title || ' [' || source || ']' ELSE title || '  ' END AS cited FROM art) WHERE title <> '' AND NOT ends_with(rtrim(cited), title)")
def title_suffix(t):
    cited = F.concat(F.lit("Part I, "), F.when(F.col("lang") == "fr", F.concat("title", F.lit(" ["), "source", F.lit("]"))).otherwise(F.concat("title", F.lit("  "))))
    return quality.title_suffix(t.articles.withColumn("citation", cited)).select("id", "title")


@query("citations_parse", with_("scr") + "SELECT id, raw FROM scr WHERE NOT ok")
def citations_parse(t):
    return quality.citations_parse(t.articles)


@query("marker_leak_check", "SELECT conv_id, turn FROM conversations WHERE role = 'assistant'")
def marker_leak_check(t):
    marked = F.when(F.col("role") == "assistant", F.concat(corpus.text_of(F.col("turn")), F.lit(":1. "), F.col("text"))).otherwise(F.col("text"))
    return quality.marker_leak_check(t.conversations.withColumn("text", marked)).select("conv_id", "turn")


_WANT = ["john", "luke"]


@query(
    "page_verify",
    f"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="/([^"]*)">', 1)) AS h FROM pages WHERE page_id % 11 <> 4),
    b AS (SELECT page_id, CASE WHEN length(h) > 9 THEN 'luke' ELSE 'john' END AS slug FROM a),
    w AS (SELECT page_id AS page, {oracle.pick(_WANT, 'page_id')} AS want_slug, length(url) % 3 AS want_chapter FROM pages)
    SELECT page, want_slug, want_chapter, count(slug) AS anchors FROM w LEFT JOIN b ON page_id = page
    GROUP BY 1, 2, 3 HAVING count(slug) = 0 OR count(*) FILTER (WHERE slug <> want_slug) > 0""",
)
def page_verify(t):
    """Links stand for anchors; every eleventh page is taken for one that has none."""
    hrefs = F.when(F.col("page_id") % 11 != 4, F.regexp_extract_all("html", F.lit('<a href="/([^"]*)">'), F.lit(1)))
    rows = t.pages.select(F.col("page_id").alias("page"), (F.length("url") % 3).cast("long").alias("chapter"), each(hrefs).alias("h"))
    anchors = rows.select("page", F.when(F.length("h") > 9, "luke").otherwise("john").alias("slug"), "chapter")
    wanted = t.pages.select(F.col("page_id").alias("page"), pick(_WANT, F.col("page_id")).alias("want_slug"), (F.length("url") % 3).cast("long").alias("want_chapter"))
    return quality.page_verify(wanted, anchors)
