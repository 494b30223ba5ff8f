"""Queries over the text, reference and vector functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import canon
from ..functions import refs, text, vectors
from ..functions.columns import each, each_at, pick
from ..operators import parse, quality
from ..operators.graph import scripture_citations
from . import corpus, oracle
from .oracle import collapse, tokens, with_
from .registry import query

# --- tokens and whitespace -------------------------------------------------------


@query("tokenize", f"SELECT doc_id, CAST(len({tokens('text')}) AS INT) AS n_tokens, array_to_string({tokens('text')}, ' ') AS tokens FROM documents")
def tokenize(t):
    toks = t.documents.select("doc_id", text.tokenize(F.col("text")).alias("t"))
    return toks.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("collapse_ws", f"SELECT doc_id, {collapse('text')} AS flat FROM documents")
def collapse_ws(t):
    return t.documents.select("doc_id", text.collapse_ws(F.col("text")).alias("flat"))


@query(
    "first_seen_distinct",
    f"""WITH w AS (SELECT doc_id, unnest({tokens('text')}) AS t, generate_subscripts({tokens('text')}, 1) AS i FROM documents)
    SELECT doc_id, coalesce(terms, '') AS terms FROM documents LEFT JOIN (
      SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS terms FROM (SELECT doc_id, t, min(i) AS i FROM w GROUP BY 1, 2) GROUP BY 1) USING (doc_id)""",
)
def first_seen_distinct(t):
    terms = t.documents.select("doc_id", text.first_seen_distinct(text.tokenize(F.col("text"))).alias("t"))
    return terms.select("doc_id", F.array_join("t", " ").alias("terms"))


_FLAT = collapse("text")


@query(
    "snippet",
    f"""SELECT doc_id, CASE WHEN length(f) > 360 THEN regexp_replace(f[1:360], ' [^ ]*$', '') || ' ...' ELSE f END AS cli,
        CASE WHEN length(f) > 340 THEN regexp_replace(f[1:340], ' [^ ]*$', '') || ' ...' ELSE f END AS page
    FROM (SELECT doc_id, {_FLAT} AS f FROM documents)""",
)
def snippet(t):
    return t.documents.select(
        "doc_id", text.snippet(F.col("text"), 360).alias("cli"), text.snippet(F.col("text"), 340).alias("page")
    )


@query(
    "join_segments",
    with_("seg") + "SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY i) AS joined FROM seg GROUP BY 1",
)
def join_segments(t):
    return t.articles.select("doc_id", text.join_segments(F.col("segments")).alias("joined"))


@query(
    "prepare_embed_text",
    "SELECT doc_id, (string_split(text, chr(10))[1] || chr(10) || text)[1:28000] AS input FROM documents",
)
def prepare_embed_text(t):
    return t.articles.select("doc_id", text.prepare_embed_text(F.col("title"), F.col("text")).alias("input"))


# --- markup ----------------------------------------------------------------------

_ENTITIES = [("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def _decoded(x: str) -> str:
    for entity, char in _ENTITIES:
        x = f"replace({x}, '{entity}', '{char}')"
    return x


_TAG = r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>|<[!?][^>]*>"


def sql_html_to_text(x: str) -> str:
    return collapse(_decoded(f"regexp_replace({x}, '{_TAG}', '', 'g')"))


def sql_html_clean(x: str) -> str:
    return collapse(
        f"translate(replace({_decoded(f'''regexp_replace({x}, '<[^>]+>', ' ', 'g')''')}, '­', ''), '°·', '  ')"
    )


@query("html_to_text", f"SELECT page_id, {sql_html_to_text('html')} AS plain FROM pages")
def html_to_text(t):
    return t.pages.select("page_id", text.html_to_text(F.col("html")).alias("plain"))


@query("html_clean", f"SELECT page_id, {sql_html_clean('html')} AS plain FROM pages")
def html_clean(t):
    return t.pages.select("page_id", text.html_clean(F.col("html")).alias("plain"))


_ELEMENTS = r"(?is)<h1\b[^>]*>.*?</h1>|<p\b[^>]*>.*?</p>"
_ELEMENT_ROWS = f"""SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS pos, tag, plain FROM (
    SELECT page_id, k, lower(regexp_extract(e, '^<([A-Za-z0-9]+)', 1)) AS tag,
           {sql_html_clean("regexp_extract(e, '(?s)^<[^>]*>(.*)</[^>]*>$', 1)")} AS plain
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '{_ELEMENTS}')) AS e,
                 generate_subscripts(regexp_extract_all(html, '{_ELEMENTS}'), 1) AS k FROM pages)) WHERE plain <> ''"""


@query("extract_elements", f"SELECT page_id, CAST(pos AS INT) AS pos, tag, plain FROM ({_ELEMENT_ROWS})")
def extract_elements(t):
    found = text.extract_elements(F.col("html"), ("h1", "p"))
    return t.pages.select("page_id", each_at(found).alias("pos", "e")).select(
        "page_id", "pos", "e.tag", F.col("e.text").alias("plain")
    )


_LINK = r'(?is)<a\s+href="[^"]*?/[^"]*?"[^>]*>(.*?)</a>'


@query(
    "extract_links",
    f"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS x, generate_subscripts(regexp_extract_all(html, '{_LINK}', 1), 1) AS k FROM pages),
    d AS (SELECT page_id, {sql_html_to_text('x')} AS raw, min(k) AS k FROM l GROUP BY 1, 2)
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INT) AS pos, raw FROM d WHERE raw <> ''""",
)
def extract_links(t):
    return t.pages.select("page_id", F.posexplode(text.extract_links(F.col("html"), "/")).alias("pos", "raw"))


XREF_BOOKS = ["john", "isaias", "1-kings", "osee", "apocalypse", "nobook"]


@query(
    "extract_xrefs",
    with_("alias")
    + f""", l AS (SELECT page_id, unnest(regexp_extract_all(html, '{_LINK}', 1)) AS x, generate_subscripts(regexp_extract_all(html, '{_LINK}', 1), 1) - 1 AS j FROM pages),
    r AS (SELECT page_id, j, {oracle.pick(XREF_BOOKS, 'page_id + j')} AS bk, length(x) AS L FROM l),
    s AS (SELECT page_id, j, a.name || ' ' || CASE WHEN L % 3 = 0 THEN '' || (L % 20 + 1) WHEN L % 3 = 1 THEN (L % 20 + 1) || ':' || (j + 1)
            ELSE (L % 20 + 1) || ':' || (j + 1) || '-' || (j + 3) END AS raw FROM r JOIN alias a ON a.alias = r.bk),
    d AS (SELECT page_id, raw, min(j) AS j FROM s GROUP BY 1, 2)
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY j) - 1 AS INT) AS pos, raw FROM d""",
)
def collect_xrefs(t):
    def anchor(x, j):
        n = F.length(x)
        c, v = corpus.text_of(F.pmod(n, F.lit(20)) + 1), corpus.text_of(j + 1)
        shown = F.when(n % 3 == 0, c).when(n % 3 == 1, F.concat(c, F.lit(" : "), v)).otherwise(
            F.concat(c, F.lit(":"), v, F.lit("—"), corpus.text_of(j + 3))
        )
        return F.concat(F.lit('<a href="/douay-rheims-bible/'), pick(XREF_BOOKS, F.col("page_id") + j),
                        F.lit('.shtml#x"><b>See '), shown, F.lit("</b></a>"))

    links = F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))
    fragment = t.pages.select("page_id", F.array_join(F.transform(links, anchor), " ").alias("html"))
    return fragment.select("page_id", F.posexplode(refs.collect_xrefs(F.col("html"))).alias("pos", "c")).select(
        "page_id", "pos", "c.raw"
    )


@query(
    "escape_html",
    "SELECT page_id, replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM pages",
)
def escape_html(t):
    return t.pages.select("page_id", text.escape_html(F.col("html")).alias("escaped"))


@query(
    "strip_boilerplate",
    r"""SELECT page_id, CASE WHEN e > 0 THEN b[1:e - 1] ELSE b END AS body FROM (SELECT page_id, b, instr(b, '</article>') AS e FROM (
        SELECT page_id, CASE WHEN instr(html, '<article>') > 0 THEN html[instr(html, '<article>') + 9:] ELSE html END AS b FROM pages))""",
)
def strip_boilerplate(t):
    return t.pages.select("page_id", text.strip_boilerplate(F.col("html"), "<article>", "</article>").alias("body"))


@query(
    "clean_latin",
    "SELECT conv_id, turn, " + collapse(r"translate(regexp_replace('<Sponsa> ' || replace(replace(text, ', ', '/'), '. ', ' [\] '), '<[^>]*>', '', 'g'), '/\[]', '    ')") + " AS latin FROM conversations",
)
def clean_latin(t):
    marked = F.concat(F.lit("<Sponsa> "), F.replace(F.replace("text", F.lit(", "), F.lit("/")), F.lit(". "), F.lit(" [\\] ")))
    return t.conversations.select("conv_id", "turn", text.clean_latin(marked).alias("latin"))


# --- segments and names ----------------------------------------------------------


@query(
    "classify_segment",
    with_("seg")
    + r"""SELECT doc_id, i, CASE WHEN regexp_matches(text, '(?i)^Objection\s+([0-9]+)\.') THEN 'objection' WHEN regexp_matches(text, '(?i)^On the contrary,') THEN 'sed-contra'
      WHEN regexp_matches(text, '(?i)^I answer that,') THEN 'respondeo' WHEN regexp_matches(text, '(?i)^Reply to Objection\s+([0-9]+)\.') THEN 'reply' ELSE 'text' END AS role,
      TRY_CAST(NULLIF(regexp_extract(text, '(?i)^(?:Reply to )?Objection\s+([0-9]+)\.', 1), '') AS INT) AS n FROM seg""",
)
def classify_segment(t):
    segs = t.articles.select("doc_id", each_at("segments").alias("i", "s"))
    return segs.select("doc_id", "i", text.classify_segment(F.col("s.text")).alias("c")).select("doc_id", "i", "c.role", "c.n")


@query("normalize_father", with_("frag") + "SELECT father, count(*) AS fragments FROM frag GROUP BY 1")
def normalize_father(t):
    names = t.lines.select(text.normalize_father(pick(corpus.SPEAKERS, F.col("len") + F.col("i"))).alias("father"))
    return names.groupBy("father").agg(F.count("*").alias("fragments"))


@query("strip_verse_marker", "SELECT conv_id, turn, regexp_replace(text, '^\\s+', '') AS bare FROM conversations")
def strip_verse_marker(t):
    n = corpus.text_of(F.col("turn") + 1)
    marked = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Ver. "), n, F.lit(". "), F.col("text"))).otherwise(
        F.concat(n, F.lit(" - "), n, F.lit(". "), F.col("text"))
    )
    return t.conversations.select("conv_id", "turn", text.strip_verse_marker(marked).alias("bare"))


@query(
    "title_ref",
    with_("scr")
    + r"""SELECT id, pos, array_to_string(list_transform(regexp_extract_all(lower(ref), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+'), lambda p: upper(p[1:1]) || p[2:]), '') AS shown
    FROM scr WHERE ok""",
)
def title_ref(t):
    cites = scripture_citations(t.articles)
    return cites.filter(F.col("norm").isNotNull()).select("id", "pos", text.title_ref(F.lower("norm.ref")).alias("shown"))


@query("norm_gospel", with_("fread", "read") + "SELECT CAST(fread.date AS VARCHAR) AS date, raw, gospel FROM fread LEFT JOIN read USING (date)")
def norm_gospel(t):
    return t.foreign_readings.select(F.col("date").cast("string").alias("date"), "raw", text.norm_gospel(F.col("raw")).alias("gospel"))


# --- references ------------------------------------------------------------------

_NORM_COLS = "id, pos, raw, book, slug, chapter, v1 AS verse_start, v2 AS verse_end, ref, chapter_key, array_to_string(verse_keys, ' ') AS keys"


@query("normalize_ref", with_("scr") + f"SELECT {_NORM_COLS} FROM (SELECT * REPLACE (CASE WHEN ok THEN chapter END AS chapter, CASE WHEN ok THEN v1 END AS v1, CASE WHEN ok THEN v2 END AS v2) FROM scr)")
def normalize_ref(t):
    n = F.col("norm")
    return scripture_citations(t.articles).select(
        "id", "pos", "raw", n["book"].alias("book"), n["slug"].alias("slug"), n["chapter"].alias("chapter"),
        n["verse_start"].alias("verse_start"), n["verse_end"].alias("verse_end"), n["ref"].alias("ref"),
        n["chapter_key"].alias("chapter_key"), F.array_join(refs.verse_keys(n), " ").alias("keys"),
    )


_PRINTED_LINE = oracle.pick(corpus.PRINTED, "doc_id + i")


@query(
    "resolve_book",
    with_("lin", "alias")
    + f"SELECT printed, slug, count(*) AS n FROM (SELECT upper({_PRINTED_LINE}) || '.' AS printed FROM lin) LEFT JOIN alias ON alias = regexp_replace(lower(printed), '[\\s.]', '', 'g') GROUP BY 1, 2",
)
def resolve_book(t):
    printed = F.concat(F.upper(pick(corpus.PRINTED, F.col("doc_id") + F.col("i"))), F.lit("."))
    rows = t.lines.select(printed.alias("printed"))
    return rows.groupBy("printed").agg(F.count("*").alias("n")).withColumn("slug", refs.resolve_book(F.col("printed")))


_TITLES = list(canon.PRINTED_TITLES) + ["Apocalypse", "Ecclesiasticus", "Ruth", "5 Kings"]


@query(
    "alias_override",
    with_("lin", "alias")
    + f"""SELECT printed, slug, count(*) AS n FROM (SELECT {oracle.pick(_TITLES, 'doc_id + L')} AS printed FROM lin)
    LEFT JOIN alias ON alias = replace(lower(CASE printed WHEN '1 Kings' THEN '1 Samuel' WHEN '2 Kings' THEN '2 Samuel' WHEN '3 Kings' THEN '1 Kings'
      WHEN '4 Kings' THEN '2 Kings' WHEN '1 Esdras' THEN 'Ezra' WHEN '2 Esdras' THEN 'Nehemiah' ELSE printed END), ' ', '') GROUP BY 1, 2""",
)
def alias_override(t):
    rows = t.lines.select(pick(_TITLES, F.col("doc_id") + F.col("len")).alias("printed"))
    return rows.groupBy("printed").agg(F.count("*").alias("n")).withColumn("slug", refs.alias_override(F.col("printed")))


@query("strip_seqq", with_("cit") + "SELECT doc_id, pos, replace(raw, ', seqq.', '') AS bare FROM cit")
def strip_seqq(t):
    each = t.articles.select("doc_id", each_at("citations_out").alias("pos", "c"))
    return each.select("doc_id", "pos", refs.strip_seqq(F.col("c.raw")).alias("bare"))


@query(
    "expand_range",
    with_("lin") + "SELECT doc_id, i, unnest(range(i % 9 + 1, greatest(i % 9 + 1, L % 12) + 1)) AS v FROM lin",
)
def expand_range(t):
    first, last = F.col("i") % 9 + 1, F.col("len") % 12
    keys = refs.expand_range(F.lit("john/1"), first, last)
    rows = t.lines.select("doc_id", "i", each(keys).alias("key"))
    return rows.select("doc_id", "i", F.split_part("key", F.lit("/"), F.lit(3)).cast("long").alias("v"))


@query("parse_internal_refs", with_("inl") + "SELECT src, dst FROM inl")
def parse_internal_refs(t):
    return t.articles.select(F.col("id").alias("src"), F.explode(refs.parse_internal_refs(F.col("noted_text"))).alias("dst"))


@query(
    "inline_refs",
    with_("norm")
    + """SELECT doc_id, trim(regexp_replace(arg_min(raw, pos), '\\s+', ' ', 'g')) AS raw FROM (
      SELECT doc_id, pos, ref, replace(replace(replace(raw, ' – ', '-'), ', seqq.', ''), 'Canticle of Canticles', 'Canticles') AS raw
      FROM norm WHERE ok AND v1 IS NOT NULL AND NOT regexp_matches(raw, 'Tim[.]|Song of Songs')) GROUP BY doc_id, ref""",
)
def inline_refs(t):
    # The written form allows one space before the numbers, so wider gaps are closed.
    said = F.transform(
        F.filter("citations_out", lambda c: c["kind"] == "scripture"),
        lambda c: text.collapse_ws(c["raw"]),
    )
    notes = t.articles.select("doc_id", refs.inline_refs(F.array_join(said, "; ")).alias("c"))
    return notes.select("doc_id", F.explode("c.raw").alias("raw"))


@query("key_to_ref", with_("idx") + "SELECT DISTINCT key, CASE WHEN len(string_split(key, '/')) = 3 THEN split_part(key, '/', 1) || ' ' || split_part(key, '/', 2) || ':' || split_part(key, '/', 3) ELSE key END AS shown FROM idx")
def key_to_ref(t):
    from ..operators.graph import inverted_index

    return inverted_index(t.articles, ("id",)).select("key").distinct().withColumn("shown", refs.key_to_ref(F.col("key")))


@query("father_verse_ref", with_("per") + "SELECT id, key, upper(slug[1:1]) || slug[2:] || ' ' || split_part(key, '/', 2) || ':' || split_part(key, '/', 3) AS shown FROM (SELECT id, slug, unnest(keys) AS key FROM per)")
def father_verse_ref(t):
    return t.pericopes.select("id", each("commented_verse_keys").alias("key")).withColumn(
        "shown", refs.father_verse_ref(F.col("key"))
    )


@query("part_of", "SELECT source AS raw, coalesce(string_split(id, '.')[3], '') AS part, count(*) AS n FROM (SELECT source, CASE WHEN lang = 'en' THEN source || '.st.' || lang || '.q1' ELSE source END AS id FROM documents) GROUP BY 1, 2")
def part_of(t):
    ident = F.when(F.col("lang") == "en", F.concat("source", F.lit(".st."), "lang", F.lit(".q1"))).otherwise(F.col("source"))
    rows = t.documents.select(F.col("source").alias("raw"), refs.part_of(ident).alias("part"))
    return rows.groupBy("raw", "part").agg(F.count("*").alias("n"))


@query("verse_level_only", with_("idx") + "SELECT key, count(*) AS n FROM idx WHERE length(key) - length(replace(key, '/', '')) = 2 GROUP BY 1")
def verse_level_only(t):
    from ..operators.graph import inverted_index

    rows = inverted_index(t.articles, ("id",)).filter(refs.is_verse_key(F.col("key")))
    return rows.groupBy("key").agg(F.count("*").alias("n"))


@query("kind_filter", with_("cit") + "SELECT doc_id, count(*) FILTER (WHERE kind = 'scripture') AS n FROM cit GROUP BY 1")
def kind_filter(t):
    kept = F.filter("citations_out", lambda c: c["kind"] == "scripture")
    return t.articles.select("doc_id", F.size(kept).cast("long").alias("n"))


@query("gospel_filter", with_("idx") + "SELECT id, key FROM idx WHERE split_part(key, '/', 1) IN ('matthew', 'mark', 'luke', 'john')")
def gospel_filter(t):
    from ..operators.graph import inverted_index

    return inverted_index(t.articles, ("id",)).filter(refs.in_gospels(F.col("key"))).select("id", "key")


@query("union_keys", with_("scr") + "SELECT id, pos, array_to_string(list_sort(list_distinct(list_append(verse_keys, chapter_key))), ' ') AS keys FROM scr WHERE ok")
def union_keys(t):
    cites = scripture_citations(t.articles).filter(F.col("norm").isNotNull())
    return cites.select("id", "pos", F.array_join(F.sort_array(refs.union_keys(F.col("norm"))), " ").alias("keys"))


# --- vectors ---------------------------------------------------------------------


@query(
    "l2_normalize",
    """SELECT vec_id, CAST(k - 1 AS INT) AS dim, round(CAST(x AS DOUBLE) * 3 / (3 * n), 6) AS x FROM (
      SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS k,
             sqrt(list_sum(list_transform(embedding, lambda e: CAST(e AS DOUBLE) * CAST(e AS DOUBLE)))) AS n FROM embeddings)""",
)
def l2_normalize(t):
    tripled = F.transform("embedding", lambda x: x.cast("double") * 3)
    unit = t.embeddings.select("vec_id", F.posexplode(vectors.l2_normalize(tripled)).alias("dim", "x"))
    return unit.withColumn("x", F.round("x", 6))


@query(
    "dot_product",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda e, i: CAST(e AS DOUBLE) * CAST(embedding[65 - i] AS DOUBLE))), 6) AS dot FROM embeddings""",
)
def dot_product(t):
    return t.embeddings.select(
        "vec_id", F.round(vectors.dot_product(F.col("embedding"), F.reverse("embedding")), 6).alias("dot")
    )


# --- parsing ---------------------------------------------------------------------

SECTIONED = (
    f"SELECT doc_id, i, L, line, {oracle.pick(['Genesis', '3 Kings', 'Canticle of Canticles', 'Nowhere'], 'doc_id + i')} AS nm, i // 4 + 1 AS ch, "
    "i % 4 = 0 AS head FROM lin"
)


def edition(t):
    """Each document as a plain-text edition: a header line every fourth line, then
    verses, notes and wrapped lines."""
    def write(l, i):
        names = pick(["Genesis", "3 Kings", "Canticle of Canticles", "Nowhere"], F.col("doc_id") + i)
        chapter = corpus.text_of(F.floor(i / 4) + 1)
        header = F.concat(F.lit("\n\n\n"), names, F.lit(" Chapter "), chapter, F.lit("\n\n\nSummary, not a verse.\n\n\n"))
        marker = F.concat(chapter, F.lit(":"), corpus.text_of(F.pmod(F.length(l), F.lit(4)) + 1), F.lit("."))
        half = F.floor(F.length(l) / 2).cast("int")
        wrapped = F.concat(F.rtrim(l.substr(F.lit(1), half)), F.lit("\n\n"), l.substr(half + 1, F.length(l)))
        return F.concat(F.when(F.pmod(i, F.lit(4)) == 0, header).otherwise("\n\n\n"), marker, F.lit(" "), wrapped)

    return t.doc_lines.select("doc_id", F.concat(F.lit("front matter\n"), F.array_join(F.transform("lines", write), "")).alias("text"))


@query(
    "section_slices",
    with_("lin") + f"SELECT doc_id, nm || ' Chapter ' || ch AS header, count(*) AS n FROM ({SECTIONED}) WHERE head GROUP BY 1, 2",
)
def section_slices(t):
    rows = edition(t).select("doc_id", F.explode(parse.section_slices(F.col("text"))).alias("s"))
    header = F.split_part("s", F.lit("\n"), F.lit(1))
    return rows.groupBy("doc_id", header.alias("header")).agg(F.count("*").alias("n"))


_WRAP = collapse("rtrim(line[1:L // 2]) || ' ' || line[L // 2 + 1:]")


@query(
    "paragraph_grouping",
    with_("lin")
    + f"""SELECT doc_id, CAST(p AS INT) AS pos, regexp_replace(para, '\\s+', ' ', 'g') AS para FROM (
      SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, o) - 1 AS p, para FROM (
        SELECT doc_id, -1 AS i, 0 AS o, 'front matter' AS para FROM documents UNION ALL
        SELECT doc_id, i, 1, nm || ' Chapter ' || ch FROM ({SECTIONED}) WHERE head UNION ALL
        SELECT doc_id, i, 2, 'Summary, not a verse.' FROM ({SECTIONED}) WHERE head UNION ALL
        SELECT doc_id, i, 3, trim(ch || ':' || (L % 4 + 1) || '. ' || rtrim(line[1:L // 2])) || ' ' || ltrim(line[L // 2 + 1:]) FROM ({SECTIONED})))""",
)
def paragraph_grouping(t):
    rows = edition(t).select("doc_id", F.posexplode(parse.paragraph_grouping(F.col("text"))).alias("pos", "para"))
    return rows.withColumn("para", F.regexp_replace("para", r"\s+", " "))


_PRINTED_NO = "(i * 2) // 3 % 6 + 1"


@query(
    "renumber_restarts",
    with_("lin").replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", p AS (SELECT doc_id, i, line, CAST({_PRINTED_NO} AS INT) AS printed FROM lin),
    f AS (SELECT doc_id, i, printed AS top, line FROM p WHERE i = 0
      UNION ALL SELECT p.doc_id, p.i, CASE WHEN p.printed > f.top THEN p.printed WHEN p.printed = f.top THEN f.top ELSE f.top + 1 END, p.line
      FROM f JOIN p ON p.doc_id = f.doc_id AND p.i = f.i + 1)
    SELECT doc_id, CAST(top AS INT) AS verse, string_agg(line, ' ' ORDER BY i) AS text FROM f GROUP BY 1, 2""",
)
def renumber_restarts(t):
    items = F.transform(
        "lines", lambda l, i: F.struct((F.pmod(F.floor(i * 2 / 3), F.lit(6)) + 1).cast("int").alias("printed"), l.alias("text"))
    )
    rows = t.doc_lines.select("doc_id", F.explode(parse.renumber_restarts(items)).alias("v"))
    return rows.select("doc_id", "v.verse", "v.text")


#: Printed and given numbers by a recursive query over ``lin``, and what is noted on them.
NUMBERED = f"""p AS (SELECT doc_id, i, CAST({_PRINTED_NO} AS INT) AS printed FROM lin),
    f AS (SELECT doc_id, i, printed, 0 AS reached, printed AS top FROM p WHERE i = 0
      UNION ALL SELECT p.doc_id, p.i, p.printed, f.top, CASE WHEN p.printed > f.top THEN p.printed WHEN p.printed = f.top THEN f.top ELSE f.top + 1 END
      FROM f JOIN p ON p.doc_id = f.doc_id AND p.i = f.i + 1),
    notes AS (SELECT doc_id, CASE WHEN printed = reached THEN 'merged' ELSE 'continued' END AS kind, printed, top AS verse FROM f WHERE printed = reached OR (printed = 1 AND reached > 1))"""


def numbering_notes(t):
    """Notes on the documents' lines as a chapter whose printed numbers repeat and restart."""
    items = F.transform("lines", lambda l, i: F.struct((F.pmod(F.floor(i * 2 / 3), F.lit(6)) + 1).cast("int").alias("printed")))
    rows = t.doc_lines.select("doc_id", F.explode(parse.numbering_anomalies(items)).alias("a"))
    return rows.select("doc_id", "a.kind", "a.printed", "a.verse")


@query(
    "numbering_anomalies",
    with_("lin").replace("WITH ", "WITH RECURSIVE ", 1) + ", " + NUMBERED + " SELECT doc_id, kind, printed, CAST(verse AS INT) AS verse FROM notes",
)
def numbering_anomalies(t):
    return numbering_notes(t)


@query(
    "attach_continuation",
    with_("lin")
    + """, g AS (SELECT doc_id, i, line, L % 3 = 0 AS head, sum(CASE WHEN L % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM lin)
    SELECT doc_id, CAST(grp AS INT) AS pos, CASE WHEN grp = 0 THEN NULL ELSE 'F' || min(i) END AS father,
      CASE WHEN grp = 0 THEN trim(string_agg(line, ' ' ORDER BY i)) ELSE string_agg(line, chr(10) || chr(10) ORDER BY i) END AS text FROM g GROUP BY doc_id, grp""",
)
def attach_continuation(t):
    paragraphs = F.transform(
        "lines",
        lambda l, i: F.struct(
            F.when(F.length(l) % 3 == 0, F.concat(F.lit("F"), corpus.text_of(i))).alias("father"), l.alias("text")
        ),
    )
    rows = t.doc_lines.select("doc_id", parse.attach_continuation(paragraphs).alias("a"))
    lemma = rows.select("doc_id", F.lit(0).alias("pos"), F.lit(None).cast("string").alias("father"), F.col("a.lemma").alias("text"))
    frags = rows.select("doc_id", F.posexplode("a.segments").alias("p", "s")).select("doc_id", (F.col("p") + 1).alias("pos"), "s.father", "s.text")
    return lemma.filter(F.col("text") != "").unionByName(frags)


_FOLD = """, e AS (SELECT doc_id, i, line, (L + i) % 3 = 0 AS head FROM lin),
  b AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS blk FROM e),
  h AS (SELECT *, max(CASE WHEN head THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, blk) = 1 AND blk > 0 AS body FROM b),
  n AS (SELECT *, sum(CASE WHEN head AND body THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS done,
           sum(CASE WHEN head AND body THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS total FROM h),
  a AS (SELECT *, CASE WHEN body THEN done WHEN done < total THEN done + 1 ELSE total END AS idx FROM n WHERE total > 0)"""


@query(
    "pending_heading_fold",
    with_("lin")
    + _FOLD
    + """ SELECT doc_id, CAST(idx AS INT) AS idx, max(line) FILTER (WHERE head AND body) AS title,
      string_agg(CASE WHEN head OR blk = 0 THEN 'heading: ' ELSE 'paragraph: ' END || line, chr(10) ORDER BY i) FILTER (WHERE NOT (head AND body)) AS segments
      FROM a GROUP BY doc_id, idx""",
)
def pending_heading_fold(t):
    elements = F.transform(
        "lines", lambda l, i: F.struct(F.when((F.length(l) + i) % 3 == 0, "h3").otherwise("p").alias("tag"), l.alias("text"))
    )
    rows = t.doc_lines.select("doc_id", F.explode(parse.pending_heading_fold(elements)).alias("u"))
    said = F.transform("u.segments", lambda s: F.concat(s["role"], F.lit(": "), s["text"]))
    return rows.select("doc_id", "u.idx", "u.title", F.array_join(said, "\n").alias("segments"))


@query(
    "page_to_nodes",
    f"""WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<p\\b[^>]*>(.*?)</p>', 1)) AS x, generate_subscripts(regexp_extract_all(html, '(?is)<p\\b[^>]*>(.*?)</p>', 1), 1) AS k,
        {sql_html_to_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS h FROM pages),
      q AS (SELECT page_id, k, h, {sql_html_to_text('x')} AS plain FROM p)
    SELECT 'summa.st.' || {oracle.pick([p[0] for p in canon.PARTS], 'page_id')} || '.q' || (page_id + 1) || '.a1' AS id,
      'ST ' || {oracle.pick([p[1] for p in canon.PARTS], 'page_id')} || ', q.' || (page_id + 1) || ', a.1' AS citation, 'Whether ' || page_id AS title,
      any_value('Question ' || (page_id + 1) || ': ' || h) AS path_question, string_agg(plain, chr(10) || chr(10) ORDER BY k) AS text,
      count(*) AS n_segments FROM q WHERE plain <> '' GROUP BY page_id""",
)
def page_to_nodes(t):
    return parse.page_to_nodes(_question_pages(t)).select(
        "id", "citation", "title", F.element_at("path", 2).alias("path_question"), "text",
        F.size("segments").cast("long").alias("n_segments"),
    )


def _question_pages(t):
    """Pages rebuilt as question pages of one article."""
    number = corpus.text_of(F.col("page_id") + 1)
    head = F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    body = F.regexp_replace("html", r"(?is)^.*?<article>", "")
    rebuilt = F.concat(
        F.lit("<h1>Question "), number, F.lit(". "), head, F.lit('</h1><h2 id="article1">Article 1. Whether '),
        corpus.text_of(F.col("page_id")), F.lit("</h2>"), body,
    )
    part = (F.pmod("page_id", F.lit(5)) + 1).cast("int").alias("part")
    return t.pages.select("page_id", "url", part, rebuilt.alias("html"))


@query(
    "node_provenance",
    f"""WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<p\\b[^>]*>(.*?)</p>', 1)) AS x FROM pages),
      q AS (SELECT DISTINCT page_id FROM (SELECT page_id, {sql_html_to_text('x')} AS plain FROM p) WHERE plain <> '')
    SELECT 'summa.st.' || {oracle.pick([p[0] for p in canon.PARTS], 'page_id')} || '.q' || (page_id + 1) || '.a1' AS id, url, 'public domain' AS license, CAST(NULL AS VARCHAR) AS translator
    FROM pages JOIN q USING (page_id)""",
)
def node_provenance(t):
    """Where nodes come from; none of them breaks the rule that a license is named."""
    nodes = parse.sourced(parse.page_to_nodes(_question_pages(t)), url=F.col("url"), license="public domain", edition="pages")
    unnamed = quality.license_present(nodes, F.col("source.license"))
    held = nodes.join(unnamed.select("id"), "id", "left_anti")
    return held.select("id", F.col("source.url").alias("url"), F.col("source.license").alias("license"), F.col("source.translator").alias("translator"))


@query(
    "pericope_pages",
    with_("per", "lin")
    + f"""SELECT per.doc_id, 'chain.' || slug || '.' || ch || '.' || v1 AS id, citation, 'Lemma of ' || per.doc_id AS lemma, CAST(len(keys) AS INTEGER) AS n_keys,
      CAST(count(*) AS INTEGER) AS n_segments, string_agg({collapse('line')}, chr(10) || chr(10) ORDER BY i) AS text
    FROM per JOIN lin USING (doc_id) GROUP BY per.doc_id, slug, ch, v1, citation, keys""",
)
def pericope_pages(t):
    """Documents as commentary pages of one section, a named fragment a line."""
    label = F.regexp_extract("citation", r" ([0-9]+:[0-9]+(?:-[0-9]+)?)$", 1)
    fragments = F.transform("segments", lambda s: F.concat(F.lit("<p><strong>Bede</strong> "), text.escape_html(s["text"]), F.lit("</p>")))
    html = F.concat(
        F.lit('<h3 id="v"><a href="/bible/book.shtml#v">'), label, F.lit("</a></h3><p>Lemma of "), corpus.text_of(F.col("doc_id")),
        F.lit("</p>"), F.array_join(fragments, ""),
    )
    chapter = F.regexp_extract("citation", r" ([0-9]+):", 1).cast("int")
    pages = t.pericopes.select("doc_id", "slug", chapter.alias("chapter"), html.alias("html"))
    nodes = parse.pericope_pages(pages, "golden-chain", "Golden Chain", "chain")
    return nodes.select(
        "doc_id", "id", "citation", "lemma", F.size("commented_verse_keys").alias("n_keys"), F.size("segments").alias("n_segments"), "text"
    )
