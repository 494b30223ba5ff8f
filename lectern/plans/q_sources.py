"""Queries that write a corpus format to the shared folder and read it back."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import canon
from ..functions.columns import each_at
from ..operators import graph, parse, project
from ..session import discard, lean, new_path, settle
from ..sources import halves, readers, writers
from . import build, corpus
from .oracle import collapse, with_
from .q_text import NUMBERED, SECTIONED, numbering_notes
from .q_text import edition as t_edition
from .registry import query

_NODE_COLS = ["id", "citation", "title", "type", "text", "segments", "citations_out"]


def _landed_articles(t):
    """Article nodes as JSON lines, one folder per part; documents in one language have
    no type and those in another are commentary."""
    kind = F.when(F.col("lang") == "de", "father-comment").when(F.col("lang") == "fr", "verse").when(F.col("lang") == "en", "article")
    path = new_path(t.spark, "nodes")
    nodes = t.articles.withColumn("type", kind).withColumn("part", F.split_part("id", F.lit("."), F.lit(3)))
    writers.sink_jsonl_partitioned(nodes.select("part", *_NODE_COLS), path, "part", ["id"])
    return path


@query(
    "scan_jsonl",
    with_("art", "lin") + "SELECT id, citation, title, length(text) AS n_chars, (SELECT count(*) FROM lin WHERE lin.doc_id = art.doc_id) AS n_segments FROM art",
)
def scan_jsonl(t):
    nodes = readers.scan_jsonl(t.spark, _landed_articles(t))
    return nodes.select("id", "citation", "title", F.length("text").cast("long").alias("n_chars"), F.size("segments").cast("long").alias("n_segments"))


@query("scan_jsonl_filtered", with_("art") + "SELECT id, CASE lang WHEN 'en' THEN 'article' END AS type FROM art WHERE lang NOT IN ('de', 'fr')")
def scan_jsonl_filtered(t):
    return readers.scan_jsonl_filtered(t.spark, _landed_articles(t)).select("id", "type")


@query("sink_jsonl_partitioned", with_("art") + "SELECT slug AS part, count(*) AS nodes, count(DISTINCT q) AS questions FROM art GROUP BY 1")
def sink_jsonl_partitioned(t):
    landed = readers.scan_jsonl(t.spark, _landed_articles(t), "id string, part string")
    each = landed.groupBy("part", F.split_part("id", F.lit("."), F.lit(4)).alias("q")).agg(F.count("*").alias("n"))
    return each.groupBy("part").agg(F.sum("n").cast("long").alias("nodes"), F.count("*").alias("questions"))


def _landed_adjacency(t, whole=False):
    path = new_path(t.spark, "adjacency")
    with lean(t.spark):
        index = settle(graph.inverted_index(t.articles), "index")
        writers.sink_adjacency(index, path, "key", ["id", "citation", "title", "ref"], 10, whole)
        discard(index)
    return path


_ADJACENCY = with_("idx") + "SELECT key, row_number() OVER (PARTITION BY key ORDER BY id, citation, title, ref) - 1 AS pos, id, citation, title, ref FROM idx"


@query("scan_adjacency", _ADJACENCY)
def scan_adjacency(t):
    return readers.scan_adjacency(t.spark, _landed_adjacency(t))


@query("scan_adjacency_object", _ADJACENCY)
def scan_adjacency_object(t):
    """Files of one object each, read in splits."""
    return readers.scan_adjacency(t.spark, _landed_adjacency(t, True), whole=True)


@query(
    "sink_adjacency",
    with_("idx") + "SELECT key, CAST(count(*) AS BIGINT) AS entries, string_agg(id, ' ' ORDER BY id, citation, title, ref) AS ids FROM idx GROUP BY 1",
)
def sink_adjacency(t):
    rows = readers.scan_adjacency(t.spark, _landed_adjacency(t))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]), " ")
    return rows.groupBy("key").agg(F.count("*").alias("entries"), ids.alias("ids"))


@query(
    "scan_html_pages",
    "SELECT page_id, html || CASE WHEN page_id % 10 = 3 THEN chr(65533) || '!' ELSE '' END || chr(10) AS html FROM pages",
)
def scan_html_pages(t):
    """Pages as files of their own, some with a byte that is no UTF-8."""
    path = new_path(t.spark, "pages")
    tail = F.when(F.col("page_id") % 10 == 3, F.unhex(F.lit("FF21"))).otherwise(F.unhex(F.lit("")))
    writers.sink_pages(t.pages.select("page_id", F.concat(F.encode("html", "UTF-8"), tail).alias("value")), path)
    page = F.regexp_extract("url", r"page_id=([0-9]+)", 1).cast("long")
    return readers.scan_html_pages(t.spark, path, "*.txt").select(page.alias("page_id"), "html")


_SEPARATOR = "\n=====\n"


@query("scan_wholetext", "SELECT text FROM documents")
def scan_wholetext(t):
    path = new_path(t.spark, "texts")
    t.documents.select(F.concat("text", F.lit(_SEPARATOR[:-1])).alias("value")).write.text(path)
    return readers.scan_wholetext(t.spark, path, _SEPARATOR)


@query(
    "scan_cp1252",
    with_("lat") + "SELECT id, citation, text, latin_book FROM (SELECT id, citation, text, slug AS latin_book FROM lat)",
)
def scan_cp1252(t):
    path = new_path(t.spark, "latin")
    line = F.concat(corpus.text_of(F.col("chapter")), F.lit(":"), corpus.text_of(F.col("verse")), F.lit(" "), F.replace("raw", F.lit("\n"), F.lit(" ")))
    rows = t.latin_raw.select("slug", line.alias("value"))
    (
        rows.write.partitionBy("slug").option("encoding", "ISO-8859-1").option("sep", "\x01").option("quote", "").option("escape", "\x01")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    )
    slug = F.regexp_extract("path", "slug=([^/]+)", 1)
    landed = readers.scan_cp1252(t.spark, path).withColumn("slug", slug).withColumn("latin_book", slug)
    return parse.parse_latin(landed).select("id", "citation", "text", "latin_book")


def _edition_sql() -> str:
    """Chapters of the documents as an edition, and their verses' given numbers, by a recursive query."""
    slugs = {n: canon.ALIASES.get(re.sub(r"[\s.]", "", canon.PRINTED_TITLES.get(n, n).lower())) for n in ("Genesis", "3 Kings", "Canticle of Canticles", "Nowhere")}
    slug = "CASE nm " + " ".join(f"WHEN '{n}' THEN '{s}'" for n, s in slugs.items() if s) + " END"
    text = collapse("rtrim(line[1:L // 2]) || ' ' || ltrim(line[L // 2 + 1:])")
    return f"""g AS (SELECT doc_id, i, i // 4 AS sec, L % 4 + 1 AS printed, {text} AS text FROM lin),
    h AS (SELECT doc_id, i // 4 AS sec, ch AS chapter, {slug} AS slug FROM ({SECTIONED}) WHERE head),
    f AS (SELECT doc_id, sec, i, printed, 0 AS reached, printed AS top, text FROM g WHERE i % 4 = 0
      UNION ALL SELECT g.doc_id, g.sec, g.i, g.printed, f.top, CASE WHEN g.printed > f.top THEN g.printed WHEN g.printed = f.top THEN f.top ELSE f.top + 1 END, g.text
      FROM f JOIN g ON g.doc_id = f.doc_id AND g.sec = f.sec AND g.i = f.i + 1)"""


def _landed_edition(t):
    path = new_path(t.spark, "edition")
    t_edition(t).select(F.concat(F.lit("\n\n\n"), "text").alias("value")).write.text(path)
    return path


@query(
    "parse_edition_lines",
    with_("lin").replace("WITH ", "WITH RECURSIVE ", 1) + ", " + _edition_sql()
    + """ SELECT slug, CAST(chapter AS INT) AS chapter, CAST(top AS INT) AS verse, string_agg(text, ' ' ORDER BY i) AS text
    FROM f JOIN h USING (doc_id, sec) WHERE slug IS NOT NULL GROUP BY doc_id, sec, slug, chapter, top""",
)
def parse_edition_lines(t):
    """Files of many documents' chapters, read line by line."""
    return parse.parse_edition_lines(readers.scan_lines(t.spark, _landed_edition(t))).select("slug", "chapter", "verse", "text")


@query(
    "edition_anomalies",
    with_("lin").replace("WITH ", "WITH RECURSIVE ", 1) + ", " + _edition_sql()
    + """ SELECT slug, CAST(chapter AS INT) AS chapter, CASE WHEN printed = reached THEN 'merged' ELSE 'continued' END AS kind, CAST(printed AS INT) AS printed, CAST(top AS INT) AS verse
    FROM f JOIN h USING (doc_id, sec) WHERE slug IS NOT NULL AND (printed = reached OR (printed = 1 AND reached > 1))""",
)
def edition_anomalies(t):
    return parse.edition_lines_anomalies(readers.scan_lines(t.spark, _landed_edition(t)))


# A half-precision value: the nearest multiple of its binade's spacing, ties to even.
_F16 = "CASE WHEN x = 0 THEN 0 ELSE round_even(x / u, 0) * u END"
_F16_ROWS = f"""SELECT vec_id, d, {_F16} AS x FROM (SELECT *, pow(2, greatest(floor(log2(abs(x))), -14) - 10) AS u FROM (
    SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM (
      SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda w: CAST(w AS DOUBLE) * CAST(w AS DOUBLE))))) AS e FROM embeddings)))"""


def _landed_vectors(t):
    path = new_path(t.spark, "vectors")
    halves.sink(t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), path)
    return path


@query("scan_f16_vectors", f"SELECT vec_id AS id, CAST(d - 1 AS INT) AS dim, round(x, 6) AS x FROM ({_F16_ROWS})")
def scan_f16_vectors(t):
    """Bare half-precision files read by byte ranges."""
    rows = halves.scan(t.spark, _landed_vectors(t))
    return rows.select("id", each_at("vector").alias("dim", "x")).withColumn("x", F.round(F.col("x").cast("double"), 6))


@query("sink_vectors", f"SELECT vec_id AS id, count(*) AS dims, round(sum(x * x), 6) AS square FROM ({_F16_ROWS}) GROUP BY 1")
def sink_vectors(t):
    rows = halves.scan(t.spark, _landed_vectors(t)).select("id", each_at("vector").alias("dim", "x"))
    x = F.col("x").cast("double")
    return rows.groupBy("id").agg(F.count("*").alias("dims"), F.round(F.sum(x * x), 6).alias("square"))


@query(
    "scan_verse_map",
    with_("eng")
    + """SELECT verse_key, CASE WHEN verse % 7 = 0 THEN 'again.' || id ELSE id END AS id, CASE WHEN verse % 7 = 0 THEN 'Later: ' || text ELSE text END AS text,
      citation, book, chapter, verse FROM eng""",
)
def scan_verse_map(t):
    """Some verses stand in a later file once more, with an id that sorts first."""
    path = new_path(t.spark, "verse-files")
    held = t.english.select("id", "text", "citation", "book", "chapter", "verse", "verse_key")
    held.write.json(f"{path}/1-first")
    again = held.filter("verse % 7 = 0").withColumns({"id": F.concat(F.lit("again."), "id"), "text": F.concat(F.lit("Later: "), "text")})
    again.write.json(f"{path}/2-later")
    return readers.scan_verse_map(t.spark, [f"{path}/1-first", f"{path}/2-later"])


@query("scan_lectionary", with_("read") + "SELECT CAST(date AS VARCHAR) AS date, gospel, 'Day ' || date AS day FROM read")
def scan_lectionary(t):
    path = new_path(t.spark, "lectionary")
    day = F.col("date").cast("string")
    writers.sink_keyed(t.readings, day, F.struct("gospel", F.concat(F.lit("Day "), day).alias("day")), path)
    return readers.scan_lectionary(t.spark, path).withColumn("date", F.col("date").cast("string"))


_TOP = "SELECT string_agg(name || ' ' || n, '; ' ORDER BY n DESC, key) FROM (SELECT *, row_number() OVER (ORDER BY n DESC, key) AS place FROM ({})) WHERE place <= {}"
_SHOWN = "CASE WHEN len(string_split(key, '/')) = 3 THEN split_part(key, '/', 1) || ' ' || split_part(key, '/', 2) || ':' || split_part(key, '/', 3) ELSE key END"


@query(
    "sink_stats",
    with_("art", "norm", "inl", "res", "idx", "vkey")
    + f"""SELECT (SELECT count(*) FROM art) AS articles, n AS scripture_citations_total, p AS scripture_citations_parsed, round(p / n, 4) AS parse_rate, n - p AS unparsed_count,
      it AS internal_refs_total, ir AS internal_refs_resolved, round(ir / it, 4) AS internal_resolve_rate,
      (SELECT count(DISTINCT key) FROM idx WHERE len(string_split(key, '/')) = 3) AS unique_verse_keys,
      (SELECT count(DISTINCT key) FROM idx WHERE len(string_split(key, '/')) = 2) AS unique_chapter_keys,
      ({_TOP.format("SELECT book AS key, book AS name, count(*) AS n FROM norm WHERE ok GROUP BY 1", 20)}) AS books,
      ({_TOP.format(f"SELECT key, {_SHOWN} AS name, count(*) AS n FROM vkey GROUP BY 1", 25)}) AS verses,
      ({_TOP.format("SELECT raw AS key, raw AS name, count(*) AS n FROM norm WHERE NOT ok GROUP BY 1", 20)}) AS unparsed,
      ({_TOP.format("SELECT dst AS key, any_value(art.citation) AS name, count(*) AS n FROM res JOIN art ON art.id = dst GROUP BY 1", 20)}) AS cited
    FROM (SELECT (SELECT count(*) FROM norm) AS n, (SELECT count(*) FROM norm WHERE ok) AS p, (SELECT count(*) FROM inl) AS it, (SELECT count(*) FROM res) AS ir)""",
)
def sink_stats(t):
    """The whole statistics object of the graph job, written and read back."""
    path = new_path(t.spark, "graph")
    stats = build.build_graph(t.articles.withColumn("text", F.col("noted_text")), f"{path}/tables")["stats"]
    writers.sink_stats(stats, f"{path}/stats")
    held = t.spark.read.schema(stats.schema).json(f"{path}/stats")
    said = lambda column, name: F.array_join(F.transform(column, lambda x: F.concat_ws(" ", x[name], x["in_degree" if name == "citation" else "n"].cast("string"))), "; ")
    return held.select(
        "articles", "scripture_citations_total", "scripture_citations_parsed", "parse_rate", "unparsed_count",
        "internal_refs_total", "internal_refs_resolved", "internal_resolve_rate", "unique_verse_keys", "unique_chapter_keys",
        said("most_cited_books", "book").alias("books"), said("most_cited_verses", "ref").alias("verses"),
        said("unparsed_top", "raw").alias("unparsed"), said("most_cited_articles", "citation").alias("cited"),
    )


_CANON = ", ".join(f"('{slug}', {i}, '{'New' if slug in canon.NEW_TESTAMENT else 'Old'} Testament')" for i, slug in enumerate(canon.BOOK_SLUGS))


@query(
    "sink_manifest",
    with_("lat", "eng", "idx", "lin").replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", canon(slug, pos, testament) AS (VALUES {_CANON}), {NUMBERED},
    ke AS (SELECT DISTINCT verse_key FROM eng), kl AS (SELECT DISTINCT verse_key FROM lat), kc AS (SELECT DISTINCT key FROM idx WHERE len(string_split(key, '/')) = 3),
    bk AS (SELECT slug, count(DISTINCT chapter) AS c, count(*) AS v FROM lat GROUP BY 1),
    n AS (SELECT (SELECT count(*) FROM kl SEMI JOIN ke USING (verse_key)) AS shared, (SELECT count(*) FROM ke) AS right_keys, (SELECT count(*) FROM kl) AS left_keys,
      (SELECT count(*) FROM kc) AS cited, (SELECT count(*) FROM kc WHERE key IN (SELECT verse_key FROM kl)) AS resolved)
    SELECT 'clementine-vulgate' AS work, 'Latin' AS language, (SELECT count(*) FROM bk) AS books, (SELECT CAST(sum(c) AS BIGINT) FROM bk) AS chapters, (SELECT CAST(sum(v) AS BIGINT) FROM bk) AS verses,
      shared, left_keys - shared AS only_here, right_keys - shared AS only_there, round(shared / right_keys, 4) AS parallel_rate, cited, resolved, round(resolved / cited, 4) AS citation_rate,
      (SELECT count(*) FROM notes WHERE kind = 'merged') AS merged, (SELECT count(*) FROM notes WHERE kind = 'continued') AS continued,
      (SELECT string_agg(slug || ' ' || c || ' ' || v || ' ' || testament, '; ' ORDER BY pos) FROM bk JOIN canon USING (slug)) AS by_book FROM n""",
)
def sink_manifest(t):
    path = new_path(t.spark, "edition")
    index = graph.inverted_index(t.articles, ("id",))
    build.export_edition_manifest(path, t.latin, t.english, index, numbering_notes(t), work="clementine-vulgate", language="Latin")
    schema = """work string, language string, counts struct<books:long,chapters:long,verses:long>, parallel_coverage struct<shared:long,only_here:long,only_there:long,rate:double>,
      citation_graph_coverage struct<cited:long,resolved:long,rate:double>, by_book array<struct<slug:string,chapters:long,verses:long,testament:string>>"""
    held = t.spark.read.schema(schema).json(f"{path}/manifest")
    kinds = t.spark.read.schema("kind string").json(f"{path}/numbering").groupBy("kind").agg(F.count("*").alias("n"))
    noted = lambda kind: F.coalesce(kinds.where(F.col("kind") == kind).select("n").scalar(), F.lit(0).cast("long")).alias(kind)
    book = F.transform("by_book", lambda b: F.concat_ws(" ", b["slug"], b["chapters"].cast("string"), b["verses"].cast("string"), b["testament"]))
    return held.select(
        "work", "language", "counts.*", "parallel_coverage.shared", "parallel_coverage.only_here", "parallel_coverage.only_there",
        F.col("parallel_coverage.rate").alias("parallel_rate"), "citation_graph_coverage.cited", "citation_graph_coverage.resolved",
        F.col("citation_graph_coverage.rate").alias("citation_rate"), noted("merged"), noted("continued"), F.array_join(book, "; ").alias("by_book"),
    )


@query(
    "export_bundle",
    with_("art", "eng", "lat", "idx", "res", "per")
    + """SELECT 'articles' AS subset, count(*) AS rows FROM art UNION ALL SELECT 'english', count(*) FROM eng UNION ALL SELECT 'latin', count(*) FROM lat
    UNION ALL SELECT 'scripture_edges', count(*) FROM idx WHERE len(string_split(key, '/')) = 3 UNION ALL SELECT 'internal_edges', count(*) FROM res
    UNION ALL SELECT 'teaching', count(*) FROM art UNION ALL SELECT 'pericopes', count(*) FROM per UNION ALL SELECT 'father_edges', CAST(sum(len(keys)) AS BIGINT) FROM per""",
)
def export_bundle(t):
    plain = F.struct(F.lit(None).cast("string").alias("license"))
    sourced = lambda df: df.withColumn("source", plain).withColumn("work", F.lit(None).cast("string"))
    with lean(t.spark):
        # Only what the subsets have: segments would be classified line by line for nothing.
        articles = settle(t.articles.select("id", "citation", "title", "text", "noted_text", "citations_out"), "articles")
        noted = settle(graph.internal_edges(articles, "noted_text"), "noted")
    edges = graph.internal_resolve(noted, articles)
    # Those that are made of the stored articles come first, so that the others don't stand beside them.
    subsets = {
        "scripture_edges": project.scripture_edges(graph.inverted_index(articles)),
        "internal_edges": project.internal_edge_rows(graph.edges_to_meta(edges, articles)),
        "articles": project.project_article(sourced(articles)),
        "teaching": project.project_catechism(sourced(articles).withColumn("path", F.array(F.lit("Work"), F.lit("Part")))),
        "english": project.project_verse(sourced(t.english)),
        "latin": project.project_verse(sourced(t.latin), latin=True),
        "pericopes": project.project_pericope(sourced(t.pericopes)),
        "father_edges": project.father_edges(t.pericopes),
    }
    return writers.export_bundle(subsets, new_path(t.spark, "bundle"), {"teaching": [articles, noted]})


_GOSPELS = ", ".join(f"'{g}'" for g in canon.GOSPELS)


@query(
    "export_browser_bundle",
    with_("art", "eng", "lat", "per", "idx", "res", "scr", "fidx", "read", "alias", "norm", "vkey")
    + f""", tea AS ({corpus.TEACHING_SQL}),
    vs AS (SELECT key FROM idx WHERE len(string_split(key, '/')) = 3 UNION SELECT verse_key FROM eng WHERE slug IN ({_GOSPELS}))
    SELECT 'core/articles' AS part, count(*) AS rows, CAST(sum(length(id) + length(citation) + length(title)) AS BIGINT) AS chars FROM (SELECT id, citation, title FROM art UNION ALL SELECT id, citation, title FROM tea)
    UNION ALL SELECT 'core/verses', count(*), CAST(sum(length(coalesce(eng.text, '')) + length(coalesce(lat.text, ''))) AS BIGINT) FROM vs LEFT JOIN eng ON eng.verse_key = key LEFT JOIN lat ON lat.verse_key = key
    UNION ALL SELECT 'core/scripture_index', count(*), CAST(sum(length(key) + length(id) + length(ref)) AS BIGINT) FROM idx
    UNION ALL SELECT 'core/internal_refs', count(*), CAST(sum(length(src) + length(dst)) AS BIGINT) FROM res
    UNION ALL SELECT 'core/internal_cited_by', count(*), CAST(sum(length(src) + length(dst)) AS BIGINT) FROM res
    UNION ALL SELECT 'core/article_refs', count(DISTINCT id), CAST(sum(length(ref)) AS BIGINT) FROM (SELECT DISTINCT id, ref FROM scr WHERE ok)
    UNION ALL SELECT 'core/fathers_index', count(*), CAST(sum(length(key) + length(id) + length(father_summary)) AS BIGINT) FROM fidx
    UNION ALL SELECT 'core/lectionary', count(*), CAST(sum(length(gospel)) AS BIGINT) FROM read
    UNION ALL SELECT 'core/book_slugs', count(*), CAST(sum(length(alias) + length(slug)) AS BIGINT) FROM alias
    UNION ALL SELECT 'core/slug_names', count(*), CAST(sum(length(slug) + length(name)) AS BIGINT) FROM (SELECT DISTINCT slug, name FROM alias)
    UNION ALL SELECT 'bodies', count(*) * 2, CAST(sum(length(documents.text)) * 2 AS BIGINT) FROM documents
    UNION ALL SELECT 'chains', count(*), CAST(sum(length(text) - len(string_split(text, chr(10))) + 1) AS BIGINT) FROM per
    UNION ALL SELECT 'core/stats', (SELECT least(20, count(DISTINCT book)) FROM norm WHERE ok) + (SELECT least(25, count(DISTINCT key)) FROM vkey) + (SELECT least(20, count(DISTINCT dst)) FROM res) + (SELECT least(12, count(DISTINCT key)) FROM fidx),
      CAST((SELECT count(*) FROM art) + (SELECT count(*) FROM tea) + (SELECT count(*) FROM eng) + (SELECT count(*) FROM lat) + (SELECT count(*) FROM per) AS BIGINT)""",
)
def export_browser_bundle(t):
    """Every part, written and read back; the last row's ``chars`` are the counts of the meta object."""
    path, spark = new_path(t.spark, "browser"), t.spark
    # Neither articles nor pericopes are stored here: their texts would stand on disk beside the parts.
    tables = build.build_graph(t.articles.withColumn("text", F.col("noted_text")), f"{path}/tables")
    readings = t.readings.withColumn("day", F.lit(None).cast("string"))
    build.export_browser_bundle(path, t.articles, t.teaching, t.english, t.latin, t.pericopes, readings, tables, ("citations", "index", "refs", "edges"))

    def total(part, df, *chars):
        said = sum((F.length(c) for c in chars[1:]), F.length(chars[0]))
        return df.agg(F.lit(part).alias("part"), F.count("*").alias("rows"), F.sum(said).cast("long").alias("chars"))

    keyed = lambda part, value: spark.read.text(f"{path}/{part}").select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("k", "v"))
    edges = lambda part, entry: readers.scan_adjacency(spark, f"{path}/{part}", f"struct<{entry}>")
    refs = keyed("core/article_refs", "array<string>")
    chain = keyed("chains", "struct<cit:string,path:array<string>,lemma:string,segs:array<array<string>>,refs:array<string>>")
    spoken = F.array_join(F.transform("v.segs", lambda s: F.element_at(s, 2)), "")
    listed = ["most_cited_books", "most_cited_verses", "most_glossed_verses", "most_cited_articles"]
    stats = spark.read.schema(", ".join(f"{c} array<string>" for c in listed)).json(f"{path}/core/stats")
    counted = ["articles", "teaching_sections", "verses_en", "verses_la", "chains"]
    meta = spark.read.schema(", ".join(f"{c} long" for c in counted)).json(f"{path}/core/meta")
    sizes = meta.select(sum((F.col(c) for c in counted[1:]), F.col(counted[0])).alias("n")).scalar()
    parts = [
        total("core/articles", spark.read.schema("id string, citation string, title string").json(f"{path}/core/articles"), "id", "citation", "title"),
        total("core/verses", keyed("core/verses", "array<string>").select(F.array_join("v", "").alias("v")), "v"),
        total("core/scripture_index", edges("core/scripture_index", "id:string,citation:string,title:string,ref:string"), "key", "id", "ref"),
        total("core/internal_refs", edges("core/internal_refs", "id:string,citation:string"), "key", "id"),
        total("core/internal_cited_by", edges("core/internal_cited_by", "id:string,citation:string,title:string"), "key", "id"),
        total("core/article_refs", refs.select(F.array_join("v", "").alias("v")), "v"),
        total("core/fathers_index", edges("core/fathers_index", "id:string,citation:string,father_summary:string,work:string"), "key", "id", "father_summary"),
        total("core/lectionary", keyed("core/lectionary", "struct<gospel:string,day:string>"), "v.gospel"),
        total("core/book_slugs", keyed("core/book_slugs", "string"), "k", "v"), total("core/slug_names", keyed("core/slug_names", "string"), "k", "v"),
        total("bodies", keyed("bodies", "string"), "v"), total("chains", chain.select(spoken.alias("v")), "v"),
        stats.select(F.lit("core/stats").alias("part"), sum((F.size(c) for c in listed[1:]), F.size(listed[0])).cast("long").alias("rows"), sizes.alias("chars")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
