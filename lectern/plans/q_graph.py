"""Queries over the citation graph: indexes, degrees, counts, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import canon
from ..functions import refs
from ..operators import align, graph, project
from ..session import new_path, settle
from ..sources.readers import scan_adjacency
from . import build, corpus, oracle
from .corpus import PRINTED
from .oracle import with_
from .registry import query


def _cites(t):
    return graph.scripture_citations(t.articles)


def _noted(t):
    """Written references, parsed once and kept: later steps read only this table."""
    return settle(graph.internal_edges(t.articles, "noted_text"), "noted")


def _resolved(t):
    return graph.internal_resolve(_noted(t), t.articles.select("id", "citation", "title"))


@query("book_counts", with_("norm") + "SELECT book, count(*) AS n FROM norm WHERE ok GROUP BY 1")
def book_counts(t):
    return graph.book_counts(_cites(t))


@query("verse_counts", with_("vkey") + "SELECT key, count(*) AS n FROM vkey GROUP BY 1")
def verse_counts(t):
    return graph.verse_counts(_cites(t))


@query("unparsed_counts", with_("norm") + "SELECT raw, count(*) AS n FROM norm WHERE NOT ok GROUP BY 1 ORDER BY n DESC, raw LIMIT 20")
def unparsed_counts(t):
    return graph.most_common(graph.unparsed_counts(_cites(t)), "raw", 20)


@query(
    "parse_rate",
    with_("norm") + "SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS parsed, round(count(*) FILTER (WHERE ok) / count(*), 4) AS rate FROM norm",
)
def parse_rate(t):
    return graph.parse_rate(_cites(t))


@query("internal_resolve", with_("res") + "SELECT src, dst FROM res")
def internal_resolve(t):
    return _resolved(t)


@query(
    "internal_resolve_rate",
    with_("inl", "res")
    + "SELECT total, resolved, round(resolved / total, 4) AS rate FROM (SELECT (SELECT count(*) FROM inl) AS total, (SELECT count(*) FROM res) AS resolved)",
)
def internal_resolve_rate(t):
    edges = _noted(t)
    return graph.resolve_rate(edges, graph.internal_resolve(edges, t.articles.select("id")))


@query("in_degree", with_("res") + "SELECT dst AS id, count(*) AS in_degree FROM res GROUP BY 1")
def in_degree(t):
    return graph.in_degree(_resolved(t))


@query("out_edges_total", with_("res") + "SELECT count(*) AS edges FROM res")
def out_edges_total(t):
    return _resolved(t).agg(F.count("*").alias("edges"))


@query(
    "distinct_keys_by_level",
    with_("idx")
    + "SELECT count(DISTINCT key) FILTER (WHERE len(string_split(key, '/')) = 3) AS verse_keys, count(DISTINCT key) FILTER (WHERE len(string_split(key, '/')) = 2) AS chapter_keys FROM idx",
)
def distinct_keys_by_level(t):
    keys = graph.inverted_index(t.articles, ("id",)).select("key").distinct()
    level = F.size(F.split("key", "/"))
    count = lambda n: F.sum(F.when(level == n, 1).otherwise(0)).cast("long")
    return keys.agg(count(3).alias("verse_keys"), count(2).alias("chapter_keys"))


@query("gloss_weight", with_("per", "fsum") + "SELECT key, CAST(sum(n_named) AS BIGINT) AS weight FROM (SELECT unnest(keys) AS key, n_named FROM per JOIN fsum USING (doc_id)) GROUP BY 1")
def gloss_weight(t):
    return graph.gloss_weight(t.pericopes)


@query(
    "most_glossed",
    with_("per", "fsum", "book")
    + """SELECT key, b.name || ' ' || split_part(key, '/', 2) || ':' || split_part(key, '/', 3) AS ref, weight FROM (
      SELECT key, CAST(sum(n_named) AS BIGINT) AS weight FROM (SELECT unnest(keys) AS key, n_named FROM per JOIN fsum USING (doc_id)) GROUP BY 1)
      JOIN book b ON b.slug = split_part(key, '/', 1) ORDER BY weight DESC, key LIMIT 12""",
)
def most_glossed(t):
    top = graph.most_common(graph.gloss_weight(t.pericopes), "key", 12, "weight")
    part = lambda i: F.split_part("key", F.lit("/"), F.lit(i))
    return top.select("key", F.concat(refs.book_name(part(1)), F.lit(" "), part(2), F.lit(":"), part(3)).alias("ref"), "weight")


@query(
    "fragment_totals",
    with_("per", "frag")
    + """SELECT slug, any_value(p) AS pericopes, count(*) AS fragments, count(DISTINCT father) AS fathers, any_value(v) AS verses FROM per JOIN frag USING (doc_id)
      JOIN (SELECT slug, count(DISTINCT key) AS v FROM (SELECT slug, unnest(keys) AS key FROM per) GROUP BY 1) USING (slug)
      JOIN (SELECT slug, count(*) AS p FROM per GROUP BY 1) USING (slug) GROUP BY slug""",
)
def fragment_totals(t):
    return graph.fragment_totals(t.pericopes)


@query(
    "structure_counts",
    with_("eng") + "SELECT count(DISTINCT slug) AS books, count(DISTINCT slug || '/' || chapter) AS chapters, count(*) AS verses FROM eng",
)
def structure_counts(t):
    # Chapters first, books from chapters: two small distinct steps, no giant sets.
    chapters = t.english.groupBy("slug", "chapter").agg(F.count("*").alias("v"))
    books = chapters.groupBy("slug").agg(F.count("*").alias("c"), F.sum("v").alias("v"))
    return books.agg(F.count("*").alias("books"), F.sum("c").cast("long").alias("chapters"), F.sum("v").cast("long").alias("verses"))


@query("build_inverted_index", with_("idx") + "SELECT key, id, citation, title, ref FROM idx")
def build_inverted_index(t):
    return graph.inverted_index(t.articles)


@query("article_refs", with_("scr") + "SELECT id, array_to_string(list_sort(list(DISTINCT ref)), '; ') AS refs FROM scr WHERE ok GROUP BY 1")
def article_refs(t):
    return graph.node_refs(t.articles).select("id", F.array_join("refs", "; ").alias("refs"))


@query(
    "edges_to_meta",
    with_("res", "art")
    + """SELECT src, s.citation AS src_citation, s.title AS src_title, dst, d.citation AS dst_citation, d.title AS dst_title
      FROM res JOIN art s ON s.id = src JOIN art d ON d.id = dst""",
)
def edges_to_meta(t):
    return graph.edges_to_meta(_resolved(t), t.articles)


@query(
    "most_common",
    with_("vkey") + "SELECT key, count(*) AS n FROM vkey GROUP BY 1 ORDER BY n DESC, key LIMIT 25",
)
def most_common(t):
    return graph.most_common(graph.verse_counts(_cites(t)), "key", 25)


@query(
    "most_common_first_seen",
    with_("scr") + "SELECT book, count(*) AS n, min(doc_id * 100000 + pos) AS first_seen FROM scr WHERE ok GROUP BY 1 ORDER BY n DESC, first_seen LIMIT 20",
)
def most_common_first_seen(t):
    cites = graph.scripture_citations(t.articles, ("doc_id",)).filter(F.col("norm").isNotNull())
    seen = cites.groupBy(F.col("norm.book").alias("book")).agg(
        F.count("*").alias("n"), F.min(F.col("doc_id") * 100000 + F.col("pos")).alias("first_seen")
    )
    return graph.most_common(seen, "first_seen", 20)


@query(
    "ordered_list",
    with_("res", "art")
    + """SELECT id, citation, rank, total FROM (SELECT dst AS id, s.citation, CAST(row_number() OVER (PARTITION BY dst ORDER BY src) AS INT) AS rank,
      count(*) OVER (PARTITION BY dst) AS total FROM res JOIN art s ON s.id = src) WHERE rank <= 15""",
)
def ordered_list(t):
    from pyspark.sql import Window

    edges = _resolved(t)
    totals = graph.in_degree(edges).withColumnRenamed("in_degree", "total")
    # The rank filter prunes each task's rows before anything is shuffled by target.
    w = Window.partitionBy("dst").orderBy("src")
    first = edges.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 15)
    named = first.join(t.articles.select(F.col("id").alias("src"), "citation"), "src")
    return named.select(F.col("dst").alias("id"), "citation", "rank").join(totals, "id")


@query(
    "canonical_order",
    with_("eng", "book") + "SELECT CAST(pos AS INT) AS canon_pos, slug, count(*) AS verses FROM eng JOIN book USING (slug) GROUP BY 1, 2",
)
def canonical_order(t):
    counts = t.english.groupBy("slug").agg(F.count("*").alias("verses"))
    return align.canonical_order(counts).orderBy("canon_pos").select("canon_pos", "slug", "verses")


@query("scripture_edges", with_("idx") + "SELECT id AS article_id, citation AS article_citation, ref AS verse_ref, key AS verse_key FROM idx WHERE len(string_split(key, '/')) = 3")
def scripture_edges(t):
    return project.scripture_edges(graph.inverted_index(t.articles))


@query(
    "internal_edges",
    with_("res", "art") + "SELECT src AS src_id, s.citation AS src_citation, dst AS dst_id, d.citation AS dst_citation FROM res JOIN art s ON s.id = src JOIN art d ON d.id = dst",
)
def internal_edges(t):
    return project.internal_edge_rows(graph.edges_to_meta(_resolved(t), t.articles))


@query(
    "father_edges",
    with_("per", "fsum")
    + """SELECT id AS pericope_id, citation AS pericope_citation, key AS verse_key, upper(slug[1:1]) || slug[2:] || ' ' || split_part(key, '/', 2) || ':' || split_part(key, '/', 3) AS verse_ref,
      coalesce(named, '') AS fathers FROM (SELECT *, unnest(keys) AS key FROM per JOIN fsum USING (doc_id))""",
)
def father_edges(t):
    return project.father_edges(t.pericopes)


_COMMENTARY_ENTRY = "struct<id:string,citation:string,father_summary:string,work:string>"


@query(
    "build_pericope_graph",
    with_("fidx") + "SELECT key, row_number() OVER (PARTITION BY key ORDER BY id, citation) - 1 AS pos, id, citation, father_summary, 'golden-chain' AS work FROM fidx",
)
def build_pericope_graph(t):
    """The commentary's graph written as files; its verse index read back in order."""
    path = new_path(t.spark, "commentary-graph")
    build.export_commentary_graph(t.pericopes, path)
    return scan_adjacency(t.spark, f"{path}/fathers_index", _COMMENTARY_ENTRY)


@query(
    "unresolved_policy",
    with_("norm", "per")
    + """, f AS (SELECT doc_id, coalesce(ref, raw) AS shown, min(pos) AS pos FROM norm GROUP BY 1, 2), g AS (SELECT doc_id, ref, min(pos) AS pos FROM norm WHERE ok GROUP BY 1, 2)
    SELECT 'keep' AS policy, per.id, string_agg(shown, '; ' ORDER BY pos) AS refs FROM f JOIN per USING (doc_id) GROUP BY per.id
    UNION ALL SELECT 'drop', per.id, string_agg(ref, '; ' ORDER BY pos) FROM g JOIN per USING (doc_id) GROUP BY per.id""",
)
def unresolved_policy(t):
    said = lambda df, policy: df.select(F.lit(policy).alias("policy"), "id", F.array_join("refs", "; ").alias("refs"))
    return said(graph.pericope_refs(t.pericopes), "keep").unionByName(said(graph.teaching_refs(t.pericopes), "drop"))


_TEACHING_ENTRY = "struct<id:string,citation:string,title:string,work:string>"


@query(
    "build_catechism_graph",
    with_("idx", "art")
    + f"""SELECT key, row_number() OVER (PARTITION BY key ORDER BY teach.id, teach.citation) - 1 AS pos, teach.id, teach.citation, teach.title, 'teaching' AS work
      FROM idx JOIN art ON art.id = idx.id JOIN ({corpus.TEACHING_SQL}) teach ON teach.doc_id = art.doc_id""",
)
def build_catechism_graph(t):
    """The teaching text's graph written as files; its index read back in order."""
    path = new_path(t.spark, "teaching-graph")
    build.export_teaching_graph(t.teaching, path)
    return scan_adjacency(t.spark, f"{path}/teaching_index", _TEACHING_ENTRY)


@query(
    "alias_inverse",
    with_("lin", "alias")
    + f"SELECT alias, slug, name, n FROM (SELECT regexp_replace(lower({oracle.pick(PRINTED, 'doc_id + i')}), '[\\s.]', '', 'g') AS alias, count(*) AS n FROM lin GROUP BY 1) JOIN alias USING (alias)",
)
def alias_inverse(t):
    from ..functions.columns import pick


    spelled = t.lines.groupBy(refs.book_key(pick(PRINTED, F.col("doc_id") + F.col("i"))).alias("alias")).agg(F.count("*").alias("n"))
    return project.alias_inverse(t.spark).join(spelled, "alias")


_TOP_BOOKS = "SELECT 'book' AS kind, book AS name, count(*) AS n FROM norm WHERE ok GROUP BY 2 ORDER BY n DESC, name LIMIT 12"
_TOP_VERSES = """SELECT 'verse' AS kind, CASE WHEN len(string_split(key, '/')) = 3 THEN split_part(key, '/', 1) || ' ' || split_part(key, '/', 2) || ':' || split_part(key, '/', 3) ELSE key END AS name, n
  FROM (SELECT key, count(*) AS n FROM vkey GROUP BY 1 ORDER BY n DESC, key LIMIT 12)"""
_TOP_ARTICLES = "SELECT 'article' AS kind, citation AS name, n FROM (SELECT dst, count(*) AS n FROM res GROUP BY 1 ORDER BY n DESC, dst LIMIT 12) JOIN art ON art.id = dst"


@query(
    "top",
    with_("norm", "vkey", "res", "art") + f"SELECT * FROM ({_TOP_BOOKS}) UNION ALL SELECT * FROM ({_TOP_VERSES}) UNION ALL SELECT * FROM ({_TOP_ARTICLES})",
)
def top(t):
    cites = settle(_cites(t), "citations")
    row = lambda df, kind, name, n="n": df.select(F.lit(kind).alias("kind"), name.alias("name"), F.col(n).alias("n"))
    books = graph.most_common(graph.book_counts(cites), "book", 12)
    verses = graph.most_common(graph.verse_counts(cites), "key", 12)
    articles = graph.most_common(graph.in_degree(_resolved(t)), "id", 12, "in_degree").join(t.articles.select("id", "citation"), "id")
    return (
        row(books, "book", F.col("book"))
        .unionByName(row(verses, "verse", refs.key_to_ref(F.col("key"))))
        .unionByName(row(articles, "article", F.col("citation"), "in_degree"))
    )
