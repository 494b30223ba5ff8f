"""Whole-corpus jobs: build the graph tables, validate a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import canon
from ..functions.refs import book_name, key_to_ref
from ..operators import align, graph, project, quality
from ..operators.parse import CONTINUED_NUMBERING, MERGED, UNHANDLED
from ..session import discard, lean, settle
from ..sources.writers import counting, counts_of, packed, sink_adjacency, sink_keyed, sink_manifest, sink_stats


def build_graph(nodes: DataFrame, path: str) -> dict[str, DataFrame]:
    """Write the citation graph of article nodes under ``path`` and return its tables.

    Citations are parsed once; every count and index reads the written result. The texts are
    read once, for the references in them, and not stored again. Tables:
    ``citations``, ``index`` (key to citing node), ``refs``, ``edges`` (both ends
    named), ``stats`` and the reports ``books``, ``verses``, ``articles``, ``unparsed``.
    """
    with lean(nodes.sparkSession):
        return _graph_tables(nodes, path)


def _graph_tables(nodes: DataFrame, path: str) -> dict[str, DataFrame]:
    spark = nodes.sparkSession

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        held = spark.read.schema(df.schema).parquet(f"{path}/{name}")
        held.settled_at = f"{path}/{name}"
        return held

    noted = keep("noted", graph.internal_edges(nodes))
    nodes = settle(nodes.select("id", "citation", "title", "citations_out"), "nodes")
    meta = nodes.select("id", "citation", F.coalesce("title", F.lit("")).alias("title"))
    cites = keep("citations", graph.scripture_citations(nodes))
    index = keep("index", graph.inverted_index(nodes))
    refs = keep("refs", graph.node_refs(nodes))
    edges = keep("edges", graph.edges_to_meta(graph.internal_resolve(noted, meta), meta))
    degrees = graph.in_degree(edges.select("src", "dst"))
    tables = {
        "citations": cites,
        "index": index,
        "refs": refs,
        "edges": edges,
        "books": keep("books", graph.most_common(graph.book_counts(cites), "book", 20)),
        "verses": keep("verses", graph.most_common(graph.verse_counts(cites), "key", 25).withColumn("ref", key_to_ref(F.col("key")))),
        "articles": keep("articles", graph.most_common(degrees, "id", 20, "in_degree").join(meta, "id")),
        "unparsed": keep("unparsed", graph.most_common(graph.unparsed_counts(cites), "raw", 20)),
    }
    levels = index.select("key").distinct().agg(
        F.count_if(F.size(F.split("key", "/")) == 3).alias("unique_verse_keys"),
        F.count_if(F.size(F.split("key", "/")) == 2).alias("unique_chapter_keys"),
    )
    one = lambda df, col: df.select(col).scalar()
    rates, links = graph.parse_rate(cites), graph.resolve_rate(noted, edges)
    # Lists of a report: as long as the tables they come from, 20 or 25 rows.
    listed = lambda df, *cols: df.agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col(cols[-1])).alias("by"), "tie", F.struct(*cols).alias("row")))), lambda x: x["row"]).alias("l")
    ).select("l").scalar()
    named = lambda df, tie: df.withColumn("tie", F.col(tie))
    stats = nodes.agg(F.count("*").alias("articles")).select(
        "articles",
        one(rates, "total").alias("scripture_citations_total"),
        one(rates, "parsed").alias("scripture_citations_parsed"),
        one(rates, "rate").alias("parse_rate"),
        (one(rates, "total") - one(rates, "parsed")).alias("unparsed_count"),
        one(levels, "unique_verse_keys").alias("unique_verse_keys"),
        one(levels, "unique_chapter_keys").alias("unique_chapter_keys"),
        one(links, "total").alias("internal_refs_total"),
        one(links, "resolved").alias("internal_refs_resolved"),
        one(links, "rate").alias("internal_resolve_rate"),
        edges.agg(F.count("*").alias("n")).scalar().alias("internal_edges"),
        listed(named(tables["books"], "book"), "book", "n").alias("most_cited_books"),
        listed(named(tables["verses"], "key"), "key", "ref", "n").alias("most_cited_verses"),
        listed(named(tables["unparsed"], "raw"), "raw", "n").alias("unparsed_top"),
        listed(named(tables["articles"], "id"), "citation", "title", "in_degree").alias("most_cited_articles"),
    )
    tables["stats"] = keep("stats", stats)
    discard(nodes)
    return tables


def export_graph(tables: dict[str, DataFrame], path: str) -> None:
    """The graph as sorted JSON lines, one bounded object per line."""
    sink_adjacency(tables["index"], f"{path}/scripture_index", "key", ["id", "citation", "title", "ref"])
    edges = tables["edges"]
    out = edges.select("src", F.col("dst").alias("id"), F.col("dst_citation").alias("citation"))
    sink_adjacency(out, f"{path}/internal_refs", "src", ["id", "citation"])
    back = edges.select("dst", F.col("src").alias("id"), F.col("src_citation").alias("citation"), F.col("src_title").alias("title"))
    sink_adjacency(back, f"{path}/internal_cited_by", "dst", ["id", "citation", "title"])
    _listed_refs(tables["refs"], f"{path}/article_refs")
    sink_stats(tables["stats"], f"{path}/stats")


def _listed_refs(refs: DataFrame, path: str) -> None:
    """``{id: [references]}`` lines in the order of the ids."""
    lines = refs.select("id", F.to_json(F.create_map("id", "refs")).alias("value"))
    with lean(refs.sparkSession):
        packed(lines.repartitionByRange("id").sortWithinPartitions("id").select("value")).text(path)


def export_commentary_graph(pericopes: DataFrame, path: str) -> None:
    """The commentary's graph: from a verse its pericopes, from a pericope its references."""
    entry = ["id", "citation", "father_summary", "work"]
    sink_adjacency(graph.fathers_index(pericopes), f"{path}/fathers_index", "key", entry)
    _listed_refs(graph.pericope_refs(pericopes), f"{path}/commentary_scripture")


def export_teaching_graph(nodes: DataFrame, path: str) -> None:
    """The teaching text's graph: from a key the nodes that cite it, and their references."""
    with lean(nodes.sparkSession):
        # Both are written before they are ranged, as the sample of the ranges would parse all citations again.
        index = settle(graph.inverted_index(nodes, ("id", "citation", "title", "work")), "index")
        sink_adjacency(index, f"{path}/teaching_index", "key", ["id", "citation", "title", "work"])
        discard(index)
        refs = settle(graph.teaching_refs(nodes), "refs")
        _listed_refs(refs, f"{path}/teaching_scripture")
        discard(refs)


def export_browser_bundle(
    path: str, articles: DataFrame, teaching: DataFrame, english: DataFrame, latin: DataFrame, pericopes: DataFrame, readings: DataFrame,
    tables: dict[str, DataFrame], spent: tuple[str, ...] = (),
) -> DataFrame:
    """All that a reading page needs, as JSON lines; returns ``(part, rows)``.

    ``core`` is what a page loads at once: names of all passages, both directions of the
    graph (``tables`` of ``build_graph``), the commentary's index, dated readings, book
    names, statistics, and the verses that are cited or stand in a gospel, in both
    languages; ``bodies`` and ``chains`` hold the long texts by id. Counts are those of the
    writes, and ``core/meta`` is written from them. The long texts come last; before them
    the tables named in ``spent`` are removed.
    """
    with lean(articles.sparkSession):
        return _browser_parts(path, articles, teaching, english, latin, pericopes, readings, tables, spent)


def _browser_parts(
    path: str, articles: DataFrame, teaching: DataFrame, english: DataFrame, latin: DataFrame, pericopes: DataFrame, readings: DataFrame,
    tables: dict[str, DataFrame], spent: tuple[str, ...],
) -> DataFrame:
    spark, seen = articles.sparkSession, {}

    def count(part: str, rows: DataFrame) -> DataFrame:
        held, seen[part] = counting(rows)
        return held

    def adjacency(part: str, edges: DataFrame, key: str, entry: list[str]) -> None:
        sink_adjacency(count(part, edges.select(key, *entry)), f"{path}/{part}", key, entry, level="SIX")

    index, edges = tables["index"], tables["edges"]
    adjacency("core/scripture_index", index, "key", ["id", "citation", "title", "ref"])
    adjacency("core/internal_refs", edges.select("src", F.col("dst").alias("id"), F.col("dst_citation").alias("citation")), "src", ["id", "citation"])
    back = edges.select("dst", F.col("src").alias("id"), F.col("src_citation").alias("citation"), F.col("src_title").alias("title"))
    adjacency("core/internal_cited_by", back, "dst", ["id", "citation", "title"])
    _listed_refs(count("core/article_refs", tables["refs"]), f"{path}/core/article_refs")
    # The index and the statistics of the commentary read names, not texts: their lines are stored without them.
    named = F.transform("segments", lambda s: F.struct(s["father"].alias("father"))).alias("segments")
    voiced = settle(pericopes.select("id", "citation", "work", "commented_verse_keys", named), "pericopes")
    adjacency("core/fathers_index", graph.fathers_index(voiced), "key", ["id", "citation", "father_summary", "work"])

    cited = index.select("key").where(F.size(F.split("key", "/")) == 3)
    read = english.where(F.split_part("verse_key", F.lit("/"), F.lit(1)).isin(canon.GOSPELS)).select(F.col("verse_key").alias("key"))
    keys = cited.unionByName(read).distinct()
    text = lambda df, name: df.select(F.col("verse_key").alias("key"), F.col("text").alias(name))
    verses = keys.join(text(english, "en"), "key", "left").join(text(latin, "la"), "key", "left")
    both = F.array(F.coalesce("en", F.lit("")), F.coalesce("la", F.lit("")))
    sink_keyed(count("core/verses", verses), F.col("key"), both, f"{path}/core/verses")
    sink_keyed(count("core/lectionary", readings), F.col("date").cast("string"), F.struct("gospel", "day"), f"{path}/core/lectionary")
    aliases = project.alias_inverse(spark)
    sink_keyed(count("core/book_slugs", aliases), F.col("alias"), F.col("slug"), f"{path}/core/book_slugs")
    names = aliases.select("slug", "name").distinct()
    sink_keyed(count("core/slug_names", names), F.col("slug"), F.col("name"), f"{path}/core/slug_names")

    # Lists of a report: 12 and 20 rows.
    glossed = graph.most_common(graph.gloss_weight(voiced), "key", 12, "weight").select("key", key_to_ref(F.col("key")).alias("ref"), F.col("weight").alias("count"))
    top = lambda df, by, *cols: df.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col(by)).alias("by"), F.col(cols[0]).alias("tie"), F.struct(*cols).alias("row")))), lambda x: x["row"]).alias("l")).select("l").scalar()
    stats = tables["stats"].select(
        "most_cited_books", "most_cited_verses", top(glossed, "count", "key", "ref", "count").alias("most_glossed_verses"),
        top(tables["articles"], "in_degree", "id", "citation", "title", "in_degree").alias("most_cited_articles"),
    )
    sink_stats(stats, f"{path}/core/stats")
    discard(*[tables[name] for name in spent])

    named = lambda df: df.select("id", "citation", F.coalesce("title", F.lit("")).alias("title"), "text")
    passages = named(articles).unionByName(named(teaching))
    packed(count("core/articles", passages.drop("text"))).json(f"{path}/core/articles")
    sink_keyed(count("bodies", passages.select("id", "text")), F.col("id"), F.col("text"), f"{path}/bodies", "SIX")
    chain = F.struct(
        F.col("citation").alias("cit"), "path", "lemma",
        F.transform("segments", lambda s: F.array(F.coalesce(s["father"], F.lit("")), s["text"])).alias("segs"),
        F.transform("citations_out", lambda c: c["raw"]).alias("refs"),
    )
    sink_keyed(count("chains", pericopes), F.col("id"), chain, f"{path}/chains", "SIX")

    segments = voiced.select(F.size("segments").alias("n"), F.array_distinct(F.transform("segments", lambda s: F.coalesce(s["father"], F.lit("")))).alias("fathers"))
    voices = segments.select(F.explode("fathers").alias("f")).where("f != ''").distinct().agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    held = {k: o.get.get("rows", 0) for k, o in seen.items()}
    meta = tables["stats"].select(
        "articles", F.col("scripture_citations_parsed").alias("scripture_edges"), "internal_edges", F.col("unique_verse_keys").alias("cited_verse_keys"),
        english.agg(F.count(F.lit(1)).alias("n")).scalar().alias("verses_en"), latin.agg(F.count(F.lit(1)).alias("n")).scalar().alias("verses_la"),
        F.lit(held["chains"]).alias("chains"), segments.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).scalar().alias("fragments"), voices.alias("fathers"),
        (F.lit(held["core/articles"]) - F.col("articles")).alias("teaching_sections"),
    )
    sink_stats(meta, f"{path}/core/meta")
    discard(voiced)
    return counts_of(spark, seen, "part")


def edition_manifest(verses: DataFrame, other: DataFrame, index: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row: an edition's counts, how far it meets another edition and the citations, its books.

    ``index`` is the citation index, ``anomalies`` the numbering notes (``kind``, ...), which
    are counted here and listed by ``export_edition_manifest``. ``by_book`` has the books in
    canonical order; there are as many as the canon has.
    """
    per_chapter = verses.groupBy("slug", "chapter").agg(F.count(F.lit(1)).alias("v"))
    books = settle(per_chapter.groupBy("slug").agg(F.count(F.lit(1)).alias("chapters"), F.sum("v").cast("long").alias("verses")), "books")
    placed = align.canonical_order(books).withColumn("book", book_name(F.col("slug"))).withColumn(
        "testament", F.when(F.col("slug").isin(canon.NEW_TESTAMENT), "New Testament").otherwise("Old Testament")
    )
    row = F.struct("canon_pos", F.struct("slug", "book", "chapters", "verses", "testament").alias("row"))
    counts = placed.agg(
        F.count(F.lit(1)).alias("books"), F.coalesce(F.sum("chapters"), F.lit(0)).alias("chapters"), F.coalesce(F.sum("verses"), F.lit(0)).alias("verses"),
        F.transform(F.array_sort(F.collect_list(row)), lambda x: x["row"]).alias("by_book"),
    )
    met = settle(align.parallel_alignment(verses, other), "parallel")
    cited = settle(align.citation_coverage(index, verses), "coverage")
    kinds = settle(anomalies.groupBy("kind").agg(F.count(F.lit(1)).alias("n")), "kinds")
    noted = lambda kind: F.coalesce(kinds.where(F.col("kind") == kind).select("n").scalar(), F.lit(0)).alias(kind)
    one = lambda df, c, name: df.select(c).scalar().alias(name)
    return counts.select(
        F.struct("books", "chapters", "verses").alias("counts"),
        F.struct(one(met, "shared", "shared"), one(met, "left_only", "only_here"), one(met, "right_only", "only_there"), one(met, "rate", "rate")).alias("parallel_coverage"),
        F.struct(one(cited, "cited", "cited"), one(cited, "resolved", "resolved"), one(cited, "rate", "rate")).alias("citation_graph_coverage"),
        F.struct(noted(MERGED), noted(CONTINUED_NUMBERING), noted(UNHANDLED)).alias("numbering_normalizations"), "by_book",
    )


def export_edition_manifest(path: str, verses: DataFrame, other: DataFrame, index: DataFrame, anomalies: DataFrame, **fixed: str) -> None:
    """``manifest`` as one object with the edition's descriptive fields, ``numbering`` as lines."""
    held = settle(anomalies, "anomalies")
    sink_manifest(edition_manifest(verses, other, index, held), f"{path}/manifest", **fixed)
    held.write.json(f"{path}/numbering")


def validate_articles(nodes: DataFrame) -> DataFrame:
    """``(rule, violations)`` of the article rules; a sound corpus has zeros only."""
    spark = nodes.sparkSession
    present = nodes.select(
        F.regexp_extract("id", quality.ARTICLE_ID, 1).alias("part"),
        F.regexp_extract("id", quality.ARTICLE_ID, 2).try_cast("int").alias("question"),
    )
    return _report({
        "unique_id": quality.unique_id(nodes),
        "nonempty_text": quality.nonempty_text(nodes),
        "license_present": quality.license_present(nodes, F.col("source.license")),
        "lossless_rejoin": quality.lossless_rejoin(nodes),
        "id_citation_agree": quality.id_citation_agree(nodes),
        "coverage_complete": quality.coverage_complete(present, quality.expected_questions(spark), ["part", "question"]),
    })


def validate_verses(verses: DataFrame, prefix: str, latin: bool = False) -> DataFrame:
    """``(rule, violations)`` of the verse rules for one edition."""
    placed = verses.withColumn("slug", F.split_part("verse_key", F.lit("/"), F.lit(1)))
    start: Column | None = None if latin else quality.late_start(F.col("slug"), F.col("chapter"))
    expected = quality.expected_chapters(verses.sparkSession)
    rules = {
        "unique_id": quality.unique_id(verses),
        "is_verse": verses.filter(~F.col("type").eqNullSafe("verse")),
        "nonempty_text": quality.nonempty_text(verses),
        "license_present": quality.license_present(verses, F.col("source.license")),
        "verse_position_agree": quality.verse_position_agree(verses, prefix),
        "coverage_complete": quality.coverage_complete(placed, expected, ["slug", "chapter"]),
        "coverage_unexpected": placed.select("slug", "chapter").distinct().join(expected, ["slug", "chapter"], "left_anti"),
        "contiguity": quality.contiguity(placed, ["slug", "chapter"], "verse", start),
    }
    if latin:
        rules["language"] = verses.filter(~F.col("lang").eqNullSafe("la"))
        rules["charset_whitelist"] = quality.charset_whitelist(verses)
    else:
        rules["marker_leak_check"] = quality.marker_leak_check(verses)
    return _report(rules)


def validate_pericopes(pericopes: DataFrame, verses: DataFrame) -> DataFrame:
    """``(rule, violations)`` of the commentary rules; join keys must be real verses."""
    keys = pericopes.select("id", F.explode("commented_verse_keys").alias("verse_key"))
    return _report({
        "unique_id": quality.unique_id(pericopes),
        "nonempty_text": quality.nonempty_text(pericopes),
        "license_present": quality.license_present(pericopes, F.col("source.license")),
        "lossless_rejoin": quality.lossless_rejoin(pericopes),
        "every_segment_has_father": quality.every_segment_has_father(pericopes),
        "position_agrees": quality.commentary_position_agree(pericopes),
        "keys_in_gospel": quality.keys_in_gospel(pericopes),
        "all_chapters": quality.commentary_chapters(pericopes),
        "has_keys": pericopes.filter(F.coalesce(F.size("commented_verse_keys"), F.lit(0)) <= 0),
        "keys_exist": keys.join(verses.select("verse_key").distinct(), "verse_key", "left_anti"),
    })


def validate_teaching(nodes: DataFrame) -> DataFrame:
    """``(rule, violations)`` of the teaching-text rules."""
    return _report({
        "unique_id": quality.unique_id(nodes),
        "nonempty_text": quality.nonempty_text(nodes),
        "license_present": quality.license_present(nodes, F.col("source.license")),
        "lossless_rejoin": quality.lossless_rejoin(nodes),
        "title_suffix": quality.title_suffix(nodes),
        "citations_parse": quality.citations_parse(nodes),
        "part_agrees": quality.teaching_part_agree(nodes),
        "parts_present": quality.missing_parts(nodes),
        "units_present": quality.missing_units(nodes),
    })


def _report(rules: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("rule"), "violations") for name, df in rules.items()]
    report = counts[0]
    for row in counts[1:]:
        report = report.unionByName(row)
    return report
