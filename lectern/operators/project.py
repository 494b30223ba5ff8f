"""Flat projections of nodes and edges for export and display."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import canon
from ..functions.columns import each
from ..functions.refs import father_verse_ref, is_verse_key, key_to_ref, part_of

LICENSE = "public-domain"


def _or(col, default: str):
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(default))


def project_article(nodes: DataFrame, work: str = "summa-theologiae") -> DataFrame:
    return nodes.select(
        "id", "citation", part_of(F.col("id")).alias("part"), _or("title", "").alias("title"), "text",
        _or("work", work).alias("work"), _or("source.license", LICENSE).alias("license"),
    )


def project_verse(verses: DataFrame, latin: bool = False) -> DataFrame:
    printed = F.col("latin_book" if latin else "douay_book")
    cols = ["id", "citation", "book", "chapter", "verse", "verse_key", "text"]
    out = verses.select(*cols, _or("source.license", LICENSE).alias("license"), printed.alias("book_printed"))
    return out.withColumn("lang", F.lit("la")) if latin else out


def project_catechism(nodes: DataFrame, work: str = "roman-catechism") -> DataFrame:
    return nodes.select(
        "id", "citation", F.coalesce(F.try_element_at("path", F.lit(2)), F.lit("")).alias("part"),
        _or("title", "").alias("title"), "text", _or("work", work).alias("work"),
        _or("source.license", LICENSE).alias("license"),
    )


def father_list():
    """Named commentators of a pericope, distinct, in first-seen order."""
    named = F.filter(F.transform("segments", lambda s: _or(s["father"], "")), lambda f: f != "")
    return F.array_join(F.array_distinct(named), ", ")


def project_pericope(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        "id", "citation", F.coalesce(F.try_element_at("path", F.lit(2)), F.lit("")).alias("gospel"),
        _or("lemma", "").alias("lemma"), "text", father_list().alias("fathers"),
        F.size("segments").alias("n_fragments"),
        F.coalesce("commented_verse_keys", F.array().cast("array<string>")).alias("commented_verse_keys"),
        _or("source.license", LICENSE).alias("license"),
    )


def scripture_edges(index: DataFrame) -> DataFrame:
    """Verse-level rows of the inverted index."""
    return index.filter(is_verse_key(F.col("key"))).select(
        F.col("id").alias("article_id"), F.col("citation").alias("article_citation"),
        _or("ref", "").alias("verse_ref"), F.col("key").alias("verse_key"),
    )


def internal_edge_rows(edges: DataFrame) -> DataFrame:
    """Edges with both citations (see ``graph.edges_to_meta``)."""
    return edges.select(
        F.col("src").alias("src_id"), "src_citation", F.col("dst").alias("dst_id"), "dst_citation"
    )


def father_edges(pericopes: DataFrame) -> DataFrame:
    # The list is made per pericope, before its verses are unfolded.
    listed = pericopes.select(
        F.col("id").alias("pericope_id"), F.col("citation").alias("pericope_citation"),
        father_list().alias("fathers"), "commented_verse_keys",
    )
    keyed = listed.select("pericope_id", "pericope_citation", each("commented_verse_keys").alias("verse_key"), "fathers")
    return keyed.select(
        "pericope_id", "pericope_citation", "verse_key", father_verse_ref(F.col("verse_key")).alias("verse_ref"), "fathers"
    )


def union_corpora(first: DataFrame, second: DataFrame) -> DataFrame:
    """One passage set of two node tables, the second after the first."""
    return first.unionByName(second, allowMissingColumns=True)


def searchable(nodes: DataFrame) -> DataFrame:
    """Nodes the keyword index holds: everything but verses and commentary."""
    return nodes.filter(~_or("type", "").isin("verse", "father-comment"))


def alias_inverse(spark) -> DataFrame:
    """``(alias, slug, name)`` of the canon."""
    rows = [(alias, slug, canon.NAME_OF[slug]) for alias, slug in canon.ALIASES.items()]
    return spark.createDataFrame(rows, "alias string, slug string, name string")
