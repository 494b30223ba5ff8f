"""The citation graph stored once, and the tools that answer requests out of it.

Every table a tool looks things up in is stored by the key it is looked up by: all of them
by ``write_shelf``, or each by the first tool that reads it, where a shelf is given its
``sources``. A tool reads the zones of the keys its requests name; no text is parsed and no
index is built for a request once its tables are there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.refs import first_key, gospel_spans, normalize_ref
from ..operators import graph
from ..operators.align import date_asof_forward, held_chapters
from ..session import new_path, settle
from ..sources import keystore
from . import tools

#: Name, key and order of the stored tables.
TABLES = {
    "verses": ("chapter_key", ("verse",)), "latin": ("chapter_key", ("verse_key",)), "index": ("key", ("id",)),
    "fathers": ("chapter_key", ("key", "id")), "chains": ("id", ()), "refs": ("id", ()), "articles": ("id", ()),
    "ids": ("id", ()), "citations": ("citation", ("id",)), "cites": ("src", ("dst",)), "cited": ("dst", ("src",)),
}


def _chapter(key: str):
    return F.substring_index(key, "/", 2).alias("chapter_key")


def sources(articles: DataFrame, verses: DataFrame, latin: DataFrame, pericopes: DataFrame, noted: str = "text") -> dict[str, Callable[[], DataFrame]]:
    """What makes each stored table; the edges are parsed once for both their tables."""

    @cache
    def edges() -> DataFrame:
        meta = articles.select("id", "citation", F.coalesce("title", F.lit("")).alias("title"))
        resolved = graph.internal_resolve(settle(graph.internal_edges(articles, noted), "noted"), meta)
        return settle(graph.edges_to_meta(resolved, meta), "edges")

    return {
        "verses": lambda: verses.select(_chapter("verse_key"), "slug", "chapter", "verse", "verse_key", "citation", "text"),
        "latin": lambda: latin.select(_chapter("verse_key"), "verse_key", "text"),
        "index": lambda: graph.inverted_index(articles).select("key", "id", "citation", "title"),
        "fathers": lambda: graph.fathers_index(pericopes).select(_chapter("key"), "key", "id", "father_summary"),
        "chains": lambda: pericopes.select("id", "citation", "lemma", "segments"),
        "refs": lambda: graph.node_refs(articles),
        "articles": lambda: articles.select("id", "citation", "title", "text"),
        "ids": lambda: articles.select("id"),
        "citations": lambda: articles.select("citation", "id"),
        "cites": edges, "cited": edges,
        "chapters": lambda: verses.select("slug", "chapter").distinct(),
    }


def _write(name: str, df: DataFrame, path: str, rows: int = keystore.ROWS) -> None:
    if name in TABLES:
        keystore.write(df, path, *TABLES[name], rows)
    else:
        df.write.parquet(path)


def write_shelf(
    path: str, articles: DataFrame, verses: DataFrame, latin: DataFrame, pericopes: DataFrame, noted: str = "text", rows: int = keystore.ROWS
) -> None:
    """Store verses, citers, commentary, references and edges; each node's text is read once a table."""
    for name, make in sources(articles, verses, latin, pericopes, noted).items():
        _write(name, make(), f"{path}/{name}", rows)


class Shelf:
    """A stored graph; every tool takes a table of requests.

    Tables are under ``path``, or made by ``sources`` when a tool first reads them.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, sources: dict[str, Callable[[], DataFrame]] | None = None):
        self.spark, self.path, self.sources = spark, path, sources
        self.written: dict[str, str] = {}

    def where(self, name: str) -> str:
        """The folder of a table, which is stored now if it is not yet."""
        if self.sources is None:
            return f"{self.path}/{name}"
        if name not in self.written:
            path = new_path(self.spark, f"shelf-{name}")
            _write(name, self.sources[name](), path)
            self.written[name] = path
        return self.written[name]

    def store(self, name: str) -> keystore.Store:
        return keystore.Store(self.spark, self.where(name), TABLES[name][0])

    @cached_property
    def chapters(self) -> DataFrame:
        return self.spark.read.parquet(self.where("chapters"))

    def _named(self, requests: DataFrame) -> DataFrame:
        """``(chapter_key, key)`` that readable references name."""
        norm = requests.select(normalize_ref(F.col("reference")).alias("norm")).where("norm IS NOT NULL")
        return settle(norm.select(F.col("norm.chapter_key").alias("chapter_key"), first_key(F.col("norm")).alias("key")).distinct(), "named")

    def lookup_verse(self, requests: DataFrame) -> DataFrame:
        named = self._named(requests)
        verses, latin, fathers = (self.store(n).pick(named, "chapter_key") for n in ("verses", "latin", "fathers"))
        return tools.lookup_verse(requests, verses, latin, self.store("index").pick(named, "key"), fathers)

    def verse_fathers(self, requests: DataFrame) -> DataFrame:
        fathers = settle(self.store("fathers").pick(self._named(requests), "chapter_key"), "fathers")
        chains = settle(tools.verse_pericopes(requests, fathers), "chains")
        return tools.verse_fathers(requests, fathers, self.store("chains").pick(chains, "id"), chains)

    def _articles(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Requests with their ``article_id``, and the ids among them that are held."""
        exact = self.store("citations").pick(requests, "citation").select("id", "citation")
        resolved = settle(tools.resolve_article(requests, exact), "resolved")
        return resolved, settle(self.store("ids").pick(resolved, "article_id").distinct(), "known")

    def get_article(self, requests: DataFrame) -> DataFrame:
        exact = self.store("citations").pick(requests, "citation").select("id", "citation")
        resolved = settle(tools.resolve_article(requests, exact), "resolved")
        return tools.articles_of(resolved, self.store("articles").pick(resolved, "article_id"))

    def article_scripture(self, requests: DataFrame) -> DataFrame:
        resolved, known = self._articles(requests)
        return tools.scripture_of(resolved, known, self.store("refs").pick(resolved, "article_id"))

    def cross_references(self, requests: DataFrame) -> DataFrame:
        resolved, known = self._articles(requests)
        return tools.references_of(resolved, known, *(self.store(n).pick(resolved, "article_id") for n in ("cites", "cited")))

    def todays_reading(self, requests: DataFrame, readings: DataFrame) -> DataFrame:
        near = settle(date_asof_forward(requests, readings).select(F.col("held").alias("date")).distinct(), "dates")
        own = settle(readings.join(near, "date", "left_semi"), "readings")
        spans = own.select(gospel_spans(F.col("gospel")).alias("g")).select("g.slug", "g.spans").distinct()
        named = held_chapters(spans, self.chapters).select(F.concat_ws("/", "slug", F.col("chapter").cast("string")).alias("chapter_key"))
        named = settle(named.distinct(), "named")
        verses, fathers = (self.store(n).pick(named, "chapter_key") for n in ("verses", "fathers"))
        return tools.todays_reading(requests, own, verses, fathers, self.chapters)
