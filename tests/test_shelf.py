"""Stored tables against the tools on whole tables; ranges against lists."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import align, graph
from lectern.plans import shelf, tools
from lectern.plans.corpus import Tables
from lectern.session import settle
from lectern.sources import keystore

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return sorted(str(r.asDict()) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.fixture(scope="module")
def held(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shelf") / "graph")
    shelf.write_shelf(path, tables.articles, tables.english, tables.latin, tables.pericopes, "noted_text", rows=40)
    return shelf.Shelf(spark, path)


def test_verses_and_commentary(tables, held):
    index = graph.inverted_index(tables.articles).select("key", "id", "citation", "title")
    fathers = graph.fathers_index(tables.pericopes).select("key", "id", "father_summary")
    want = tools.lookup_verse(tables.references, tables.english, tables.latin, index, fathers)
    assert rows(held.lookup_verse(tables.references)) == rows(want)
    assert rows(held.verse_fathers(tables.references)) == rows(tools.verse_fathers(tables.references, fathers, tables.pericopes))
    asked = tables.readings.select(F.date_add("date", -1).alias("date"))
    assert rows(held.todays_reading(asked, tables.readings)) == rows(tools.todays_reading(asked, tables.readings, tables.english, fathers))


def test_articles(tables, held):
    asked, meta = tables.citation_requests, tables.articles.select("id", "citation", "title")
    assert rows(held.get_article(asked)) == rows(tools.get_article(asked, tables.articles))
    assert rows(held.article_scripture(asked)) == rows(tools.article_scripture(asked, meta, graph.node_refs(tables.articles)))
    resolved = graph.internal_resolve(settle(graph.internal_edges(tables.articles, "noted_text"), "noted"), meta)
    edges = graph.edges_to_meta(resolved, meta)
    assert rows(held.cross_references(asked)) == rows(tools.cross_references(asked, meta, edges))


def test_a_tool_stores_only_its_tables(spark, tables, held):
    own = shelf.Shelf(spark, sources=shelf.sources(tables.articles, tables.english, tables.latin, tables.pericopes, "noted_text"))
    for tool, asked, names in (
        ("get_article", tables.citation_requests, {"citations", "articles"}), ("article_scripture", tables.citation_requests, {"citations", "ids", "refs"}),
        ("cross_references", tables.citation_requests, {"citations", "ids", "cites", "cited"}), ("verse_fathers", tables.references, {"fathers", "chains"}),
    ):
        before = set(own.written)
        assert rows(getattr(own, tool)(asked)) == rows(getattr(held, tool)(asked))
        assert set(own.written) - before <= names and names <= set(own.written), tool


def test_requests_that_find_nothing(spark, held):
    none = spark.createDataFrame([(1, None), (2, "no such book 3:4"), (3, "Jude 999:1")], "request_id int, reference string")
    assert {(r.request_id, r.section) for r in held.lookup_verse(none).collect()} == {(i, "refused") for i in (1, 2, 3)}
    assert held.verse_fathers(none.limit(0)).count() == 0


def test_only_zones_of_asked_keys_are_read(spark, tmp_path):
    rng = random.Random(4)
    data = [(f"k{rng.randrange(400):03d}", i) for i in range(4000)] + [("k200", 5000 + i) for i in range(3000)] + [(None, 1)]
    keystore.write(spark.createDataFrame(data, "key string, i int"), str(tmp_path / "t"), "key", ("i",), rows=100)
    store = keystore.Store(spark, str(tmp_path / "t"), "key")
    asked = spark.createDataFrame([("k007",), ("k007",), ("k200",), ("zzz",), (None,)], "wanted string")
    found = store.pick(asked, "wanted")
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == sorted(d for d in data if d[0] in ("k007", "k200"))
    zones = [r.zone for r in store.zones_of(asked, "wanted").collect()]
    assert store.zones.count() >= 60 and 25 <= len(zones) <= 40  # the hot key's and one or two more


def test_empty_store(spark, tmp_path):
    keystore.write(spark.createDataFrame([], "key string, i int"), str(tmp_path / "t"), "key")
    assert keystore.Store(spark, str(tmp_path / "t"), "key").pick(spark.createDataFrame([("a",)], "key string")).count() == 0


def test_pieces_of_ranges(spark):
    rng = random.Random(1)
    spans = [(0, 0), (0, 1), (5, 5), (3, 2), (1, 2**31 - 1), (0, 2**31 - 1)] + [tuple(sorted(rng.choices(range(300), k=2))) for _ in range(200)]
    df = spark.createDataFrame(spans, "a long, b long")
    for r in df.select("a", "b", align.dyadic(F.col("a"), F.col("b")).alias("p")).collect():
        got = [(p.part << p.level, ((p.part + 1) << p.level) - 1) for p in r.p]
        assert len(got) <= 2 * 31 and sum(z - x + 1 for x, z in got) == max(0, r.b - r.a + 1)
        assert all(r.a <= x and z <= r.b for x, z in got)
    number = spark.createDataFrame([(77,)], "n int").select(align.ancestors(F.col("n")).alias("h")).first().h
    assert {(x.level, x.part) for x in number} == {(i, 77 >> i) for i in range(32)}


def test_endless_span_meets_held_chapters(spark):
    from lectern.functions.refs import gospel_spans

    verses = spark.createDataFrame([("matthew", c, 1, f"matthew/{c}/1", "x") for c in range(1, 30)], "slug string, chapter int, verse int, verse_key string, text string")
    asked = spark.createDataFrame([("Mt 3:1-999999999:2",), ("Mt 4:1-3",), ("Mt 9:1-2:1",)], "gospel string")
    spans = settle(asked.select("gospel", gospel_spans(F.col("gospel")).alias("g")).select("gospel", "g.slug", "g.spans"), "spans")
    found = align.gospel_verses(spans, verses).groupBy("gospel").count().collect()
    assert {r.gospel: r["count"] for r in found} == {"Mt 3:1-999999999:2": 27, "Mt 4:1-3": 1}
