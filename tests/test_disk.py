"""What whole exports leave on disk: their parts, packed, and nothing beside them."""

import datetime

import pytest
from pyspark.sql import functions as F

from lectern import session
from lectern.operators import graph
from lectern.plans import build, corpus, q_graph, q_sources
from lectern.sources import readers, writers


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents of ten lines, with two ids that come twice, turns and orders."""
    at = str(tmp_path_factory.mktemp("tables"))
    word = lambda a, b: F.element_at(F.split(F.lit("anima corpus deus homo lex mundus natura ordo pax ratio"), " "), (F.pmod(F.xxhash64(a, b), F.lit(10)) + 1).cast("int"))
    line = lambda d, i: F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda w: word(d * 100 + i, w)), " ")
    docs = spark.range(302).select((F.col("id") % 300).alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: line(F.col("doc_id"), i)), "\n")
    docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{at}/documents.parquet")
    spark.range(50).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'quid est lex, amice' AS text").write.parquet(f"{at}/conversations.parquet")
    days = [(i, datetime.datetime(2024, 1, 1 + i)) for i in range(20)]
    spark.createDataFrame(days, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{at}/orders.parquet")
    return corpus.Tables(spark, at)


@pytest.fixture
def shared(monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    return tmp_path


def left(folder):
    """Labels of what stands in the shared folder."""
    return sorted(p.name.rsplit("-", 1)[0] for p in folder.iterdir())


def size(folder):
    return sum(p.stat().st_size for p in folder.rglob("part-*"))


def test_browser_bundle_leaves_its_parts_only(tables, shared):
    out = {r.part: r for r in q_sources.export_browser_bundle(tables).collect()}
    text = tables.documents.agg(F.sum(F.length("text"))).first()[0]
    assert out["bodies"].chars == 2 * text and out["bodies"].rows == 604
    assert left(shared) == ["browser"]
    (path,) = shared.iterdir()
    for part in ("bodies", "chains", "core/articles", "core/scripture_index", "core/verses"):
        assert {p.suffix for p in (path / part).glob("part-*")} == {".gz"}
    # The long texts stand in it three times, and are half its size.
    assert size(path / "bodies") + size(path / "chains") < 1.5 * text
    assert not (path / "tables" / "index").exists() and not (path / "tables" / "edges").exists()


def test_graph_tables_stay_where_they_are_asked_for(tables, shared):
    held = build.build_graph(tables.articles.withColumn("text", F.col("noted_text")), f"{shared}/graph")
    assert left(shared) == ["graph"]
    build.export_graph(held, f"{shared}/json")
    assert held["index"].count() > 0 and held["edges"].count() > 0


def lists(edges, size):
    """The whole adjacency in plain Python: per key the entries in order."""
    out = {}
    for r in edges.collect():
        out.setdefault(r.key, []).append(r.id)
    return {(k, n): sorted(v)[n : n + size] for k, v in out.items() for n in range(0, len(v), size)}


@pytest.mark.parametrize("most", [10_000, 300, 0])
def test_adjacency_lists_of_few_and_of_many_entries(spark, most):
    """Keys below and above ``most``, repeated rows, a null key; lists come in order of key and place."""
    rows = [(f"k{i % 9}", f"{i * 7919 % 1000:04d}") for i in range(900)] + [("hot", f"{i * 31 % 800:04d}") for i in range(1000)] + [(None, "x")]
    edges = spark.createDataFrame(rows, "key string, id string").repartition(5)
    scratch = []
    got = graph.adjacency_chunks(edges, "key", ["id"], 100, most, scratch)
    held = [(r.key, r.chunk * 100, [e.id for e in r.entries], r.label) for r in got.sortWithinPartitions("key", "chunk").collect()]
    assert {h[:2]: h[2] for h in held} == lists(edges.where("key IS NOT NULL"), 100) and len(held) == 19
    assert [h[:2] for h in held] == sorted(h[:2] for h in held)
    assert {h[3] for h in held if h[0] == "hot"} == {"hot"} | {f"hot{graph.CONTINUED}{n}" for n in range(100, 1000, 100)}
    assert len(scratch) == (1 if most == 10_000 else 3)


def test_adjacency_is_written_without_scratch(spark, shared, monkeypatch):
    monkeypatch.setattr(graph.adjacency_chunks, "__defaults__", (1000, 50, None))
    rows = [("hot", f"{i:04d}") for i in range(200)] + [("k", "a"), ("k", "a")]
    edges = spark.createDataFrame(rows, "key string, id string")
    writers.sink_adjacency(edges, f"{shared}/adj", "key", ["id"], 60)
    assert left(shared) == ["adj"]
    back = readers.scan_adjacency(spark, f"{shared}/adj", "struct<id:string>").collect()
    assert sorted((r.key, r.pos, r.id) for r in back) == sorted([("hot", i, f"{i:04d}") for i in range(200)] + [("k", 0, "a"), ("k", 1, "a")])


def test_lean_settings_end_with_their_block(spark):
    before = {k: spark.conf.get(k) for k in session.LEAN}
    with pytest.raises(ValueError), session.lean(spark):
        assert {k: spark.conf.get(k) for k in session.LEAN} == session.LEAN
        raise ValueError
    assert {k: spark.conf.get(k) for k in session.LEAN} == before


def test_teaching_graph_leaves_its_lists_only(tables, shared):
    rows = q_graph.build_catechism_graph(tables).count()
    assert rows == graph.inverted_index(tables.teaching).count() > 0
    assert left(shared) == ["teaching-graph"]
    (path,) = shared.iterdir()
    assert sorted(p.name for p in path.iterdir()) == ["teaching_index", "teaching_scripture"]
    assert {p.suffix for p in path.glob("*/part-*")} == {".gz"}


def test_flat_bundle_leaves_its_subsets_only(tables, shared):
    out = {r.subset: r.rows for r in q_sources.export_bundle(tables).collect()}
    assert out["articles"] == out["teaching"] == out["pericopes"] == 302 and out["english"] == 3020
    assert left(shared) == ["bundle"]
    (path,) = shared.iterdir()
    assert sorted(p.name for p in path.iterdir()) == sorted(out)
    # The texts stand in four subsets, and are less than twice their own size together.
    text = tables.documents.agg(F.sum(F.length("text"))).first()[0]
    assert sum(size(path / s) for s in ("articles", "teaching", "english", "pericopes")) < 2 * text
    held = tables.spark.read.json(f"{path}/articles")
    assert held.count() == 302 and held.agg(F.sum(F.length("text"))).first()[0] == text
