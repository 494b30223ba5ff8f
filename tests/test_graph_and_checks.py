import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lectern import schemas
from lectern.operators import align, graph, project, quality
from lectern.plans import tools

NODES = [
    ("summa.st.i.q1.a1", "ST I, q.1, a.1", "One", "see I:1:1, I:1:2 and I:9:9", ["John 1:14-15", "John 1:14", "Holy Writ"]),
    ("summa.st.i.q1.a2", "ST I, q.1, a.2", "Two", "as in I:1:1 and I : 1 : 01", ["John 1", "Jn 1:14"]),
]


@pytest.fixture(scope="module")
def nodes(spark):
    rows = [(i, "w", c, t, None, "article", x, [], [(r, "scripture", None) for r in refs] + [("John 9:9", "internal", None)], None) for i, c, t, x, refs in NODES]
    return spark.createDataFrame(rows, schemas.NODE)


@pytest.fixture(scope="module")
def verses(spark):
    rows = [(f"john/{c}/{v}", "john", c, v, f"John {c}:{v}", f"text {c} {v}") for c, v in [(1, 14), (1, 15), (1, 2), (10, 1), (11, 1), (11, 2)]]
    return spark.createDataFrame(rows, "verse_key string, slug string, chapter int, verse int, citation string, text string")


def test_inverted_index_first_reference_wins(nodes):
    got = {(r.key, r.id[-2:], r.ref) for r in graph.inverted_index(nodes).collect()}
    assert got == {
        ("john/1", "a1", "John 1:14-15"), ("john/1/14", "a1", "John 1:14-15"), ("john/1/15", "a1", "John 1:14-15"),
        ("john/1", "a2", "John 1"), ("john/1/14", "a2", "John 1:14"),
    }


def test_counts(nodes):
    cites = graph.scripture_citations(nodes)
    assert {(r.key, r.n) for r in graph.verse_counts(cites).collect()} == {("john/1/14", 3), ("john/1/15", 1), ("john/1", 1)}
    assert graph.parse_rate(cites).first().asDict() == {"total": 5, "parsed": 4, "rate": 0.8}
    assert graph.parse_rate(cites.filter("false")).first().asDict() == {"total": 0, "parsed": 0, "rate": 0.0}
    assert graph.book_counts(cites).first().n == 4
    assert graph.unparsed_counts(cites).first().raw == "Holy Writ"


def test_internal_edges(nodes):
    edges = graph.internal_edges(nodes)
    resolved = graph.internal_resolve(edges, nodes)
    assert sorted((r.src[-2:], r.dst[-2:]) for r in resolved.collect()) == [("a1", "a2"), ("a2", "a1")]
    assert graph.resolve_rate(edges, resolved).first().asDict() == {"total": 4, "resolved": 2, "rate": 0.5}


def test_adjacency_chunks_stay_bounded_and_whole(spark):
    edges = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("key"), F.col("id").cast("string").alias("id"))
    chunks = graph.adjacency_chunks(edges, "key", ["id"], 100)
    assert chunks.select(F.max(F.size("entries"))).first()[0] == 100
    back = chunks.select("key", F.explode("entries").alias("e")).select("key", "e.id")
    assert back.count() == 5000 and back.exceptAll(edges).count() == 0


def test_lookups(spark, verses, nodes):
    asked = spark.createDataFrame([(1, "John 1"), (2, "John 1:14-16"), (3, "Genesis 999:1"), (4, "gibberish")], "request_id int, reference string")
    found = align.lookup_verses(align.lookup_keys(asked), verses).select("request_id", "verse_key").collect()
    assert sorted((r.request_id, r.verse_key) for r in found) == [(1, "john/1/14"), (1, "john/1/15"), (1, "john/1/2"), (2, "john/1/14"), (2, "john/1/15")]
    index = graph.inverted_index(nodes)
    latin = verses.filter("verse = 14").select("verse_key", F.upper("text").alias("text"))
    fathers = spark.createDataFrame([("john/1/14",)], "key string")
    rows = tools.lookup_verse(asked, verses, latin, index, fathers).filter("request_id = 2").orderBy("section", "ord").collect()
    assert [(r.section, r.citation, r.title) for r in rows] == [
        ("citer", "ST I, q.1, a.1", "One"), ("citer", "ST I, q.1, a.2", "Two"), ("commentary", None, None),
        ("verse", "John 1:14", "TEXT 1 14"), ("verse", "John 1:15", ""),
    ]


def test_gospel_over_a_chapter_end(spark, verses):
    readings = spark.createDataFrame([("john", [(10, 1, 11, 1)])], "slug string, spans array<struct<ch1:int,v1:int,ch2:int,v2:int>>")
    assert sorted(r.verse_key for r in align.gospel_verses(readings, verses).collect()) == ["john/10/1", "john/11/1"]


def test_asof_matches_brute_force(spark):
    rng = random.Random(2)
    base = dt.date(1960, 1, 1)
    held = sorted({base + dt.timedelta(days=rng.randint(0, 9000)) for _ in range(120)})
    asked = [base + dt.timedelta(days=rng.randint(-50, 9400)) for _ in range(400)] + held[:5]
    got = align.date_asof_forward(spark.createDataFrame([(d,) for d in asked], "date date"), spark.createDataFrame([(d,) for d in held * 2], "date date"))
    want = {d: next((h for h in held if h >= d), held[-1]) for d in asked}
    assert {r.asked: r.held for r in got.collect()} == want


def test_parallel_alignment(spark):
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "verse_key string")
    row = align.parallel_alignment(frame(["a", "b", "b"]), frame(["b", "c", "d"])).first()
    assert row.asDict() == {"left_keys": 2, "right_keys": 3, "shared": 1, "left_only": 1, "right_only": 2, "rate": 0.3333}


def test_upsert_keeps_existing(spark):
    old = spark.createDataFrame([("d1", 1)], "date string, v int")
    new = spark.createDataFrame([("d1", 9), ("d2", 2)], "date string, v int")
    assert sorted(map(tuple, align.upsert_by_date(old, new, value="v").collect())) == [("d1", 1), ("d2", 2)]


def test_router(spark, nodes):
    asked = spark.createDataFrame([(1, "st i q1 a2"), (2, "Jn 1:14"), (3, "John 1:14-15"), (4, "is God good"), (5, "  ")], "request_id int, request string")
    held = spark.createDataFrame([("john/1/14",)], "key string")
    got = {r.request_id: (r.route, r.target) for r in tools.query_router(asked, nodes.select("id"), held).collect()}
    assert got == {1: ("article", "summa.st.i.q1.a2"), 2: ("verse", "john/1/14"), 3: ("search", "John 1:14-15"), 4: ("search", "is God good")}


# --- checks ----------------------------------------------------------------------


def test_contiguity_and_gaps(spark):
    rows = [("a", 1), ("a", 2), ("b", 2), ("c", 1), ("c", 1), ("d", 1), ("d", 4)]
    df = spark.createDataFrame(rows, "g string, n int")
    assert sorted(r.g for r in quality.contiguity(df, ["g"], "n").collect()) == ["b", "c", "d"]
    assert sorted(map(tuple, quality.gaps(df, ["g"], "n").collect())) == [("d", 2), ("d", 3)]


def test_late_starts(spark):
    df = spark.createDataFrame([("psalms", 115, 10), ("psalms", 116, 10)], "slug string, chapter int, verse int")
    broken = quality.contiguity(df, ["slug", "chapter"], "verse", quality.late_start(F.col("slug"), F.col("chapter")))
    assert [r.chapter for r in broken.collect()] == [116]


def test_coverage_sees_a_missing_part(spark):
    present = quality.expected_questions(spark).filter("part <> 'iii' and not (part = 'i' and question = 7)")
    missing = quality.coverage_complete(present, quality.expected_questions(spark), ["part", "question"])
    assert missing.count() == 91 and missing.filter("part = 'i'").first().question == 7
    assert quality.expected_chapters(spark).count() == 1334


def test_node_checks(spark):
    rows = [
        ("summa.st.i.q1.a1", "ST I, q.1, a.1", "t", "a\n\nb", [("a", "F"), ("b", "G")]),
        ("summa.st.i.q1.a2", "ST I, q.1, a.3", "t", "a b", [("a", "F"), ("b", "")]),
        ("bad", "ST I, q.1, a.1", "1", "  ", []),
    ]
    df = spark.createDataFrame(rows, "id string, citation string, title string, text string, segments array<struct<text:string,father:string>>")
    ids = lambda d: sorted(r.id[-2:] for r in d.collect())
    assert ids(quality.lossless_rejoin(df)) == ["a2", "ad"]
    assert ids(quality.id_citation_agree(df)) == ["a2", "ad"]
    assert ids(quality.nonempty_text(df)) == ["ad"]
    assert ids(quality.every_segment_has_father(df)) == ["a2", "ad"]
    assert ids(quality.title_suffix(df)) == ["a1", "a2"]
    assert ids(quality.license_present(df, F.when(F.col("id") == "bad", F.lit("")).otherwise("x"))) == ["ad"]


def test_text_checks(spark):
    df = spark.createDataFrame([(1, "Cælum Noë"), (2, "a/b"), (3, "é")], "k int, text string")
    assert sorted(r.k for r in quality.charset_whitelist(df).collect()) == [2, 3]
    source = spark.createDataFrame([(1, "x Cælum\n Noë y"), (2, "no")], "k int, source_text string")
    assert sorted(r.k for r in quality.substring_of_source(df, source, ["k"]).collect()) == [2, 3]
    raw = spark.createDataFrame([(1, "<R>Cælum / Noë"), (2, "a/b")], "k int, raw string")
    assert sorted(r.k for r in quality.rederive_equals(df, raw, ["k"]).collect()) == [2, 3]


def test_searchable_keeps_untyped(spark):
    df = spark.createDataFrame([(1, None), (2, "verse"), (3, "article"), (4, "father-comment")], "id int, type string")
    assert sorted(r.id for r in project.searchable(df).collect()) == [1, 3]


def test_every_request_is_answered_or_refused(spark):
    asked = spark.createDataFrame([(1, "gibberish"), (2, "John 1:1"), (3, "John 3:1")], "request_id int, reference string")
    fathers = spark.createDataFrame([("john/1/1", "p1")], "key string, id string")
    segment = "array<struct<role:string,father:string,text:string>>"
    pericopes = spark.createDataFrame([("p1", "Chain 1", "In the beginning", [("father", "Bede", "said")])], f"id string, citation string, lemma string, segments {segment}")
    rows = tools.verse_fathers(asked, fathers, pericopes).orderBy("request_id", "ord").collect()
    assert [(r.request_id, r.section, r.text, r.reason) for r in rows] == [
        (1, "refused", None, "unreadable reference"), (2, "lemma", "In the beginning", None), (2, "fragment", "said", None),
        (3, "refused", None, "no commentary is held on it"),
    ]


def test_wide_ranges_unfold_in_steps(spark):
    from lectern.functions.columns import unfold

    rows = spark.createDataFrame([(1, 5, 7), (2, 9, 8), (3, 10, 1_500_010)], "k int, a long, b long")
    got = unfold(rows, F.col("a"), F.col("b"), "x").groupBy("k").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.count_distinct("x").alias("d"))
    assert sorted(map(tuple, got.collect())) == [(1, 3, 5, 7, 3), (3, 1_500_001, 10, 1_500_010, 1_500_001)]
    far = spark.createDataFrame([("g", 1), ("g", 3_000_000)], "g string, n long")
    assert quality.gaps(far, ["g"], "n").count() == 2_999_998


def test_wide_reference_is_no_list(spark):
    cited = [("John 1:2-100000", "scripture", None), ("John 1:1-3", "scripture", None), ("Holy Writ 12345", "scripture", None)]
    nodes = spark.createDataFrame([("a", "c", "t", cited)], "id string, citation string, title string, citations_out array<struct<raw:string,kind:string,target_id:string>>")
    rows = graph.inverted_index(nodes)
    counts = rows.agg(F.count("*"), F.count_distinct("key")).first()
    assert tuple(counts) == (100_001, 100_001)  # verses 1 to 100,000 and the chapter
    refs = {r.key: r.ref for r in rows.where("key IN ('john/1', 'john/1/1', 'john/1/2')").collect()}
    assert refs == {"john/1": "John 1:2-100000", "john/1/1": "John 1:1-3", "john/1/2": "John 1:2-100000"}
    asked = spark.createDataFrame([(1, "John 1:1-1500000000")], "request_id int, reference string")
    held = spark.createDataFrame([("john/1/7",), ("john/10/7",)], "verse_key string")
    assert [r.verse_key for r in align.lookup_verses(align.lookup_keys(asked), held).collect()] == ["john/1/7"]


def test_adjacency_edges_move_twice(spark):
    """Once to be ranged and stored, once by list; numbering them moves none."""
    edges = spark.range(100).select((F.col("id") % 7).cast("string").alias("key"), F.col("id").cast("string").alias("id"))
    plan = graph.adjacency_chunks(edges, "key", ["id"], 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
