from pyspark.sql import functions as F

from lectern import schemas
from lectern.plans import build
from lectern.sources import readers

SOURCE = (None, None, "public-domain", None, None, None, None)


def articles(spark):
    rows = [
        ("summa.st.i.q1.a1", "ST I, q.1, a.1", "One", "see I:1:2", ["John 1:14", "Holy Writ"]),
        ("summa.st.i.q1.a2", "ST I, q.1, a.2", "Two", "see I:1:1 and I:7:7", ["John 1:14-15"]),
    ]
    data = [
        (i, "w", c, t, [], "article", x, [("text", None, None, x)], [(r, "scripture", None) for r in refs], SOURCE)
        for i, c, t, x, refs in rows
    ]
    return spark.createDataFrame(data, schemas.NODE)


def test_build_and_export(spark, tmp_path):
    tables = build.build_graph(articles(spark), str(tmp_path / "g"))
    stats = tables["stats"].first().asDict(recursive=True)
    assert [stats.pop(k) for k in ("most_cited_books", "most_cited_verses", "unparsed_top", "most_cited_articles")] == [
        [{"book": "John", "n": 2}], [{"key": "john/1/14", "ref": "john 1:14", "n": 2}, {"key": "john/1/15", "ref": "john 1:15", "n": 1}],
        [{"raw": "Holy Writ", "n": 1}],
        [{"citation": "ST I, q.1, a.1", "title": "One", "in_degree": 1}, {"citation": "ST I, q.1, a.2", "title": "Two", "in_degree": 1}],
    ]
    assert stats == {
        "articles": 2, "scripture_citations_total": 3, "scripture_citations_parsed": 2, "parse_rate": 0.6667,
        "unparsed_count": 1, "unique_verse_keys": 2, "unique_chapter_keys": 1, "internal_refs_total": 3,
        "internal_refs_resolved": 2, "internal_resolve_rate": 0.6667, "internal_edges": 2,
    }
    assert tables["verses"].first().ref == "john 1:14"
    build.export_graph(tables, str(tmp_path / "json"))
    back = readers.scan_adjacency(spark, str(tmp_path / "json" / "internal_cited_by"))
    assert sorted((r.key[-2:], r.id[-2:]) for r in back.collect()) == [("a1", "a2"), ("a2", "a1")]


def test_article_report(spark):
    report = {r.rule: r.violations for r in build.validate_articles(articles(spark)).collect()}
    assert report.pop("coverage_complete") == 610 and set(report.values()) == {0}


def test_verse_report(spark):
    row = ("vg.jude.1.1", "w", "Jude 1:1", "", [], "verse", "Judas Jesu Christi", [], [], SOURCE, "la", "Jude", None, "Judae", 1, 1, "jude/1/1")
    verses = spark.createDataFrame([row], schemas.VERSE)
    report = {r.rule: r.violations for r in build.validate_verses(verses, "vg", latin=True).collect()}
    assert report.pop("coverage_complete") == 1333 and set(report.values()) == {0}


def test_pericope_and_teaching_reports(spark):
    base = ("chain.john.1.1", "w", "Chain, John 1:1", "", [], "father-comment", "x", [("father", None, "Bede", "x")], [], SOURCE)
    pericopes = spark.createDataFrame([base + ("lemma", ["john/1/1", "john/1/99"])], schemas.PERICOPE)
    verses = spark.createDataFrame([("john/1/1",)], "verse_key string")
    report = {r.rule: r.violations for r in build.validate_pericopes(pericopes, verses).collect()}
    assert (report.pop("keys_exist"), report.pop("all_chapters")) == (1, 88) and set(report.values()) == {0}
    roman = {"1": "I", "2": "II", "3": "III", "4": "IV"}
    ids = ["catechism.p1.art1.s01", "catechism.p3.cmd9-10.s01", "catechism.p2.baptism.s02", "catechism.p4.amen.s01"]
    nodes = spark.createDataFrame([(i, "w", f"Work, Part {roman[i[11]]}, Unit : T", "T", [], "catechism", "x", [("paragraph", None, None, "x")], [], SOURCE) for i in ids], schemas.NODE)
    report = {r.rule: r.violations for r in build.validate_teaching(nodes).collect()}
    assert report.pop("units_present") == 36 - 4 and set(report.values()) == {0}
    assert nodes.filter(F.col("id") == ids[0]).count() == 1
