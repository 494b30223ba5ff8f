from pyspark.sql import functions as F

from lectern.operators import parse

CHUNK = (
    "God createth all things.\n\n\n1:1. In the beginning God created heaven,\n\nand earth.\n\n\n"
    "A note.... not scripture, and\n\nmust be dropped.\n\n\n1:2.No space after the period here.\n"
)


def test_chapter_parse(spark):
    df = spark.createDataFrame([(CHUNK,)], "x string")
    rows = df.select(F.explode(parse.printed_verses(parse.paragraph_grouping(F.col("x")))).alias("v")).select("v.*").collect()
    assert [(r.printed, r.text) for r in rows] == [
        (1, "In the beginning God created heaven, and earth."), (2, "No space after the period here."),
    ]


def renumber(spark, items):
    df = spark.createDataFrame([(items,)], "x array<struct<printed:int,text:string>>")
    return [tuple(v) for v in df.select(parse.renumber_restarts(F.col("x")).alias("y")).first().y]


def test_renumber(spark):
    assert renumber(spark, [(1, "a"), (2, "b"), (1, "c"), (2, "d")]) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    assert renumber(spark, [(11, "x"), (12, "first"), (12, "second"), (13, "y")]) == [(11, "x"), (12, "first second"), (13, "y")]


def test_edition(spark):
    text = "front\nGenesis Chapter 1\n\n\n" + CHUNK + "\n\n\n3 Kings Chapter 2.\n\n\n2:1. One.\n\n\n2:1. More.\n\n\n9:9. Drift.\nNowhere Chapter 1\n\n1:1. No.\n"
    rows = parse.parse_edition(spark.createDataFrame([(text,)], "text string")).orderBy("id").collect()
    assert [(r.id, r.citation, r.text, r.drift) for r in rows] == [
        ("drb.1-kings.2.1", "1 Kings 2:1", "One. More.", True),
        ("drb.1-kings.2.9", "1 Kings 2:9", "Drift.", True),
        ("drb.genesis.1.1", "Genesis 1:1", "In the beginning God created heaven, and earth.", False),
        ("drb.genesis.1.2", "Genesis 1:2", "No space after the period here.", False),
    ]
    assert rows[-1].path == ["Old Testament", "Genesis", "Chapter 1"]


def test_latin_lines(spark):
    df = spark.createDataFrame([("1:2 Et / terra\r", "genesis", "Genesis"), ("", "genesis", "Genesis")], "value string, slug string, latin_book string")
    (row,) = parse.parse_latin(df).collect()
    assert (row.id, row.text, row.lang, row.verse_key) == ("vg.genesis.1.2", "Et terra", "la", "genesis/1/2")


def test_question_page(spark):
    page = (
        "<h1>Question 2. The existence</h1><h2 id=\"article1\">Article 1. Whether it is?</h2><p>Objection 1. It seems.</p><p> </p>"
        "<p>I answer that, <a href=\"../bible/x\">Exodus 3:14</a> says.</p><h2 id=\"article2\">Article 2. Empty</h2>"
    )
    df = spark.createDataFrame([(page, 1), ("<h1>No heading</h1>", 1)], "html string, part int")
    (row,) = parse.page_to_nodes(df).collect()
    assert (row.id, row.citation, row.title) == ("summa.st.i.q2.a1", "ST I, q.2, a.1", "Whether it is?")
    assert row.text == "Objection 1. It seems.\n\nI answer that, Exodus 3:14 says."
    assert [(s.role, s.n) for s in row.segments] == [("objection", 1), ("respondeo", None)]
    assert [c.raw for c in row.citations_out] == ["Exodus 3:14"]


def test_commentary_block(spark):
    block = (
        "<p>Ver. 1. In the beginning.</p><p>was the Word</p><p><strong>JEROME</strong>. (Hom.) First.</p><p>goes on</p>"
        "<p><strong>AUG.</strong> Second.</p>"
    )
    df = spark.createDataFrame([(block,)], "x string")
    row = df.select(parse.attach_continuation(parse.father_paragraphs(F.col("x"))).alias("a")).first().a
    assert row.lemma == "In the beginning. was the Word"
    assert [tuple(s) for s in row.segments] == [("Jerome", "(Hom.) First.\n\ngoes on"), ("Augustine", "Second.")]


def fold(spark, elements):
    df = spark.createDataFrame([(elements,)], "x array<struct<tag:string,text:string>>")
    return [(u.idx, u.title, [tuple(s) for s in u.segments]) for u in df.select(parse.pending_heading_fold(F.col("x")).alias("y")).first().y]


def test_pending_headings(spark):
    got = fold(spark, [("p", "pre"), ("h3", "A"), ("h3", "B"), ("p", "b1"), ("p", "b2"), ("h3", "C"), ("p", "c1"), ("h3", "D")])
    assert got == [
        (1, "B", [("heading", "pre"), ("heading", "A"), ("paragraph", "b1"), ("paragraph", "b2")]),
        (2, "C", [("paragraph", "c1"), ("heading", "D")]),
    ]
    assert fold(spark, [("h3", "A")]) == []
    assert fold(spark, [("p", "only")]) == []


def test_teaching_page(spark):
    page = "<h3>ARTICLE I</h3><h3>Meaning</h3><p>as in John 3:16.</p>"
    df = spark.createDataFrame([(1, "art1", "Article 1", page)], "part int, code string, unit_label string, html string")
    (row,) = parse.parse_teaching(df).collect()
    assert (row.id, row.citation) == ("catechism.p1.art1.s01", "Roman Catechism, Part I, Article 1 : Meaning")
    assert row.text == "ARTICLE I\n\nas in John 3:16." and [c.raw for c in row.citations_out] == ["John 3:16"]


def test_commentary_page(spark):
    html = (
        '<h1>John</h1><h3 id="1"> <a href="/bible/john.shtml#1" class="x">1:1-2</a></h3><p>Ver. 1. In the beginning.</p><p>And the Word</p>'
        '<p><strong>AUG.</strong> (de Trin.) See <a href="/douay-rheims-bible/genesis.shtml#1">Gen. 1:1</a>.</p><p>More of it.</p><p class="n">no</p>'
        '<p><strong>Bede.</strong>, said &amp; done</p><h3 id="3"><a href="/bible/john.shtml#3">2:3</a></h3><p>only a lemma</p>'
        '<h3 id="4"><a href="/bible/john.shtml#4">2:4</a></h3><p><strong>Gloss.</strong> x</p>'
    )
    pages = spark.createDataFrame([("john", 1, "u", html)], "slug string, chapter int, url string, html string")
    rows = parse.pericope_pages(pages, "golden-chain", "Golden Chain", "chain").orderBy("id").collect()
    assert [(r.id, r.citation, r.drift, r.url) for r in rows] == [("chain.john.1.1", "Golden Chain, John 1:1-2", False, "u"), ("chain.john.2.4", "Golden Chain, John 2:4", True, "u")]
    first = rows[0]
    assert first.lemma == "In the beginning. And the Word" and first.commented_verse_keys == ["john/1/1", "john/1/2"]
    assert [(s.father, s.text) for s in first.segments] == [("Augustine", "(de Trin.) See Gen. 1:1.\n\nMore of it."), ("Bede", "said & done")]
    assert first.text == "(de Trin.) See Gen. 1:1.\n\nMore of it.\n\nsaid & done"
    assert [c.raw for c in first.citations_out] == ["Genesis 1:1"] and first.path == ["Golden Chain", "Gospel of John", "Chapter 1"]


def test_numbering_anomalies(spark):
    text = "Psalms Chapter 113\n\n\n113:1. a\n\n\n113:2. b\n\n\n113:1. c\n\n\n113:2. d\n\n\nProverbs Chapter 12\n\n\n12:12. e\n\n\n12:12. f\n\n\n12:13. g\n"
    edition = spark.createDataFrame([(text,)], "text string")
    notes = [tuple(r) for r in parse.edition_anomalies(edition).collect()]
    assert sorted(notes) == [("proverbs", 12, "merged", 12, 12), ("psalms", 113, "continued", 1, 3)]
    verses = {(r.slug, r.verse): r.text for r in parse.parse_edition(edition).collect()}
    assert verses == {("psalms", 1): "a", ("psalms", 2): "b", ("psalms", 3): "c", ("psalms", 4): "d", ("proverbs", 12): "e f", ("proverbs", 13): "g"}


def test_edition_in_splits_equals_one_row(spark, tmp_path):
    from lectern.sources import readers

    books = ["Genesis", "3 Kings", "Nowhere", "Canticle of Canticles"]
    text = "Front matter\n"
    for c in range(1, 60):
        text += f"\n\n\n{books[c % 4]} Chapter {c}\n\n\nA summary.\n\n\n" + "\n\n\n".join(f"{c}:{v % 7 + 1}. Verse {v}\nthat wraps,\n\nover a blank line" for v in range(c % 11 + 1))
    (tmp_path / "a.txt").write_text(text)
    (tmp_path / "b.txt").write_text("no chapter here\n")
    whole = spark.createDataFrame([(text,)], "text string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines = readers.scan_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 5
        for one, many in ((parse.parse_edition(whole), parse.parse_edition_lines(lines)), (parse.edition_anomalies(whole), parse.edition_lines_anomalies(lines))):
            want = sorted(map(str, one.collect()))
            assert want and sorted(map(str, many.select(*one.columns).collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_are_cut_where_they_are_read():
    import pyarrow as pa

    rows = [("a", 0, 0, "x"), ("a", 0, 1, "H"), ("a", 0, 0, ""), ("a", 0, 1, "I"), ("a", 9, 0, "y"), ("b", 0, 1, "J")]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], ["file", "block", "head", "value"]) for part in (rows[:3], rows[3:])]
    got = [tuple(r.values()) for b in parse._pieces(batches) for r in b.to_pylist()]
    assert got == [("a", 0, 0, "x"), ("a", 0, 1, "H\n"), ("a", 0, 2, "I"), ("a", 9, 0, "y"), ("b", 0, 1, "J")]
