"""Boilerplate lines by hand and by SQL."""

from lectern.llm import lines
from lectern.llm.queries import LINES_SQL, op4_line_dedup
from tests.check_oracle import compare, connect
from tests.llm.odd import DOCS, no_docs, odd_docs


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(op4_line_dedup(spark, folder), connect(folder), LINES_SQL) is None


def test_by_hand(spark):
    own = [f"Long enough text of page number {i}, which no other page has." for i in range(6)]
    rows = [(i, f"HOME | ABOUT\n\n{t}\r\n  HOME | ABOUT \r", "en", "a", 0) for i, t in enumerate(own)]
    rows += [(10 + i, f"HOME | ABOUT\n{t}", "en", "b", 0) for i, t in enumerate(own[:2])]
    rows += [(20 + i, "A copied page\nof two lines", "en", "c", 0) for i in range(5)] + [(30, "another page", "en", "c", 0)]
    rows += [(40 + i, f"{t}\nFOOT", "en", None, 0) for i, t in enumerate(own[:4])]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: (r.text, r.dropped_lines, r.n_chars) for r in lines.drop_lines(docs, figures=True).collect()}
    for i, t in enumerate(own):
        assert got[i] == (f"\n{t}\r", 2, len(t) + 2)
    assert got[10] == (f"HOME | ABOUT\n{own[0]}", 0, 0)  # on two pages only
    assert got[20] == ("A copied page\nof two lines", 0, 0)  # a copy, not boilerplate
    assert got[40] == (own[0], 1, len(own[0]))


def test_ratio(spark):
    rows = [(i, ("COMMON\n" if i < 3 else "") + f"Words of their own on page {i}, and some more of them.", "en", "a", 0) for i in range(100)]
    docs = spark.createDataFrame(rows, DOCS)
    assert lines.drop_lines(docs, figures=True).where("dropped_lines > 0").count() == 3
    assert lines.drop_lines(docs, ratio=0.03, figures=True).where("dropped_lines > 0").count() == 0


def test_long_menu_goes_and_copied_pages_stay(spark):
    menu = "\n".join(f"An entry of the menu that every page of this site has, number {i}" for i in range(20))
    rows = [(i, f"{menu}\nShort body {i}", "en", "a", 0) for i in range(6)]
    rows += [(10 + i, "A copied page\nof two lines\n" + "\n" * (i % 2), "en", "a", 0) for i in range(40)]
    rows += [(60 + i, f"COMMON\nLine {i} of the other pages", "en", "a", 0) for i in range(3)] + [(70, "COMMON", "en", "a", 0)]
    got = {r.doc_id: (r.text, r.dropped_lines, r.n_chars) for r in lines.drop_lines(spark.createDataFrame(rows, DOCS), figures=True).collect()}
    for i in range(6):
        assert got[i] == (f"Short body {i}", 20, 12)
    for i in range(40):
        assert got[10 + i][1] == 0 and got[10 + i][0] == rows[6 + i][1]
    assert got[60] == ("Line 0 of the other pages", 1, 25) and got[70] == ("", 1, 0)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = lines.drop_lines(docs)
    assert out.dtypes == docs.dtypes
    assert sorted(str(tuple(r)) for r in out.collect()) == sorted(str(tuple(r)) for r in docs.collect())
    assert lines.drop_lines(no_docs(spark)).count() == 0
