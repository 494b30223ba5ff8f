import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions import refs, text, vectors

X = None


@pytest.fixture(autouse=True, scope="module")
def column(spark):
    global X
    X = F.col("x")


def test_tokenize_drops_stop_words_and_single_letters(evaluate):
    assert evaluate(text.tokenize(X), "Is the Soul a 7 soul-mate of X1? 42") == ["soul", "soul", "mate", "x1", "42"]


def test_term_counts_keep_duplicates(evaluate):
    rows = evaluate(text.term_counts(text.tokenize(X)), "beta alpha beta gamma beta")
    assert [(r.term, r.f) for r in rows] == [("alpha", 1), ("beta", 3), ("gamma", 1)]
    assert evaluate(text.term_counts(text.tokenize(X)), "the of") == []


def test_collapse_ws_knows_unicode_spaces(evaluate):
    assert evaluate(text.collapse_ws(X), "  a   b\n\tc　") == "a b c"


@pytest.mark.parametrize(
    "fragment, plain",
    [
        ("a<b>b</b> c", "ab c"),
        ("Sirach&#160;3 &mdash; x&#x41;&amp;lt;", "Sirach 3 — xA&lt;"),
        ("x &unknown; &amp y &", "x &unknown; & y &"),
        ("1 < 2 <!-- gone -->end", "1 < 2 end"),
        ("&#146;tis", "’tis"),
    ],
)
def test_html_to_text(evaluate, fragment, plain):
    assert evaluate(text.html_to_text(X), fragment) == plain


def test_entities_as_the_parser_reads_them(spark):
    import html
    import random

    rng = random.Random(1)
    parts = ["&", "amp", "copy", "notin", "not", ";", "#", "x", "41", "128", "0", "233", "X1F600", "lsqb", "AMP", " ", "NotEqualTilde", "zz", "x110000", "99999999999999", "xD800", "11", "\t", "é", "x0b", "65534", "1114111", "00065"]
    texts = ["&copy 2024", "&#233 a", "&AMP;&lsqb;", "a &amp b &NotEqualTilde; c", "&amp;amp;", "&#0000000000065;&#x0000000041;"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(2, 9))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", text.unescape(F.col("x")).alias("y")).collect()
    assert [(r.x, r.y) for r in rows if r.y != html.unescape(r.x)] == []


def test_quoted_tag_end(evaluate):
    assert evaluate(text.html_to_text(X), '<a title="a>b" href="y">c</a> <i k=\'>\'>d</i> <b "e>f') == "c d f"


def test_html_clean_puts_spaces_and_drops_marks(evaluate):
    assert evaluate(text.html_clean(X), "a<i>b</i>c­­d &deg; e") == "a b cd e"


def test_extract_elements(evaluate):
    page = "<H3 class=q>One</H3><p> two<br>three</p><p></p><p>[an error occurred while processing this directive]</p>"
    assert [(e.tag, e.text) for e in evaluate(text.extract_elements(X), page)] == [("h3", "One"), ("p", "two three")]


def test_extract_links_dedups_in_order(evaluate):
    page = '<a href="/x/bible/j">John 3:1</a><a href="/y">no</a><a href="../bible/j"><i>John&nbsp;3:1</i></a><a href="/bible/k">Mark 1</a>'
    assert evaluate(text.extract_links(X, "/bible/"), page) == ["John 3:1", "Mark 1"]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("verbum/aliud", "verbum aliud"),
        ("<Sponsa> Osculetur me", "Osculetur me"),
        ("[In principio] \\ fecit  Deus", "In principio fecit Deus"),
    ],
)
def test_clean_latin(evaluate, raw, clean):
    assert evaluate(text.clean_latin(X), raw) == clean


@pytest.mark.parametrize(
    "said, role, n",
    [
        ("Objection 3. It seems", "objection", 3),
        ("On the contrary, it is", "sed-contra", None),
        ("i answer that, yes", "respondeo", None),
        ("Reply to Objection 2. So", "reply", 2),
        ("Further, Objection 1.", "text", None),
    ],
)
def test_classify_segment(evaluate, said, role, n):
    row = evaluate(text.classify_segment(X), said)
    assert (row.role, row.n) == (role, n)


@pytest.mark.parametrize(
    "raw, shown",
    [
        ("PSEUDO-CHRYSOSTOM.", "Pseudo-Chrysostom"),
        ("CYRIL  OF ALEXANDRIA", "Cyril of Alexandria"),
        ("AUG.", "Augustine"),
        ("OF THE DESERT", "Of the Desert"),
        ("", ""),
    ],
)
def test_normalize_father(evaluate, raw, shown):
    assert evaluate(text.normalize_father(X), raw) == shown


def test_markers(evaluate):
    assert evaluate(text.strip_verse_marker(X), "Ver. 3-6. And it came") == "And it came"
    assert evaluate(text.strip_verse_marker(X), "And 3. it") == "And 3. it"
    assert evaluate(text.has_verse_marker(X), "2:13.For Adam") is True


def test_snippet_cuts_at_a_space(evaluate):
    assert evaluate(text.snippet(X, 10), "alpha beta gamma") == "alpha ..."
    assert evaluate(text.snippet(X, 11), "alpha beta gamma") == "alpha beta ..."
    assert evaluate(text.snippet(X, 40), "alpha  beta") == "alpha beta"


def test_title_ref_raises_after_hyphens(evaluate):
    assert evaluate(text.title_ref(X), "song-of-songs 1:2") == "Song-Of-Songs 1:2"


@pytest.mark.parametrize(
    "raw, out",
    [
        ("Mt 10, 16–23", "Matthew 10:16-23"),
        ("Jn 6, 51.53-58", "John 6:51,53-58"),
        ("Mt 26, 14-27, 66", "Matthew 26:14-27:66"),
        ("Stabat Mater. Jean 19, 25-27", "John 19:25-27"),
        ("Ps 3, 4", None),
    ],
)
def test_norm_gospel(evaluate, raw, out):
    assert evaluate(text.norm_gospel(X), raw) == out


def test_strip_boilerplate(evaluate):
    cut = text.strip_boilerplate(X, r"\*\*\* START.*?\*\*\*", r"\*\*\* END")
    assert evaluate(cut, "x *** START OF *** body *** END rest") == " body "
    assert evaluate(cut, "no markers") == "no markers"


def test_decode_cp1252(spark):
    data = "cœlum “q” €".encode("cp1252")
    row = spark.createDataFrame([(bytearray(data),)], "b binary").select(text.decode_cp1252(F.col("b")).alias("y")).first()
    assert row.y == data.decode("cp1252")


# --- references ------------------------------------------------------------------


@pytest.mark.parametrize(
    "raw, ref, keys",
    [
        ("2 Timothy 3:16", "2 Timothy 3:16", ["2-timothy/3/16"]),
        ("Ecclesiasticus 24:29", "Sirach 24:29", ["sirach/24/29"]),
        ("Psalm 90:15-16", "Psalm 90:15-16", ["psalms/90/15", "psalms/90/16"]),
        ("Romans 5:15, seqq.", "Romans 5:15", ["romans/5/15"]),
        ("  1 Cor. 13 ", "1 Corinthians 13", ["1-corinthians/13"]),
        ("John 3:5-2", "John 3:5", ["john/3/5"]),
        ("John 1:2 – 3", "John 1:2-3", ["john/1/2", "john/1/3"]),
        ("1 Kings 2:2", "1 Kings 2:2", ["1-kings/2/2"]),
        ("1Kgs 2:2", "1 Samuel 2:2", ["1-samuel/2/2"]),
        ("Holy Writ", None, None),
        ("Holy Writ 3:4", None, None),
        ("John 3:16a", None, None),
        ("Luke 15:1-3, 11-32", None, None),
    ],
)
def test_normalize_ref(evaluate, raw, ref, keys):
    norm = refs.normalize_ref(X)
    row = evaluate(norm, raw)
    assert (row and row.ref, evaluate(refs.verse_keys(norm), raw)) == (ref, keys)


@pytest.mark.parametrize(
    "printed, slug",
    [("1 Kings", "1-samuel"), ("3 Kings", "1-kings"), ("1 Esdras", "ezra"), ("Apocalypse", "revelation"), ("Ecclesiasticus", "sirach"), ("5 Kings", None)],
)
def test_alias_override(evaluate, printed, slug):
    assert evaluate(refs.alias_override(X), printed) == slug


def test_parse_internal_refs(evaluate):
    said = "see I-II:1:8, II-II : 04 : 5; III:2:3 and I-II:1:8; Suppl.:5:1, Supplement:5:2; XIII:1:1"
    assert evaluate(refs.parse_internal_refs(X), said) == [
        "summa.st.i-ii.q1.a8", "summa.st.ii-ii.q4.a5", "summa.st.iii.q2.a3", "summa.st.suppl.q5.a1", "summa.st.suppl.q5.a2",
    ]


def test_citation_to_id(evaluate):
    assert evaluate(refs.citation_to_id(X), "st suppl., q.75, a.1") == "summa.st.suppl.q75.a1"
    assert evaluate(refs.citation_to_id(X), "Genesis 1:1") is None
    assert evaluate(refs.typed_citation_to_id(X), "i-ii q 2 a 03") == "summa.st.i-ii.q2.a3"


def test_inline_refs_need_a_known_book(evaluate):
    said = "as in John 3:16 and verse 3:5, 1 Corinthians 13:4-7; again John 3:16"
    assert [c.raw for c in evaluate(refs.inline_refs(X), said)] == ["John 3:16", "1 Corinthians 13:4-7"]


def test_collect_xrefs(evaluate):
    link = '<a href="/douay-rheims-bible/%s.shtml#1" class="z">%s</a>'
    page = link % ("isaias", "Is. 7:14") + link % ("osee", "Os. 2:3—4") + link % ("nobook", "1:1") + link % ("john", "ch. 5") + link % ("isaias", "again 7 : 14")
    assert [c.raw for c in evaluate(refs.collect_xrefs(X), page)] == ["Isaiah 7:14", "Hosea 2:3-4", "John 5"]


def test_gospel_spans(evaluate):
    row = evaluate(refs.gospel_spans(X), "Luke 15:1-3, 11-32")
    assert (row.slug, [tuple(s) for s in row.spans], row.parse_status) == ("luke", [(15, 1, 15, 3), (15, 11, 15, 32)], "single-chapter")
    row = evaluate(refs.gospel_spans(X), "Matthew 9:35-10:1,5a,6-8")
    assert ([tuple(s) for s in row.spans], row.parse_status) == ([(9, 35, 10, 1), (10, 5, 10, 5), (10, 6, 10, 8)], "cross-chapter")
    assert evaluate(refs.gospel_spans(X), "nothing here") is None


def test_key_shapes(evaluate):
    assert evaluate(refs.key_to_ref(X), "john/1/14") == "john 1:14"
    assert evaluate(refs.key_to_ref(X), "john/1") == "john/1"
    assert evaluate(refs.father_verse_ref(X), "john/1/14") == "John 1:14"
    assert evaluate(refs.part_of(X), "summa.st.ii-ii.q1.a1") == "ii-ii"
    assert evaluate(refs.part_of(X), "x.y") == ""


# --- vectors ---------------------------------------------------------------------


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<float>")
    rows = df.select(vectors.l2_normalize(F.col("v")).alias("u"), vectors.dot_with(F.col("v"), [1.0, 2.0]).alias("d")).collect()
    assert rows[0].u == [0.6, 0.8] and rows[1].u == [0.0, 0.0]
    assert [r.d for r in rows] == [11.0, 0.0, None]
    packed = df.filter("v is not null").select(vectors.pack_f16("v").alias("p"))
    back = [r.u for r in packed.select(vectors.unpack_f16("p").alias("u")).collect()]
    assert np.allclose(back[0], np.array([0.6, 0.8], dtype="<f2")) and back[1] == [0.0, 0.0]
