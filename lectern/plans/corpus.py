"""The driver's tables recast as the corpora the operators take.

Every derived row comes from a given row by column arithmetic on its ids and its lines,
so the corpora grow with the tables and both engines can build them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import canon
from ..functions.columns import each_at, let, pick
from ..functions.refs import book_name
from ..functions.text import classify_segment, clean_latin, collapse_ws, norm_gospel, normalize_father
from ..session import load, spread

PRINTED = [
    "John", "Romans", "1 Corinthians", "Psalm", "Ecclesiasticus", "Apocalypse", "1 Kings", "3 Kings", "Osee",
    "Matt", "Song of Songs", "Canticle of Canticles", "2 Tim.", "Gen", "Isaias", "Luke", "Mark", "Matthew",
    "Wis", "Hebrews", "Gloss", "Holy Writ",
]
SPEAKERS = [
    "JEROME", "PSEUDO-CHRYSOSTOM", "CYRIL OF ALEXANDRIA", "Aug.", "GREGORY THE GREAT", "Gloss", "", "Theophyl", "RABANUS",
]
OPENINGS = ["Objection %d. ", "On the contrary, ", "I answer that, ", "Reply to Objection %d. ", ""]
ROMAN = ["I", "II", "III", "IV"]
#: The teaching nodes in SQL, over the articles' CTE.
TEACHING_SQL = """SELECT doc_id, 'catechism.p' || (doc_id % 4 + 1) || '.art' || (doc_id % 12 + 1) || '.s1' || doc_id AS id,
    'Teaching, Part ' || ['I', 'II', 'III', 'IV'][(doc_id + CASE WHEN lang = 'es' THEN 1 ELSE 0 END) % 4 + 1] || ', Article ' || (doc_id % 12 + 1) || ' : ' || title AS citation,
    title, lang FROM art"""
TEXT_TABLES = {"documents", "pages"}


def text_of(number: Column) -> Column:
    return number.cast("string")


def div(a: Column, n: int) -> Column:
    return F.floor(a / F.lit(n)).cast("long")


class Tables:
    """Given tables and the corpora derived from them, built on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        df = load(self.spark, self.folder, name)
        return spread(df) if name in TEXT_TABLES else df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    @cached_property
    def doc_lines(self) -> DataFrame:
        """Documents with their lines as an array."""
        return self.documents.withColumn("lines", F.split("text", "\n", -1))

    @cached_property
    def lines(self) -> DataFrame:
        """One row per document line: ``doc_id, lang, source, i, line, len``."""
        rows = self.doc_lines.select("doc_id", "lang", "source", each_at("lines").alias("i", "line"))
        return rows.withColumn("len", F.length("line"))

    @cached_property
    def articles(self) -> DataFrame:
        """Article nodes: one per document, paragraphs are its lines."""
        d = F.col("doc_id")
        slug, shown = pick([p[0] for p in canon.PARTS], d), pick([p[1] for p in canon.PARTS], d)
        q, a = text_of(div(d, 40) + 1), text_of(F.pmod(div(d, 5), F.lit(8)) + 1)
        segments = F.transform(
            "lines",
            lambda l, i: let(
                classify_segment(F.concat(opening(i, F.length(l)), l)),
                lambda c: F.struct(
                    c["role"].alias("role"), c["n"].alias("n"), F.lit(None).cast("string").alias("father"),
                    F.concat(opening(i, F.length(l)), l).alias("text"),
                ),
            ),
        )
        return self.doc_lines.select(
            "doc_id", "lang", "source", "lines",
            F.concat(F.lit("summa.st."), slug, F.lit(".q"), q, F.lit(".a"), a).alias("id"),
            F.concat(F.lit("ST "), shown, F.lit(", q."), q, F.lit(", a."), a).alias("citation"),
            F.element_at("lines", 1).alias("title"),
            F.lit("article").alias("type"),
            "text",
            F.concat("text", F.array_join(F.transform("lines", lambda l, i: internal_note(d, i)), "")).alias("noted_text"),
            segments.alias("segments"),
            F.transform("lines", lambda l, i: citation(d, i, F.length(l))).alias("citations_out"),
        )

    @cached_property
    def teaching(self) -> DataFrame:
        """Teaching nodes: the articles under other names; one language has the wrong Part."""
        d = F.col("doc_id")
        part = text_of(F.pmod(d, F.lit(4)) + 1)
        roman = pick(ROMAN, F.when(F.col("lang") == "es", d + 1).otherwise(d))
        unit = text_of(F.pmod(d, F.lit(12)) + 1)
        cited = F.concat(F.lit("Teaching, Part "), roman, F.lit(", Article "), unit, F.lit(" : "), F.col("title"))
        return self.articles.select(
            "doc_id", F.concat(F.lit("catechism.p"), part, F.lit(".art"), unit, F.lit(".s1"), text_of(d)).alias("id"),
            cited.alias("citation"), "title", F.lit("teaching").alias("work"), "text", "segments", "citations_out",
        )

    @cached_property
    def english(self) -> DataFrame:
        """English verses: document lines."""
        return verse_rows(self.lines, F.col("doc_id"), F.col("i") + 1, collapse_ws(F.col("line")), "drb").select(
            "*", F.col("book").alias("douay_book")
        )

    @cached_property
    def latin_raw(self) -> DataFrame:
        """Latin verses before cleaning: conversation turns with layout marks."""
        marked = F.concat(F.lit("<Chorus> "), F.replace("text", F.lit(", "), F.lit(" / ")))
        rows = self.conversations.select("conv_id", "turn", marked.alias("raw"))
        return verse_rows(rows, F.col("conv_id"), F.col("turn").cast("int") + 1, F.col("raw"), "vg").withColumnRenamed("text", "raw")

    @cached_property
    def latin(self) -> DataFrame:
        return self.latin_raw.withColumn("text", clean_latin(F.col("raw"))).withColumn(
            "latin_book", F.concat(F.lit("Liber "), F.col("book"))
        )

    @cached_property
    def pericopes(self) -> DataFrame:
        """Commentary nodes: one per document, fragments are its lines."""
        d = F.col("doc_id")
        first = (F.pmod(F.col("n_chars"), F.lit(30)) + 1).cast("int")
        last = first + F.pmod(d, F.lit(3)).cast("int")
        slug, chapter = pick(canon.GOSPELS, d), text_of(F.pmod(div(d, 4), F.lit(28)) + 1)
        place = F.concat(chapter, F.lit(":"), text_of(first), F.when(last != first, F.concat(F.lit("-"), text_of(last))).otherwise(""))
        keys = F.transform(F.sequence(first, last), lambda v: F.concat_ws("/", slug, chapter, text_of(v)))
        return self.doc_lines.select(
            "doc_id",
            F.concat_ws(".", F.lit("chain"), slug, chapter, text_of(first), text_of(d)).alias("id"),
            F.concat(F.lit("Golden Chain, "), book_name(slug), F.lit(" "), place).alias("citation"),
            F.lit("golden-chain").alias("work"),
            slug.alias("slug"),
            F.array(F.lit("Golden Chain"), F.concat(F.lit("Gospel of "), book_name(slug)), F.concat(F.lit("Chapter "), chapter)).alias("path"),
            F.element_at("lines", 1).alias("lemma"),
            F.array_join("lines", "\n\n").alias("text"),
            F.transform(
                "lines",
                lambda l, i: F.struct(
                    F.lit("father").alias("role"),
                    normalize_father(pick(SPEAKERS, F.length(l) + i)).alias("father"),
                    l.alias("text"),
                ),
            ).alias("segments"),
            keys.alias("commented_verse_keys"),
            F.transform("lines", lambda l, i: citation(d, i, F.length(l))).alias("citations_out"),
        )

    @cached_property
    def foreign_readings(self) -> DataFrame:
        """Dated foreign gospel references: one per order date, from its lowest key."""
        per_day = self.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.min("o_orderkey").alias("m"))
        m = F.col("m")
        c, v = F.pmod(m, F.lit(10)) + 1, F.pmod(m, F.lit(20)) + 1
        say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else text_of(p) for p in parts])
        style = F.pmod(m, F.lit(5))
        raw = (
            F.when(style == 0, say("Mt ", c, ", ", v, "–", v + 3))
            .when(style == 1, say("Marc ", c, ", ", v, ".", v + 3, "-", v + 5))
            .when(style == 2, say("Stabat Mater. Lc ", c, ", ", v, "-", v + 3))
            .when(style == 3, say("Jn ", c, ", ", v, "-", c + 1, ", 2"))
            .otherwise(say("Ps ", c, ", ", v))
        )
        return per_day.select("date", "m", raw.alias("raw"))

    @cached_property
    def readings(self) -> DataFrame:
        rows = self.foreign_readings.select("date", norm_gospel(F.col("raw")).alias("gospel"))
        return rows.filter(F.col("gospel").isNotNull())

    @cached_property
    def references(self) -> DataFrame:
        """Reference requests, one per benchmark item: verse, range or chapter."""
        b = F.col("item_id")
        name = pick(PRINTED, b)
        c, v = F.pmod(b, F.lit(9)) + 1, F.pmod(b, F.lit(12)) + 1
        style = F.pmod(b, F.lit(3))
        ref = (
            F.when(style == 0, F.concat(name, F.lit(" "), text_of(c), F.lit(":"), text_of(v)))
            .when(style == 1, F.concat(name, F.lit(" "), text_of(c), F.lit(":"), text_of(v), F.lit("-"), text_of(v + 4)))
            .otherwise(F.concat(name, F.lit(" "), text_of(c)))
        )
        return self.benchmark.select(b.alias("request_id"), ref.alias("reference"))

    @cached_property
    def citation_requests(self) -> DataFrame:
        """Article requests, one per benchmark item; some name no article."""
        b = F.col("item_id")
        shown = pick([p[1] for p in canon.PARTS], b)
        text = F.concat(F.lit("ST "), shown, F.lit(", q."), text_of(div(b, 8) + 1), F.lit(", a."), text_of(F.pmod(b, F.lit(9)) + 1))
        asked = F.when(F.pmod(b, F.lit(7)) == 6, F.lit("no such place")).when(
            F.pmod(b, F.lit(7)) == 5, F.lower(text)
        ).otherwise(text)
        return self.benchmark.select(b.alias("request_id"), asked.alias("citation"))

    @cached_property
    def questions(self) -> DataFrame:
        """Search requests: each benchmark text, and the same text spelled backwards."""
        forward = self.benchmark.select((F.col("item_id") * 2).alias("query_id"), F.col("text").alias("query"))
        backward = self.benchmark.select((F.col("item_id") * 2 + 1).alias("query_id"), F.reverse("text").alias("query"))
        return forward.unionByName(backward)


def opening(i: Column, length: Column) -> Column:
    """How a paragraph begins, by its position and length."""
    kind = F.pmod(length + i, F.lit(5))
    number = text_of(i + 1)
    out = F.lit("")
    for k, form in enumerate(OPENINGS):
        head, _, tail = form.partition("%d")
        said = F.concat(F.lit(head), number, F.lit(tail)) if "%d" in form else F.lit(form)
        out = F.when(kind == k, said).otherwise(out)
    return out


def citation(d: Column, i: Column, length: Column) -> Column:
    """One outbound citation per line, in one of eight written forms."""
    name = pick(PRINTED, d + i * 7 + length)
    style = F.pmod(length + i, F.lit(8))
    c, v = F.pmod(length, F.lit(30)) + 1, F.pmod(length * 3 + i, F.lit(25)) + 1
    w = v + F.pmod(length, F.lit(4)) - 1
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    c, v, w = text_of(c), text_of(v), text_of(w)
    raw = (
        F.when(style == 1, say(name, " ", c))
        .when(style == 2, say(name, " ", c, ":", v, "-", w))
        .when(style == 3, say(name, " ", c, ":", v, ", seqq."))
        .when(style == 4, say("  ", name, "   ", c, ":", v, " "))
        .when(style == 5, say(name, " ", c, ":", v, " \u2013 ", w))
        .when(style == 6, F.lit("Holy Writ"))
        .otherwise(say(name, " ", c, ":", v))
    )
    kind = F.when(style == 7, "internal").otherwise("scripture")
    return F.struct(raw.alias("raw"), kind.alias("kind"), F.lit(None).cast("string").alias("target_id"))


def internal_note(d: Column, i: Column) -> Column:
    """A reference to another article, one per line."""
    t = div(d, 2) + i * 13
    shown = F.when((F.pmod(i, F.lit(5)) == 3) & (F.pmod(t, F.lit(5)) == 4), "Supplement").otherwise(
        pick([p[1] for p in canon.PARTS], t)
    )
    part = F.when(F.pmod(i, F.lit(5)) == 4, "XIII").otherwise(shown)
    return F.concat(F.lit(" see "), part, F.lit(" : "), text_of(div(t, 40) + 1), F.lit(":0"), text_of(F.pmod(div(t, 5), F.lit(8)) + 1), F.lit("."))


def verse_rows(rows: DataFrame, number: Column, verse: Column, text: Column, prefix: str) -> DataFrame:
    """Rows placed in the canon: book and chapter by row number."""
    slug, chapter = pick(canon.BOOK_SLUGS, number), (div(number, len(canon.BOOK_SLUGS)) + 1).cast("int")
    placed = rows.select(slug.alias("slug"), chapter.alias("chapter"), verse.cast("int").alias("verse"), text.alias("text"))
    c, v = text_of(F.col("chapter")), text_of(F.col("verse"))
    return placed.select(
        F.concat_ws(".", F.lit(prefix), "slug", c, v).alias("id"),
        F.concat(book_name(F.col("slug")), F.lit(" "), c, F.lit(":"), v).alias("citation"),
        book_name(F.col("slug")).alias("book"),
        "slug", "chapter", "verse",
        F.concat_ws("/", "slug", c, v).alias("verse_key"),
        "text",
    )
