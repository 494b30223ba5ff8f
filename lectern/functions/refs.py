"""Reference functions: free text to canonical book, chapter and verse keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import canon
from .columns import first_by, let, literal_map, unfold
from .text import SPACE, extract_links, html_to_text

S = SPACE
_IN = SPACE[1:-1]

# The shapes a reference may take.
OPEN_RANGE = rf"(?i),?{S}*(seqq?|sqq)\.?{S}*$"
REFERENCE = (
    rf"^{S}*([1-4]?{S}?[A-Za-z][A-Za-z.'{_IN}]*?){S}+([0-9]+)"
    rf"(?::([0-9]+)(?:{S}*[-–]{S}*([0-9]+))?)?{S}*$"
)
INTERNAL = r"\b(I-II|II-II|III|Supplement|Suppl\.?|I)\s*:\s*([0-9]+)\s*:\s*([0-9]+)"
INLINE = r"\b((?:[1-4]\s)?[A-Z][a-z]+(?:\s[A-Z][a-z]+)?)\s([0-9]+):([0-9]+)(?:\s*[-–]\s*([0-9]+))?"
ARTICLE_CITATION = r"(?i)^\s*ST\s+(I-II|II-II|III|Suppl\.|I)\s*,\s*q\.([0-9]+)\s*,\s*a\.([0-9]+)"
ARTICLE_TYPED = r"(?i)^\s*(?:st\s+)?(i-ii|ii-ii|iii|suppl|i)\b[\s.,]*q\.?\s*([0-9]+)[\s.,]*a\.?\s*([0-9]+)"
NUMBERS = r"([0-9]+)\s*:\s*([0-9]+)(?:\s*[-–—]\s*([0-9]+))?"

NORM_TYPE = (
    "struct<book:string,slug:string,chapter:int,verse_start:int,verse_end:int,"
    "ref:string,chapter_key:string>"
)
_MARK = "\x01"


def book_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), rf"[{_IN}.]", "")


def resolve_book(name: Column) -> Column:
    """Slug of a printed or modern book name, NULL when unknown."""
    return F.try_element_at(literal_map(canon.ALIASES), book_key(name))


def book_name(slug: Column) -> Column:
    return F.try_element_at(literal_map(canon.NAME_OF), slug)


def alias_override(printed: Column) -> Column:
    """Slug of a title as one old edition prints it (six titles mean other books)."""
    modern = F.coalesce(F.try_element_at(literal_map(canon.PRINTED_TITLES), printed), printed)
    return resolve_book(modern)


def strip_seqq(raw: Column) -> Column:
    return F.regexp_replace(raw, OPEN_RANGE, "")


def expand_range(chapter_key: Column, first: Column, last: Column) -> Column:
    """Verse keys first..last; a backwards range means its first verse only."""
    return F.transform(
        F.sequence(first, F.greatest(first, last)),
        lambda v: F.concat(chapter_key, F.lit("/"), v.cast("string")),
    )


def normalize_ref(raw: Column) -> Column:
    """Raw citation to the ``NORM_TYPE`` struct, NULL when it cannot be read."""
    # One regex pass: rewrite to the four groups, then split; text that does not match
    # comes back unchanged and yields a single cell.
    marked = F.regexp_replace(strip_seqq(F.translate(raw, _MARK, "")), REFERENCE, _MARK.join(["$1", "$2", "$3", "$4"]))

    def build(cells: Column) -> Column:
        slug = resolve_book(F.element_at(cells, 1))
        number = lambda i: F.element_at(cells, i).try_cast("int")
        return let(
            F.struct(
                slug.alias("slug"),
                number(2).alias("chapter"),
                number(3).alias("first"),
                F.greatest(number(3), F.coalesce(number(4), number(3))).alias("last"),
            ),
            finish,
        )

    def finish(p: Column) -> Column:
        name, key = book_name(p["slug"]), F.concat_ws("/", p["slug"], p["chapter"].cast("string"))
        ref = F.concat(name, F.lit(" "), p["chapter"].cast("string"))
        verse_ref = F.concat(
            ref,
            F.lit(":"),
            p["first"].cast("string"),
            F.when(p["last"] != p["first"], F.concat(F.lit("-"), p["last"].cast("string"))).otherwise(""),
        )
        return F.when(
            p["slug"].isNotNull() & p["chapter"].isNotNull(),
            F.struct(
                name.alias("book"),
                p["slug"].alias("slug"),
                p["chapter"].alias("chapter"),
                p["first"].alias("verse_start"),
                p["last"].alias("verse_end"),
                F.when(p["first"].isNull(), ref).otherwise(verse_ref).alias("ref"),
                key.alias("chapter_key"),
            ),
        )

    return let(F.split(marked, _MARK, -1), lambda c: F.when(F.size(c) == 4, build(c))).cast(NORM_TYPE)


def verse_keys(norm: Column) -> Column:
    """All keys of a reference as one list, for references known to be short."""
    return F.when(norm["verse_start"].isNotNull(), expand_range(norm["chapter_key"], norm["verse_start"], norm["verse_end"])).when(
        norm["chapter_key"].isNotNull(), F.array(norm["chapter_key"])
    )


def unfold_keys(rows: DataFrame, norm: str = "norm", name: str = "key") -> DataFrame:
    """One row per key of the references ``norm``, however wide a range is written."""
    n = F.col(norm)
    numbers = unfold(rows, F.coalesce(n["verse_start"], F.lit(0)), F.coalesce(n["verse_end"], F.lit(0)), "_verse")
    key = F.when(n["verse_start"].isNull(), n["chapter_key"]).otherwise(F.concat_ws("/", n["chapter_key"], F.col("_verse").cast("string")))
    return numbers.withColumn(name, key).drop("_verse")


def verse_number(key: Column) -> Column:
    """The verse of a verse key, NULL for a chapter key."""
    return F.try_element_at(F.split(key, "/"), F.lit(3)).try_cast("int")


def union_keys(norm: Column) -> Column:
    """Verse keys plus the chapter key, distinct, for references known to be short."""
    return F.array_union(verse_keys(norm), F.array(norm["chapter_key"]))


def first_key(norm: Column) -> Column:
    """Key whose citers a lookup reports: the chapter, or the first verse of a range."""
    return F.when(norm["chapter_key"].isNotNull(), F.concat_ws("/", norm["chapter_key"], norm["verse_start"].cast("string")))


def is_verse_key(key: Column) -> Column:
    return F.size(F.split(key, "/")) == 3


def in_gospels(key: Column) -> Column:
    return F.split_part(key, F.lit("/"), F.lit(1)).isin(canon.GOSPELS)


def key_to_ref(key: Column) -> Column:
    """``slug/c/v`` to ``slug c:v``; chapter keys stay as they are."""
    p = F.split(key, "/")
    return F.when(
        is_verse_key(key),
        F.concat(F.element_at(p, 1), F.lit(" "), F.element_at(p, 2), F.lit(":"), F.try_element_at(p, F.lit(3))),
    ).otherwise(key)


def father_verse_ref(key: Column) -> Column:
    """``slug/c/v`` to ``Slug c:v``."""
    p = F.split(key, "/")
    slug = F.element_at(p, 1)
    shown = F.concat(F.upper(F.substring(slug, 1, 1)), F.lower(slug.substr(F.lit(2), F.length(slug))))
    return F.concat(shown, F.lit(" "), F.element_at(p, 2), F.lit(":"), F.element_at(p, 3))


def part_of(article_id: Column) -> Column:
    return F.coalesce(F.try_element_at(F.split(article_id, r"\."), F.lit(3)), F.lit(""))


def _article_id(part: Column, question: Column, article: Column) -> Column:
    return F.concat(F.lit("summa.st."), part, F.lit(".q"), question, F.lit(".a"), article)


def citation_to_id(citation: Column) -> Column:
    """Article id written in a printed citation, NULL when it is not one."""
    group = lambda i: F.regexp_extract(citation, ARTICLE_CITATION, i)
    part = F.regexp_replace(F.lower(group(1)), r"\.$", "")
    return F.when(citation.rlike(ARTICLE_CITATION), _article_id(part, group(2), group(3)))


def typed_citation_to_id(text: Column) -> Column:
    """As ``citation_to_id`` for the looser form people type; zeros in front go."""
    group = lambda i: F.regexp_extract(text, ARTICLE_TYPED, i)
    number = lambda i: group(i).try_cast("long").cast("string")
    return F.when(text.rlike(ARTICLE_TYPED), _article_id(F.lower(group(1)), number(2), number(3)))


def parse_internal_refs(text: Column) -> Column:
    """Distinct article ids that a text names as ``PART:Q:A``, in order."""
    part_slug = {p[1].upper().rstrip("."): p[0] for p in canon.PARTS} | {"SUPPLEMENT": "suppl"}

    def to_id(match: Column) -> Column:
        cells = F.split(match, r"\s*:\s*")
        part = F.regexp_replace(F.upper(F.element_at(cells, 1)), r"\.$", "")
        number = lambda i: F.element_at(cells, i).cast("long").cast("string")
        return _article_id(F.try_element_at(literal_map(part_slug), part), number(2), number(3))

    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(INTERNAL), F.lit(0)), to_id))


def _citation(raw: Column) -> Column:
    return F.struct(
        raw.alias("raw"), F.lit("scripture").alias("kind"), F.lit(None).cast("string").alias("target_id")
    )


def _dedup_by_ref(raws: Column) -> Column:
    """Raw references that normalize, first one per normalized form."""
    pairs = F.transform(raws, lambda r: F.struct(r.alias("raw"), normalize_ref(r)["ref"].alias("ref")))
    kept = let(F.filter(pairs, lambda p: p["ref"].isNotNull()), lambda ps: first_by(ps, lambda p: p["ref"]))
    return F.transform(kept, lambda p: _citation(p["raw"]))


def inline_refs(text: Column) -> Column:
    """Citations written out in running text, kept only when the book is known."""

    def recompose(match: Column) -> Column:
        group = lambda i: F.regexp_extract(match, INLINE, i)
        tail = F.when(group(4) != "", F.concat(F.lit("-"), group(4))).otherwise("")
        return F.concat(group(1), F.lit(" "), group(2), F.lit(":"), group(3), tail)

    return _dedup_by_ref(F.transform(F.regexp_extract_all(text, F.lit(INLINE), F.lit(0)), recompose))


def link_refs(page: Column, path: str = "/bible/") -> Column:
    """Anchors into a scripture tree as citations."""
    return F.transform(extract_links(page, path), _citation)


def collect_xrefs(fragment: Column, tree: str = "/douay-rheims-bible/") -> Column:
    """Anchors whose address names the book and whose text holds the numbers."""
    pattern = rf'(?is)<a\s+href="{tree}([a-z0-9-]+)\.shtml#[^"]*"[^>]*>(.*?)</a>'
    books = F.regexp_extract_all(fragment, F.lit(pattern), F.lit(1))
    texts = F.regexp_extract_all(fragment, F.lit(pattern), F.lit(2))

    def raw(book: Column, text: Column) -> Column:
        shown = html_to_text(text)
        name = book_name(resolve_book(book))
        group = lambda i: F.regexp_extract(shown, NUMBERS, i)
        tail = F.when(group(3) != "", F.concat(F.lit("-"), group(3))).otherwise("")
        whole = F.concat(name, F.lit(" "), group(1), F.lit(":"), group(2), tail)
        chapter = F.nullif(F.regexp_extract(shown, "[0-9]+", 0), F.lit(""))
        return F.when(shown.rlike(NUMBERS), whole).otherwise(F.concat(name, F.lit(" "), chapter))

    raws = F.filter(F.zip_with(books, texts, raw), lambda r: r.isNotNull())
    return let(raws, _dedup_by_ref)


def gospel_spans(ref: Column) -> Column:
    """Comma list of verse ranges to ``struct<slug, spans, parse_status>``.

    A span is ``(ch1, v1, ch2, v2)``. A range may run into the next chapter and later
    items continue in the chapter reached; such references are marked, not lost.
    """
    pattern = rf"(?i)^{S}*([1-4]?{S}*[a-z][a-z.'{_IN}]*?){S}+([0-9]+){S}*:{S}*(.+)$"
    item = rf"^(?:([0-9]+):)?([0-9]+)[a-z]?(?:{S}*[-–]{S}*(?:([0-9]+):)?([0-9]+)[a-z]?)?"
    slug = resolve_book(F.regexp_extract(ref, pattern, 1))
    start = F.regexp_extract(ref, pattern, 2).try_cast("int")
    span_type = "struct<ch1:int,v1:int,ch2:int,v2:int>"

    def parse(text: Column) -> Column:
        group = lambda i: F.regexp_extract(text, item, i).try_cast("int")
        return F.struct(group(1).alias("ch1"), group(2).alias("v1"), group(3).alias("ch2"), group(4).alias("v2"))

    def step(spans: Column, p: Column) -> Column:
        here = F.coalesce(p["ch1"], F.try_element_at(spans, F.lit(-1))["ch2"], start)
        there = F.coalesce(p["ch2"], here)
        last = F.coalesce(p["v2"], p["v1"])
        span = F.struct(here.alias("ch1"), p["v1"].alias("v1"), there.alias("ch2"), last.alias("v2")).cast(span_type)
        return F.when(p["v1"].isNull(), spans).otherwise(F.concat(spans, F.array(span)))

    items = F.transform(
        F.split(F.regexp_extract(ref, pattern, 3), ","), lambda t: parse(F.regexp_replace(t, rf"^{S}+|{S}+$", ""))
    )
    spans = F.aggregate(items, F.array().cast(f"array<{span_type}>"), step)

    def finish(s: Column) -> Column:
        crossed = F.exists(s, lambda x: (x["ch1"] != start) | (x["ch2"] != start))
        status = F.when(F.size(s) == 0, "unparsed").when(crossed, "cross-chapter").otherwise("single-chapter")
        return F.struct(slug.alias("slug"), s.alias("spans"), status.alias("parse_status"))

    return F.when(slug.isNotNull() & start.isNotNull(), let(spans, finish))
