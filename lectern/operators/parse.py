"""Page and text parsing: raw rows to sections, paragraphs, verses and nodes.

A source row is parsed inside that row with array expressions. Raw text is never
exploded and shuffled just to find out which line follows which.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import canon, schemas
from ..functions.columns import let
from ..functions.refs import NUMBERS, alias_override, book_name, collect_xrefs, inline_refs, link_refs, normalize_ref, verse_keys
from ..functions.text import (
    LINE_END,
    SPACE,
    classify_segment,
    clean_latin,
    collapse_ws,
    extract_elements,
    html_to_text,
    join_segments,
    normalize_father,
    strip_verse_marker,
)
from ..session import settle

# The line shapes of the plain-text editions and pages.
CHAPTER_LINE = r"(?m)^([0-9]? ?[A-Za-z][A-Za-z ]*?) Chapter ([0-9]+)\.?[^\S\n]*$"
VERSE_LINE = r"(?s)^([0-9]+):([0-9]+)\.\s*(.*)$"
LATIN_LINE = r"^([0-9]+):([0-9]+)\s+(.*)$"
QUESTION_HEAD = r"(?is)^Question\s+([0-9]+)\.?\s*(.*)$"
ARTICLE_HEAD = r"(?is)^Article\s+([0-9]+)\.?\s*(.*)$"

_BLANK = "[" + SPACE[1:-1].replace(r"\x09-\x0d", r"\x09\x0b-\x0d") + "]*"
_HEAD, _HEAD_END, _BODY, _BODY_END = "\x02", "\x04", "\x03", "\x05"


# --- plain text ------------------------------------------------------------------


def section_slices(text: Column, header: str = CHAPTER_LINE) -> Column:
    """``array<string>``: from each header line to just before the next one."""
    flags = "(?m)" if header.startswith("(?m)") else ""
    body = header[len(flags):]
    return F.filter(F.split(text, f"{flags}(?={body})", -1), lambda s: s.rlike(f"{flags}\\A(?:{body})"))


def paragraph_grouping(chunk: Column) -> Column:
    """Paragraphs of a double-spaced text: two blank lines break, one only wraps."""
    unified = F.regexp_replace(chunk, LINE_END, "\n")
    trimmed = lambda line: F.regexp_replace(line, rf"^{SPACE}+|{SPACE}+$", "")
    joined = F.transform(
        F.split(unified, rf"\n(?:{_BLANK}\n){{2,}}", -1),
        lambda p: F.array_join(F.filter(F.transform(F.split(p, "\n", -1), trimmed), lambda l: l != ""), " "),
    )
    return F.filter(joined, lambda p: p != "")


def printed_verses(paragraphs: Column) -> Column:
    """``array<struct<chapter, printed, text>>`` of the paragraphs that are verses."""
    marked = F.filter(paragraphs, lambda p: p.rlike(VERSE_LINE))
    group = lambda p, i: F.regexp_extract(p, VERSE_LINE, i)
    return F.transform(
        marked,
        lambda p: F.struct(
            group(p, 1).try_cast("int").alias("chapter"),
            group(p, 2).try_cast("int").alias("printed"),
            collapse_ws(group(p, 3)).alias("text"),
        ),
    )


def renumber_restarts(items: Column) -> Column:
    """Printed numbers to unique rising ones.

    A restart continues from the number reached; a repeated number adds its text to
    the verse it repeats. Each emitted number feeds the next decision, so this is a
    fold over one chapter's verses.
    """
    out_type = "array<struct<verse:int,text:string>>"

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        reached = F.coalesce(last["verse"], F.lit(0))
        fresh = lambda n: F.struct(n.cast("int").alias("verse"), x["text"].alias("text"))
        merged = F.struct(reached.alias("verse"), F.concat(last["text"], F.lit(" "), x["text"]).alias("text"))
        return (
            F.when(x["printed"] > reached, F.concat(acc, F.array(fresh(x["printed"]))))
            .when(
                (x["printed"] == reached) & last.isNotNull(),
                F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(merged)),
            )
            .when(x["printed"] < reached, F.concat(acc, F.array(fresh(reached + 1))))
            .otherwise(acc)
            .cast(out_type)
        )

    return F.aggregate(items, F.array().cast(out_type), step)


#: What renumbering may have to note: a repeated number whose text was added to the verse
#: before it, a restart at 1 that was continued, a number that fits neither.
MERGED, CONTINUED_NUMBERING, UNHANDLED = "merged", "continued", "unhandled"


def numbering_anomalies(items: Column) -> Column:
    """``array<struct<kind, printed, verse>>``: what ``renumber_restarts`` changes in a chapter.

    Only the number reached is carried along; a chapter without anomalies builds no list.
    """
    notes = "array<struct<kind:string,printed:int,verse:int>>"
    start = F.struct(F.lit(0).alias("reached"), F.lit(False).alias("any"), F.array().cast(notes).alias("notes"))

    def step(s: Column, x: Column) -> Column:
        printed, reached = x["printed"], s["reached"]
        note = lambda kind, verse: F.struct(F.lit(kind).alias("kind"), printed.cast("int").alias("printed"), verse.cast("int").alias("verse"))
        add = (
            F.when((printed == reached) & s["any"], note(MERGED, reached))
            .when((printed < reached) & (printed == 1), note(CONTINUED_NUMBERING, reached + 1))
            .when((printed == reached) | printed.isNull(), note(UNHANDLED, reached))
        )
        now = F.when(printed > reached, printed.cast("int")).when(printed < reached, reached + 1).otherwise(reached)
        return F.struct(
            now.alias("reached"), (s["any"] | F.coalesce(printed != reached, F.lit(False))).alias("any"),
            F.when(add.isNull(), s["notes"]).otherwise(F.concat(s["notes"], F.array(add))).cast(notes).alias("notes"),
        )

    return F.aggregate(items, start, step)["notes"]


def _chapters(sections: DataFrame) -> DataFrame:
    """``(douay_book, slug, chapter, printed)`` of a column ``section``, one row a known chapter."""
    heads = sections.select(
        "section",
        F.trim(F.regexp_extract("section", CHAPTER_LINE, 1)).alias("douay_book"),
        F.regexp_extract("section", CHAPTER_LINE, 2).try_cast("int").alias("chapter"),
    ).withColumn("slug", alias_override(F.col("douay_book")))
    body = F.regexp_replace("section", "(?m)\\A(?:" + CHAPTER_LINE[4:] + ")", "")
    return heads.filter(F.col("slug").isNotNull()).withColumn("printed", printed_verses(paragraph_grouping(body)))


def _sections(texts: DataFrame, text: str) -> DataFrame:
    return texts.select(F.explode(section_slices(F.col(text))).alias("section"))


def _pieces(batches):
    """``(file, block, number, section)``: the lines of a split from each header on, and those before its first as 0."""
    names = ["file", "block", "number", "section"]
    last, number, held = None, 0, []
    for batch in batches:
        files, blocks, heads, values = (batch.column(c).to_pylist() for c in ("file", "block", "head", "value"))
        out = []
        for here, head, value in zip(zip(files, blocks), heads, values):
            if head or here != last:
                if held:
                    out.append((*last, number, "\n".join(held)))
                number = head + (number if here == last else 0)
                last, held = here, []
            held.append(value)
        if out:
            yield _piece_batch(out, names)
    if held:
        yield _piece_batch([(*last, number, "\n".join(held))], names)


def _piece_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def sections_of_lines(lines: DataFrame) -> DataFrame:
    """``(section)`` of lines ``(file, block, value)``: from each header line to the next.

    The lines of a split ``block`` stand together and in order, as ``scan_lines`` reads them. A
    task cuts its splits at the headers; only a split's first and last piece may go on in
    another split. Those are numbered by the headers of the splits before and put together,
    so a section may run over any number of splits and no line is shuffled. Lines before a
    file's first header are in no section.
    """
    header = CHAPTER_LINE[4:]
    marked = lines.select("file", "block", F.col("value").rlike(header).cast("int").alias("head"), "value")
    pieces = settle(marked.mapInArrow(_pieces, "file string, block long, number long, section string"), "edition-pieces")
    heads = pieces.groupBy("file", "block").agg(F.max("number").alias("heads"))
    before = F.sum("heads").over(Window.partitionBy("file").orderBy("block")) - F.col("heads")
    # A written table: while it is small by its size the pieces stay where they are.
    starts = settle(heads.select("file", "block", "heads", before.alias("before")), "edition-splits")
    placed = pieces.join(starts, ["file", "block"])
    inner = placed.where("number > 0 AND number < heads").select("section")
    edge = placed.where("number = 0 OR number = heads").select("file", (F.col("before") + F.col("number")).alias("number"), "block", "section")
    edge = edge.where("number > 0").groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "section"))).alias("held"))
    return inner.unionByName(edge.select(F.array_join(F.transform("held", lambda x: x["section"]), "\n").alias("section")))


def _anomalies(chapters: DataFrame) -> DataFrame:
    return chapters.select("slug", "chapter", F.explode(numbering_anomalies(F.col("printed"))).alias("a")).select("slug", "chapter", "a.*")


def edition_anomalies(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(slug, chapter, kind, printed, verse)`` of an edition's chapters, as ``parse_edition`` reads them."""
    return _anomalies(_chapters(_sections(texts, text)))


def edition_lines_anomalies(lines: DataFrame) -> DataFrame:
    return _anomalies(_chapters(sections_of_lines(lines)))


def parse_edition(texts: DataFrame, text: str = "text") -> DataFrame:
    """A plain-text English edition to verse rows.

    A verse whose marker names another chapter than its header gets ``drift`` true
    instead of stopping the job.
    """
    return _edition_verses(_chapters(_sections(texts, text)))


def parse_edition_lines(lines: DataFrame) -> DataFrame:
    """``parse_edition`` of an edition that is read line by line (``scan_lines``), of any size."""
    return _edition_verses(_chapters(sections_of_lines(lines)))


def _edition_verses(verses: DataFrame) -> DataFrame:
    rows = verses.select(
        "douay_book", "slug", "chapter",
        F.exists("printed", lambda p: p["chapter"] != F.col("chapter")).alias("drift"),
        F.explode(renumber_restarts(F.col("printed"))).alias("v"),
    )
    return _verse_rows(rows.select("*", F.col("v.verse").alias("verse"), F.col("v.text").alias("text")), "drb", "douay-rheims")


def parse_latin(lines_df: DataFrame, line: str = "value", slug: str = "slug", latin_book: str = "latin_book") -> DataFrame:
    """Lines ``c:v text`` of a Latin edition to verse rows."""
    value = F.regexp_replace(F.col(line), r"\s+$", "")
    group = lambda i: F.regexp_extract(value, LATIN_LINE, i)
    rows = lines_df.filter(value.rlike(LATIN_LINE)).select(
        F.col(slug).alias("slug"),
        F.col(latin_book).alias("latin_book"),
        group(1).try_cast("int").alias("chapter"),
        group(2).try_cast("int").alias("verse"),
        clean_latin(group(3)).alias("text"),
        F.lit("la").alias("lang"),
    )
    return _verse_rows(rows, "vg", "clementine-vulgate")


def _verse_rows(rows: DataFrame, prefix: str, work: str) -> DataFrame:
    book = book_name(F.col("slug"))
    testament = F.when(F.col("slug").isin(canon.NEW_TESTAMENT), "New Testament").otherwise("Old Testament")
    number = lambda c: F.col(c).cast("string")
    return rows.drop("v").select(
        F.concat_ws(".", F.lit(prefix), F.col("slug"), number("chapter"), number("verse")).alias("id"),
        F.lit(work).alias("work"),
        F.concat(book, F.lit(" "), number("chapter"), F.lit(":"), number("verse")).alias("citation"),
        F.lit("").alias("title"),
        F.array(testament, book, F.concat(F.lit("Chapter "), number("chapter"))).alias("path"),
        F.lit("verse").alias("type"),
        book.alias("book"),
        F.concat_ws("/", F.col("slug"), number("chapter"), number("verse")).alias("verse_key"),
        *[c for c in rows.columns if c != "v"],
    )


# --- provenance ------------------------------------------------------------------


def sourced(nodes: DataFrame, **fields: Column | str) -> DataFrame:
    """Nodes with their ``source``: the named fields, the others empty.

    A field is a text or a column of the nodes, such as a page's address. Lists that an
    edition does not have (path, segments, citations) are empty lists, as node files need.
    """
    kind = StructType.fromDDL(f"s {schemas.SOURCE}")["s"].dataType
    if unknown := set(fields) - set(kind.names):
        raise ValueError(f"no such fields of a source: {sorted(unknown)}")
    cell = lambda v: v if isinstance(v, Column) else F.lit(v)
    held = F.struct(*[cell(fields.get(n)).cast("string").alias(n) for n in kind.names])
    empty = {"path": "array<string>", "segments": f"array<{schemas.SEGMENT}>", "citations_out": f"array<{schemas.CITATION}>"}
    missing = {c: F.array().cast(t) for c, t in empty.items() if c not in nodes.columns}
    return nodes.withColumns({**missing, "source": held})


# --- pages -----------------------------------------------------------------------


def page_to_nodes(pages: DataFrame, part: str = "part", html: str = "html") -> DataFrame:
    """A question page to one node per article.

    Pages without a heading and articles without a paragraph yield none; the coverage
    check reports what is missing.
    """
    slugs = F.create_map(*[F.lit(x) for i, p in enumerate(canon.PARTS, 1) for x in (i, p[0])])
    shown = F.create_map(*[F.lit(x) for i, p in enumerate(canon.PARTS, 1) for x in (i, p[1])])
    longs = F.create_map(*[F.lit(x) for i, p in enumerate(canon.PARTS, 1) for x in (i, p[2])])
    head = html_to_text(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    pieces = F.filter(
        F.split(html, r'(?i)(?=<h2\s+id="article[0-9])', -1), lambda s: s.rlike(r'(?i)\A<h2\s+id="article[0-9]+"')
    )
    art = r'(?is)\A<h2\s+id="article([0-9]+)"[^>]*>(.*?)</h2>(.*)\z'

    def article(piece: Column) -> Column:
        body = F.regexp_extract(piece, art, 3)
        return F.struct(
            F.regexp_extract(piece, art, 1).cast("int").alias("article"),
            html_to_text(F.regexp_extract(piece, art, 2)).alias("_title"),
            paragraph_segments(body).alias("segments"),
            link_refs(body).alias("citations_out"),
        )

    # Parsed inside the row and unfolded, so the filters below do not parse again.
    found = F.filter(F.transform(pieces, article), lambda a: F.size(a["segments"]) > 0)
    rest = [c for c in pages.columns if c != html]
    rows = (
        pages.select(*rest, head.alias("_head"), F.explode(found).alias("a"))
        .filter(F.col("_head").rlike(QUESTION_HEAD))
        .select(
            *rest, "a.*",
            F.regexp_extract("_head", QUESTION_HEAD, 1).cast("int").alias("question"),
            F.trim(F.regexp_extract("_head", QUESTION_HEAD, 2)).alias("question_title"),
        )
    )
    title = F.when(F.col("_title").rlike(ARTICLE_HEAD), F.trim(F.regexp_extract("_title", ARTICLE_HEAD, 2))).otherwise(
        F.col("_title")
    )
    number = lambda c: F.col(c).cast("string")
    return rows.select(
        F.concat(F.lit("summa.st."), slugs[F.col(part)], F.lit(".q"), number("question"), F.lit(".a"), number("article")).alias("id"),
        F.lit("summa-theologiae").alias("work"),
        F.concat(F.lit("ST "), shown[F.col(part)], F.lit(", q."), number("question"), F.lit(", a."), number("article")).alias("citation"),
        title.alias("title"),
        F.array(
            longs[F.col(part)],
            F.concat(F.lit("Question "), number("question"), F.lit(": "), F.col("question_title")),
            F.concat(F.lit("Article "), number("article")),
        ).alias("path"),
        F.lit("article").alias("type"),
        join_segments(F.col("segments")).alias("text"),
        "segments",
        "citations_out",
        *[c for c in pages.columns if c not in (html, part)],
    )


def paragraph_segments(body: Column) -> Column:
    """Paragraph elements as classified segments, empty ones dropped."""
    texts = F.transform(F.regexp_extract_all(body, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1)), lambda t: html_to_text(t))

    def segment(t: Column) -> Column:
        return let(
            classify_segment(t),
            lambda c: F.struct(
                c["role"].alias("role"), c["n"].alias("n"), F.lit(None).cast("string").alias("father"), t.alias("text")
            ),
        )

    return F.transform(F.filter(texts, lambda t: t != ""), segment)


def attach_continuation(paragraphs: Column) -> Column:
    """``struct<lemma, segments>`` from ``array<struct<father, text>>``.

    A paragraph without a commentator continues the one before it; ahead of the first
    commentator it belongs to the lemma. Marking the joined text and cutting it at the
    marks keeps the work linear in the paragraph count.
    """
    plain = lambda t: F.translate(t, _HEAD + _BODY, "")
    marked = F.transform(
        F.filter(paragraphs, lambda p: p["father"].isNotNull() | (p["text"] != "")),
        lambda p: F.when(
            p["father"].isNotNull(), F.concat(F.lit(_HEAD), plain(p["father"]), F.lit(_BODY), plain(p["text"]))
        ).otherwise(plain(p["text"])),
    )
    pieces = F.split(F.concat(F.lit("\n\n"), F.array_join(marked, "\n\n")), "\n\n" + _HEAD, -1)

    def segment(piece: Column) -> Column:
        cells = F.split(piece, _BODY, 2)
        return F.struct(F.element_at(cells, 1).alias("father"), F.element_at(cells, 2).alias("text"))

    def build(ps: Column) -> Column:
        opening = F.filter(F.split(F.element_at(ps, 1), "\n\n", -1), lambda t: t != "")
        lemma = F.trim(F.array_join(F.filter(F.transform(opening, strip_verse_marker), lambda t: t != ""), " "))
        return F.struct(
            lemma.alias("lemma"), F.transform(F.slice(ps, 2, F.size(ps)), segment).alias("segments")
        )

    return let(pieces, build)


def father_paragraphs(block: Column) -> Column:
    """Plain paragraphs of a page block as ``array<struct<father, text>>``."""
    start = r"(?is)^\s*<strong>(.*?)</strong>\s*[.,:]?\s*"
    return F.transform(
        F.regexp_extract_all(block, F.lit(r"(?s)<p>(.*?)</p>"), F.lit(1)),
        lambda p: F.struct(
            F.when(p.rlike(start), normalize_father(html_to_text(F.regexp_extract(p, start, 1)))).alias("father"),
            html_to_text(F.regexp_replace(p, start, "")).alias("text"),
        ),
    )


# Fixed value: the heading of a commentary page's section, which names its verses.
PERICOPE_HEAD = r'(?is)\A<h3 id="[^"]+">\s*<a href="/[a-z-]+/[a-z0-9-]+\.shtml#[^"]*"[^>]*>([^<]+)</a>\s*</h3>'


def pericope_pages(pages: DataFrame, work: str, name: str, prefix: str, html: str = "html") -> DataFrame:
    """Commentary pages ``(slug, chapter, html)`` to one node per headed section.

    A section's label gives its verses, paragraphs ahead of the first commentator its
    lemma, the others its fragments and their references. Sections without a fragment
    give no node. A label that can't be read or names another chapter is marked ``drift``
    and keeps its text. ``commented_verse_keys`` holds the label's keys; ``clamp_keys``
    tells which of them are verses.
    """
    sections = F.filter(F.split(html, r'(?i)(?=<h3 id=")', -1), lambda b: b.rlike(PERICOPE_HEAD))

    def section(block: Column) -> Column:
        body = F.regexp_replace(block, PERICOPE_HEAD, "")
        # References are read from the fragments only, which begin at the first name.
        spoken = F.regexp_extract(body, r"(?is)(<p>\s*<strong>.*)\z", 1)
        label = html_to_text(F.regexp_extract(block, PERICOPE_HEAD, 1))
        return F.struct(
            label.alias("label"),
            attach_continuation(father_paragraphs(body)).alias("fold"), collect_xrefs(spoken).alias("citations_out"),
        )

    rest = [c for c in pages.columns if c != html]
    found = F.filter(F.transform(sections, section), lambda x: F.size(x["fold"]["segments"]) > 0)
    rows = pages.select(*rest, F.explode(found).alias("s"))
    number = lambda g: F.regexp_extract("s.label", NUMBERS, g)
    last = F.when(number(3) != "", F.concat(F.lit("-"), number(3))).otherwise("")
    book = book_name(F.col("slug"))
    read = rows.withColumn("norm", normalize_ref(F.concat(book, F.lit(" "), number(1), F.lit(":"), number(2), last)))
    n = F.col("norm")
    text = join_segments(F.col("s.fold.segments"))
    return read.select(
        F.concat_ws(".", F.lit(prefix), "slug", n["chapter"].cast("string"), n["verse_start"].cast("string")).alias("id"),
        F.lit(work).alias("work"), F.concat(F.lit(f"{name}, "), n["ref"]).alias("citation"), F.lit("").alias("title"),
        F.array(F.lit(name), F.concat(F.lit("Gospel of "), book), F.concat(F.lit("Chapter "), F.col("chapter").cast("string"))).alias("path"),
        F.lit("father-comment").alias("type"), text.alias("text"), F.col("s.fold.segments").alias("segments"),
        F.col("s.citations_out").alias("citations_out"), F.col("s.fold.lemma").alias("lemma"), verse_keys(n).alias("commented_verse_keys"),
        (n.isNull() | (n["chapter"] != F.col("chapter"))).alias("drift"), *[c for c in rest if c not in ("slug", "chapter")],
    )


def pending_heading_fold(elements: Column, heading: str = "h3") -> Column:
    """Headed units of a flat heading/paragraph run.

    ``array<struct<idx, title, segments>>``: headings without a body, and text ahead of
    the first heading, open the next unit; headings left at the end close the last one.
    A unit boundary is a paragraph followed by a heading, so the encoded run is cut there.
    """
    plain = lambda t: F.translate(t, _HEAD + _HEAD_END + _BODY + _BODY_END, "")
    encoded = F.array_join(
        F.transform(
            elements,
            lambda e: F.when(
                e["tag"] == heading, F.concat(F.lit(_HEAD), plain(e["text"]), F.lit(_HEAD_END))
            ).otherwise(F.concat(F.lit(_BODY), plain(e["text"]), F.lit(_BODY_END))),
        ),
        "",
    )
    runs = F.split(encoded, f"(?<={_BODY_END})(?={_HEAD})", -1)
    items = lambda run: F.regexp_extract_all(run, F.lit(f"[{_HEAD}{_BODY}][^{_HEAD_END}{_BODY_END}]*"), F.lit(0))
    is_head = lambda x: F.substring(x, 1, 1) == _HEAD
    as_text = lambda x: x.substr(F.lit(2), F.length(x))
    segment = lambda role: lambda x: F.struct(F.lit(role).alias("role"), as_text(x).alias("text"))

    def assemble(rs: Column) -> Column:
        whole = F.filter(rs, lambda r: F.contains(r, F.lit(_HEAD)) & F.contains(r, F.lit(_BODY)))
        opening = F.when(~F.contains(F.element_at(rs, 1), F.lit(_HEAD)), items(F.element_at(rs, 1))).otherwise(
            F.array().cast("array<string>")
        )
        closing = F.when(~F.contains(F.element_at(rs, -1), F.lit(_BODY)), items(F.element_at(rs, -1))).otherwise(
            F.array().cast("array<string>")
        )

        def unit(run: Column, i: Column) -> Column:
            def parts(xs: Column) -> Column:
                heads = F.filter(xs, is_head)
                lead = F.slice(heads, 1, F.size(heads) - 1)
                first = F.when(i == 0, F.concat(opening, lead)).otherwise(lead)
                tail = F.when(i == F.size(whole) - 1, closing).otherwise(F.array().cast("array<string>"))
                return F.struct(
                    (i + 1).alias("idx"),
                    as_text(F.element_at(heads, -1)).alias("title"),
                    F.concat(
                        F.transform(first, segment("heading")),
                        F.transform(F.filter(xs, lambda x: ~is_head(x)), segment("paragraph")),
                        F.transform(tail, segment("heading")),
                    ).alias("segments"),
                )

            return let(items(run), parts)

        return F.transform(whole, unit)

    return let(runs, assemble)


def parse_teaching(pages: DataFrame, html: str = "html") -> DataFrame:
    """Headed teaching pages ``(part, code, unit_label, html)`` to nodes."""
    units = pages.select(
        "part", "code", "unit_label", F.explode(pending_heading_fold(extract_elements(F.col(html)))).alias("u")
    )
    roman = F.element_at(F.array(*map(F.lit, ["I", "II", "III", "IV"])), F.col("part"))
    text = join_segments(F.col("u.segments"))
    return units.select(
        F.concat(
            F.lit("catechism.p"), F.col("part").cast("string"), F.lit("."), F.col("code"), F.lit(".s"),
            F.when(F.col("u.idx") < 10, F.concat(F.lit("0"), F.col("u.idx").cast("string"))).otherwise(F.col("u.idx").cast("string")),
        ).alias("id"),
        F.lit("roman-catechism").alias("work"),
        F.concat(F.lit("Roman Catechism, Part "), roman, F.lit(", "), F.col("unit_label"), F.lit(" : "), F.col("u.title")).alias("citation"),
        F.col("u.title").alias("title"),
        F.array(F.concat(F.lit("Part "), roman), F.col("unit_label"), F.col("u.title")).alias("path"),
        F.lit("catechism").alias("type"),
        text.alias("text"),
        F.col("u.segments").alias("segments"),
        inline_refs(text).alias("citations_out"),
    )
