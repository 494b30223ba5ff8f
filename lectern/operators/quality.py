"""Integrity checks: each returns the rows that break a rule; no row means it holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import canon
from ..functions.columns import each, literal_map, unfold
from ..functions.refs import normalize_ref
from ..functions.text import SPACE, clean_latin, collapse_ws, has_verse_marker, join_segments


def unique_id(nodes: DataFrame, key: str = "id") -> DataFrame:
    return nodes.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def unique_text(nodes: DataFrame, text: str = "text") -> DataFrame:
    """Texts that stand in more than one row.

    Rows are counted by a hash of the text; only the texts of repeated hashes travel.
    """
    key = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    hashed = nodes.select(F.col(text), F.struct(key.alias("h"), F.col(text).isNull().alias("none")).alias("_key"))
    counts = hashed.groupBy("_key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    held = hashed.join(counts, "_key", "left_semi").groupBy("_key").agg(F.first(text).alias(text))
    return held.join(counts, "_key").select(text, "n")


def nonempty_text(nodes: DataFrame, text: str = "text") -> DataFrame:
    return nodes.filter(F.coalesce(F.col(text), F.lit("")).rlike(rf"\A{SPACE}*\z"))


def license_present(nodes: DataFrame, license: Column) -> DataFrame:
    return nodes.filter(F.coalesce(license, F.lit("")) == "")


def lossless_rejoin(nodes: DataFrame) -> DataFrame:
    return nodes.filter(~join_segments(F.col("segments")).eqNullSafe(F.col("text")))


def every_segment_has_father(nodes: DataFrame) -> DataFrame:
    return nodes.filter(
        (F.size("segments") == 0) | F.exists("segments", lambda s: F.coalesce(s["father"], F.lit("")) == "")
    )


# The forms an article's id and citation must have.
ARTICLE_ID = r"\Asumma\.st\.(i|i-ii|ii-ii|iii|suppl)\.q([0-9]+)\.a([0-9]+)\z"
ARTICLE_CITATION = r"\AST (I|I-II|II-II|III|Suppl\.), q\.([0-9]+), a\.([0-9]+)\z"


def id_citation_agree(nodes: DataFrame, id_form: str = ARTICLE_ID, citation_form: str = ARTICLE_CITATION,
                      groups: tuple[int, ...] = (2, 3)) -> DataFrame:
    """Ids and citations that do not parse or name different positions."""
    same = F.lit(True)
    for g in groups:
        same = same & (F.regexp_extract("id", id_form, g) == F.regexp_extract("citation", citation_form, g))
    ok = F.col("id").rlike(id_form) & F.col("citation").rlike(citation_form) & same
    return nodes.filter(~ok)


# The forms of a commentary's and a teaching text's ids and citations, the
# latter without the name of the work that opens them.
COMMENTARY_ID = r"\A[a-z-]+\.(matthew|mark|luke|john)\.([0-9]+)\.([0-9]+)\z"
COMMENTARY_CITATION = r"\A[^,]+, (Matthew|Mark|Luke|John) ([0-9]+):([0-9]+)(?:-[0-9]+)?\z"
TEACHING_ID = r"\A[a-z-]+\.p([1-4])\.([a-z0-9-]+)\.s([0-9]{2,})\z"
TEACHING_CITATION = r"(?s)\A[^,]+, Part (I|II|III|IV), .+ : .+\z"
TEACHING_PARTS = {"I": "1", "II": "2", "III": "3", "IV": "4"}


def commentary_position_agree(nodes: DataFrame, id_form: str = COMMENTARY_ID) -> DataFrame:
    """Commentary whose id and citation do not parse or name different places."""
    at = lambda g: F.regexp_extract("citation", COMMENTARY_CITATION, g)
    same = F.lower(at(1)) == F.regexp_extract("id", id_form, 1)
    for g in (2, 3):
        same = same & (at(g) == F.regexp_extract("id", id_form, g))
    return nodes.filter(~(F.col("id").rlike(id_form) & F.col("citation").rlike(COMMENTARY_CITATION) & same))


def keys_in_gospel(pericopes: DataFrame) -> DataFrame:
    """Commented verse keys that lie in another gospel than their commentary's id."""
    keys = pericopes.select("id", each("commented_verse_keys").alias("verse_key"))
    return keys.filter(F.split_part("verse_key", F.lit("/"), F.lit(1)) != F.split_part("id", F.lit("."), F.lit(2)))


def commentary_chapters(pericopes: DataFrame) -> DataFrame:
    """Gospel chapters without commentary; a gospel that is wholly missing shows in full."""
    present = pericopes.select(
        F.split_part("id", F.lit("."), F.lit(2)).alias("slug"),
        F.split_part("id", F.lit("."), F.lit(3)).try_cast("int").alias("chapter"),
    )
    expected = expected_chapters(pericopes.sparkSession).filter(F.col("slug").isin(canon.GOSPELS))
    return coverage_complete(present, expected, ["slug", "chapter"])


def teaching_part_agree(nodes: DataFrame) -> DataFrame:
    """Teaching nodes whose id or citation does not parse or whose Parts differ."""
    part = F.try_element_at(literal_map(TEACHING_PARTS), F.regexp_extract("citation", TEACHING_CITATION, 1))
    ok = F.col("id").rlike(TEACHING_ID) & F.col("citation").rlike(TEACHING_CITATION)
    return nodes.filter(~(ok & part.eqNullSafe(F.regexp_extract("id", TEACHING_ID, 1))))


def missing_parts(nodes: DataFrame) -> DataFrame:
    """Parts of the teaching text that no node has."""
    expected = nodes.sparkSession.createDataFrame([(p,) for p in TEACHING_PARTS.values()], "part string")
    return coverage_complete(nodes.select(F.regexp_extract("id", TEACHING_ID, 1).alias("part")), expected, ["part"])


def verse_position_agree(verses: DataFrame, prefix: str) -> DataFrame:
    """Verses whose id, key or citation differ from their book, chapter and number."""
    slug = F.split_part(F.col("verse_key"), F.lit("/"), F.lit(1))
    c, v = F.col("chapter").cast("string"), F.col("verse").cast("string")
    ok = (
        (F.col("id") == F.concat_ws(".", F.lit(prefix), slug, c, v))
        & (F.col("verse_key") == F.concat_ws("/", slug, c, v))
        & (F.col("citation") == F.concat(F.col("book"), F.lit(" "), c, F.lit(":"), v))
    )
    return verses.filter(~ok)


def coverage_complete(present: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """Expected positions that no row fills."""
    return expected.join(present.select(*on).distinct(), on, "left_anti")


def expected_chapters(spark) -> DataFrame:
    """``(slug, chapter)`` for every book of the canon."""
    counts = spark.createDataFrame(list(canon.CHAPTER_COUNTS.items()), "slug string, chapters int")
    return counts.select("slug", F.explode(F.sequence(F.lit(1), F.col("chapters"))).alias("chapter"))


def expected_questions(spark) -> DataFrame:
    """``(part, question)`` for every part, so a wholly missing part shows up too."""
    counts = spark.createDataFrame([(p[0], p[3]) for p in canon.PARTS], "part string, questions int")
    return counts.select("part", F.explode(F.sequence(F.lit(1), F.col("questions"))).alias("question"))


def missing_units(nodes: DataFrame) -> DataFrame:
    """Numbered units of a four-part teaching text that no node's id names.

    Unit codes are ``art1`` ..., ``cmd1`` ... (``cmd9-10`` counts for both), ``pet1`` ...
    and the seven sacraments by name.
    """
    spark = nodes.sparkSession
    sacraments = {name: str(i) for i, name in enumerate(canon.SACRAMENTS, 1)}
    code = F.regexp_extract("id", r"\Acatechism\.p[1-4]\.([a-z0-9-]+)\.s[0-9]{2,}\z", 1)
    kind = (
        F.when(F.col("code").rlike(r"\Aart[0-9]+\z"), "article").when(F.col("code").rlike(r"\Acmd[0-9]"), "commandment")
        .when(F.col("code").rlike(r"\Apet[0-9]+\z"), "petition").when(F.col("code").isin(list(sacraments)), "sacrament")
    )
    numbers = F.coalesce(F.try_element_at(literal_map(sacraments), F.col("code")), F.regexp_extract("code", "[0-9-]+", 0))
    present = nodes.select(code.alias("code")).distinct().select(
        kind.alias("kind"), F.explode(F.transform(F.split(numbers, "-"), lambda n: n.try_cast("int"))).alias("number")
    )
    spec = spark.createDataFrame(list(canon.TEACHING_UNITS.items()), "kind string, n int")
    expected = spec.select("kind", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("number"))
    return coverage_complete(present, expected, ["kind", "number"])


def contiguity(rows: DataFrame, group: list[str], number: str, start: Column | None = None) -> DataFrame:
    """Groups whose numbers repeat, leave gaps or start elsewhere than expected.

    Numbers are counted per (group, number) first, so a very large group is reduced by
    many tasks and repeats need no distinct set in memory.
    """
    start = F.lit(1) if start is None else start
    counted = rows.groupBy(*group, number).agg(F.count("*").alias("_n"))
    spans = counted.groupBy(*group).agg(
        F.min(number).alias("first"),
        F.max(number).alias("last"),
        F.sum("_n").cast("long").alias("rows"),
        F.count("*").alias("numbers"),
    )
    broken = (
        (F.col("rows") != F.col("numbers"))
        | (F.col("last") - F.col("first") + 1 != F.col("numbers"))
        | (F.col("first") != start)
    )
    return spans.filter(broken)


GAP_BUCKET = 1024


def gaps(rows: DataFrame, group: list[str], number: str) -> DataFrame:
    """Missing numbers between a group's first and last.

    Numbers are compared per bucket of ``GAP_BUCKET``, so the longest list held is one
    bucket, however many numbers a group has; wholly empty buckets are filled in apart.
    """
    bucket = F.floor(F.col(number) / GAP_BUCKET).cast("long")
    held = rows.select(*group, F.col(number), bucket.alias("_b")).distinct()
    buckets = held.groupBy(*group, "_b").agg(
        F.collect_set(number).alias("_held"), F.min(number).alias("_lo"), F.max(number).alias("_hi")
    )
    spans = buckets.groupBy(*group).agg(
        F.min("_lo").alias("_first"), F.max("_hi").alias("_last"),
        F.min("_b").alias("_b0"), F.max("_b").alias("_b1"), F.count("*").alias("_n"),
    )
    kind = dict(rows.dtypes)[number]
    start, end = F.col("_b") * GAP_BUCKET, F.col("_b") * GAP_BUCKET + (GAP_BUCKET - 1)
    wanted = F.sequence(F.greatest(start, F.col("_first")).cast(kind), F.least(end, F.col("_last")).cast(kind))
    inside = buckets.join(spans, group).select(*group, F.explode(F.array_except(wanted, F.col("_held"))).alias(number))
    sparse = spans.filter(F.col("_b1") - F.col("_b0") + 1 > F.col("_n"))
    every = unfold(sparse.select(*group, "_b0", "_b1"), F.col("_b0"), F.col("_b1"), "_b").select(*group, "_b")
    empty = every.join(buckets, [*group, "_b"], "left_anti")
    return inside.unionByName(empty.select(*group, F.explode(F.sequence(start.cast(kind), end.cast(kind))).alias(number)))


def late_start(slug: Column, chapter: Column) -> Column:
    """First verse a chapter is expected to have."""
    start = F.lit(1)
    for (book, ch), first in canon.LATE_STARTS.items():
        start = F.when((slug == book) & (chapter == ch), first).otherwise(start)
    return start


def charset_whitelist(rows: DataFrame, text: str = "text", letters: str = canon.LATIN_LETTERS) -> DataFrame:
    """Texts with leaked markup or a letter outside ASCII and the allowed ones."""
    return rows.filter(F.col(text).rlike(rf"[/\\\[\]<>]|[^\x00-\x7f{letters}]"))


def substring_of_source(rows: DataFrame, sources: DataFrame, on: list[str], text: str = "text",
                        source: str = "source_text", rows_per_list: int = 256) -> DataFrame:
    """Rows whose collapsed text is not found in the source of their own bucket.

    A bucket's rows are gathered in lists of about ``rows_per_list``, and each list meets
    the source once: the source is not copied to every row, and no list grows with the
    corpus.
    """
    counts = rows.groupBy(*on).agg(F.ceil(F.count("*") / rows_per_list).alias("_lists"))
    dealt = rows.join(counts, on).withColumn("_list", F.pmod(F.xxhash64(text), F.col("_lists")))
    lists = dealt.groupBy(*on, "_list").agg(F.collect_list(F.struct(*[F.col(c) for c in rows.columns])).alias("_rows"))
    flat = sources.select(*on, collapse_ws(F.col(source)).alias("_flat"))
    missing = lambda r, whole: ~F.coalesce(F.contains(whole, r[text]), F.lit(False))
    met = lists.join(flat, on, "left").select("_rows", "_flat")
    bad = met.select(F.explode(F.filter("_rows", lambda r: missing(r, F.col("_flat")))).alias("_r"))
    return bad.select("_r.*")


def rederive_equals(rows: DataFrame, raw: DataFrame, on: list[str], text: str = "text", raw_text: str = "raw") -> DataFrame:
    """Rows whose stored text is not what the cleaner makes of the raw text."""
    again = raw.select(*on, clean_latin(F.col(raw_text)).alias("_again"))
    return rows.join(again, on, "left").filter(~F.col(text).eqNullSafe(F.col("_again"))).drop("_again")


def title_suffix(nodes: DataFrame) -> DataFrame:
    title = F.coalesce(F.col("title"), F.lit(""))
    ends = F.regexp_replace("citation", rf"{SPACE}+\z", "").endswith(title)
    return nodes.filter((title != "") & ~ends)


def citations_parse(nodes: DataFrame) -> DataFrame:
    """Scripture citations that the normalizer cannot read."""
    cited = nodes.select("id", each("citations_out").alias("c")).filter(F.col("c.kind") == "scripture")
    return cited.filter(normalize_ref(F.col("c.raw")).isNull()).select("id", F.col("c.raw").alias("raw"))


def marker_leak_check(verses: DataFrame, text: str = "text") -> DataFrame:
    return verses.filter(has_verse_marker(F.col(text)))


def page_verify(pages: DataFrame, anchors: DataFrame) -> DataFrame:
    """Pages without anchors, or whose anchors name another book or chapter than wanted.

    ``pages`` is ``(page, want_slug, want_chapter)``, ``anchors`` ``(page, slug, chapter)``
    with one row per anchor; distinct values are compared through min and max, not
    collected.
    """
    per_page = anchors.groupBy("page").agg(
        F.min("slug").alias("a"), F.max("slug").alias("b"), F.min("chapter").alias("c"), F.max("chapter").alias("d"),
        F.count("*").alias("anchors"),
    )
    ok = (
        F.col("a").eqNullSafe(F.col("want_slug")) & F.col("b").eqNullSafe(F.col("want_slug"))
        & F.col("c").eqNullSafe(F.col("want_chapter")) & F.col("d").eqNullSafe(F.col("want_chapter"))
        & F.col("anchors").isNotNull()
    )
    met = pages.join(per_page, "page", "left").filter(~ok)
    return met.select("page", "want_slug", "want_chapter", F.coalesce("anchors", F.lit(0)).alias("anchors"))
