"""Joins between editions, keys and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import canon
from ..functions.columns import each, each_at
from ..functions.refs import is_verse_key, normalize_ref, unfold_keys, verse_number


def verse_text_join(citations: DataFrame, verses: DataFrame) -> DataFrame:
    """Cited verse keys with the verse they name; ``citations`` has ``norm``."""
    single = citations.filter(F.col("norm.verse_start").isNotNull())
    return unfold_keys(single, name="verse_key").join(verses, "verse_key")


def parallel_text_join(english: DataFrame, latin: DataFrame) -> DataFrame:
    """Every English verse with its Latin, empty where there is none."""
    other = latin.select("verse_key", F.col("text").alias("latin"))
    return english.join(other, "verse_key", "left").withColumn("latin", F.coalesce("latin", F.lit("")))


def parallel_alignment(left: DataFrame, right: DataFrame, key: str = "verse_key") -> DataFrame:
    """Shared and one-sided keys of two editions, and the share of the right side met.

    Tag, union and group: one shuffle with partial aggregation, the same result as a
    full outer join of the distinct keys.
    """
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    sides = tagged.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")
    counts = sides.agg(
        count(F.col("l") == 1).alias("left_keys"),
        count(F.col("r") == 1).alias("right_keys"),
        count((F.col("l") == 1) & (F.col("r") == 1)).alias("shared"),
        count((F.col("l") == 1) & (F.col("r") == 0)).alias("left_only"),
        count((F.col("l") == 0) & (F.col("r") == 1)).alias("right_only"),
    )
    rate = F.when(F.col("right_keys") > 0, F.col("shared") / F.col("right_keys")).otherwise(0.0)
    return counts.withColumn("rate", F.round(rate, 4))


def citation_coverage(index: DataFrame, verses: DataFrame) -> DataFrame:
    """Cited verse keys that have text: total, resolved, rate."""
    cited = index.filter(is_verse_key(F.col("key"))).select("key").distinct()
    held = verses.select(F.col("verse_key").alias("key")).distinct().withColumn("held", F.lit(1))
    found = cited.join(held, "key", "left")
    counts = found.agg(F.count("*").alias("cited"), F.count("held").alias("resolved"))
    rate = F.when(F.col("cited") > 0, F.col("resolved") / F.col("cited")).otherwise(0.0)
    return counts.withColumn("rate", F.round(rate, 4))


def clamp_keys(pericopes: DataFrame, verses: DataFrame, keys: str = "label_keys") -> tuple[DataFrame, DataFrame]:
    """``(kept, dropped)``: join keys that exist, and the label keys that do not."""
    exploded = pericopes.select("id", each(keys).alias("verse_key"))
    held = verses.select("verse_key").distinct()
    return exploded.join(held, "verse_key", "left_semi"), exploded.join(held, "verse_key", "left_anti")


def lookup_keys(requests: DataFrame, reference: str = "reference") -> DataFrame:
    """Requests with their normalized reference; unreadable ones keep a NULL ``norm``."""
    return requests.withColumn("norm", normalize_ref(F.col(reference)))


def lookup_verses(requests: DataFrame, verses: DataFrame) -> DataFrame:
    """Verses each request names: single, range, or the whole chapter.

    Requests meet held verses on the chapter key, an equi-join in which ``john/1`` never
    reaches ``john/10``; the bounds are tested on the match, so a wide range is no list.
    """
    asked = requests.filter(F.col("norm").isNotNull()).withColumn("_chapter", F.col("norm.chapter_key"))
    by_chapter = verses.withColumn("_chapter", F.substring_index("verse_key", "/", 2))
    inside = verse_number(F.col("verse_key")).between(F.col("norm.verse_start"), F.col("norm.verse_end"))
    return asked.join(by_chapter, "_chapter").filter(F.col("norm.verse_start").isNull() | inside).drop("_chapter")


def prefix_lookup(requests: DataFrame, keyed: DataFrame, prefix: str = "chapter_key", key: str = "key") -> DataFrame:
    """Rows whose key lies under a chapter key."""
    held = keyed.withColumn(prefix, F.substring_index(key, "/", 2)).filter(is_verse_key(F.col(key)))
    return requests.join(held, prefix)


def range_lookup(spans: DataFrame, verses: DataFrame) -> DataFrame:
    """Verses of ``(slug, chapter, first, last)`` spans that exist."""
    met = spans.join(verses, ["slug", "chapter"])
    return met.filter(F.col("verse").between(F.col("first"), F.greatest("first", "last")))


#: Powers of two that a chapter number may reach.
LEVELS = 31


def dyadic(first: Column, last: Column) -> Column:
    """A range of whole numbers from 0 on as aligned pieces ``struct<level, part>``.

    A piece holds the ``2 ** level`` numbers that are ``part`` when cut at that level. From
    either end a piece is taken where a level's parts don't pair up, so there are at most
    two a level, however wide the range is.
    """
    start = F.struct(first.cast("long").alias("a"), (last.cast("long") + 1).alias("b"), F.array().cast("array<struct<level:int,part:long>>").alias("pieces"))

    def step(s: Column, level: Column) -> Column:
        open_ = s["a"] < s["b"]
        left, right = open_ & (s["a"] % 2 == 1), open_ & (s["b"] % 2 == 1)
        piece = lambda part: F.array(F.struct(level.alias("level"), part.alias("part")))
        none = F.array().cast("array<struct<level:int,part:long>>")
        # A last single part is taken from the left alone.
        right = right & ~(left & (s["a"] + 1 == s["b"]))
        pieces = F.concat(s["pieces"], F.when(left, piece(s["a"])).otherwise(none), F.when(right, piece(s["b"] - 1)).otherwise(none))
        a, b = F.when(left, s["a"] + 1).otherwise(s["a"]), F.when(right, s["b"] - 1).otherwise(s["b"])
        return F.struct(F.shiftright(a, 1).alias("a"), F.when(open_, F.shiftright(b, 1)).otherwise(F.shiftright(a, 1)).alias("b"), pieces.alias("pieces"))

    levels = F.array(*[F.lit(i) for i in range(LEVELS + 1)])
    return F.aggregate(levels, start, step)["pieces"]


def ancestors(number: Column) -> Column:
    """The pieces ``struct<level, part>`` that hold a number."""
    return F.array(*[F.struct(F.lit(i).alias("level"), F.shiftright(number.cast("long"), i).alias("part")) for i in range(LEVELS + 1)])


def held_chapters(readings: DataFrame, chapters: DataFrame) -> DataFrame:
    """Readings with ``span_no``, span ``s`` and every chapter of ``chapters (slug, chapter)`` in it.

    A span's chapters are a few pieces and a held chapter's pieces as many as it has bits;
    they meet on slug and piece, so the chapters of a span are never listed.
    """
    spans = readings.select("*", each_at("spans").alias("span_no", "s")).filter("s.ch1 >= 0 AND s.ch2 >= s.ch1")
    pieces = spans.select("*", F.explode(dyadic(F.col("s.ch1"), F.col("s.ch2"))).alias("_p"))
    held = chapters.filter("chapter >= 0").select("slug", "chapter", F.explode(ancestors(F.col("chapter"))).alias("_h"))
    met = pieces.select("*", F.col("_p.level").alias("_level"), F.col("_p.part").alias("_part")).drop("_p")
    by = held.select("slug", "chapter", F.col("_h.level").alias("_level"), F.col("_h.part").alias("_part"))
    return met.join(by, ["slug", "_level", "_part"]).drop("_level", "_part")


def gospel_verses(readings: DataFrame, verses: DataFrame, chapters: DataFrame | None = None) -> DataFrame:
    """Verses of readings with ``spans``; a span may run over a chapter end.

    Spans meet the chapters that are held (``chapters (slug, chapter)``, from the verses if
    not given) and then the verses of those; the verse bounds are checked on the match.
    """
    chapters = verses.select("slug", "chapter").distinct() if chapters is None else chapters
    spans = held_chapters(readings, chapters)
    inside = (
        ((F.col("chapter") > F.col("s.ch1")) | (F.col("verse") >= F.col("s.v1")))
        & ((F.col("chapter") < F.col("s.ch2")) | (F.col("verse") <= F.col("s.v2")))
    )
    held = verses.select("slug", "chapter", "verse", "verse_key", F.col("text").alias("verse_text"))
    return spans.join(held, ["slug", "chapter"]).filter(inside)


BUCKET_DAYS = 32


def date_asof_forward(requests: DataFrame, table: DataFrame, on: str = "date", held: str = "date") -> DataFrame:
    """Each request date with the same or next held date, else the last one.

    Dates are looked up per calendar bucket: a request meets at most the bucket's few
    dates (held dates are made distinct first), and a later bucket is found in a sorted
    list with one entry per bucket. Neither grows with the number of rows, and no
    range join or global window is involved. Requests are reduced to distinct dates
    before the lookup.
    """
    bucket = lambda c: F.floor(F.unix_date(c) / F.lit(BUCKET_DAYS))
    dates = table.select(F.col(held).alias("held")).filter(F.col("held").isNotNull()).distinct()
    per_bucket = dates.groupBy(bucket(F.col("held")).alias("_b")).agg(F.sort_array(F.collect_set("held")).alias("_days"))
    edges = per_bucket.agg(
        F.struct(
            F.sort_array(F.collect_list(F.element_at("_days", 1))).alias("firsts"),
            F.max(F.element_at("_days", -1)).alias("last"),
        )
    ).scalar()
    asked = requests.select(F.col(on).alias("asked")).filter(F.col("asked").isNotNull()).distinct()
    near = asked.withColumn("_b", bucket(F.col("asked"))).join(per_bucket, "_b", "left").withColumn("_edges", edges)
    here = F.try_element_at(F.filter("_days", lambda d: d >= F.col("asked")), F.lit(1))
    later = F.try_element_at(F.filter("_edges.firsts", lambda d: d >= F.col("asked")), F.lit(1))
    return near.select("asked", F.coalesce(here, later, F.col("_edges.last")).alias("held"))


def canonical_order(rows: DataFrame, slug: str = "slug") -> DataFrame:
    """Position of each book in the canon, NULL for unknown ones."""
    order = F.create_map(*[F.lit(x) for i, s in enumerate(canon.BOOK_SLUGS) for x in (s, i)])
    return rows.withColumn("canon_pos", F.try_element_at(order, F.col(slug)))


def upsert_by_date(old: DataFrame, new: DataFrame, key: str = "date", value: str = "gospel") -> DataFrame:
    """Existing rows with a reading stay; missing dates and empty readings are filled.

    An old row without a reading stays only where the new rows have nothing for its date.
    """
    full = old.filter(F.coalesce(F.col(value).cast("string"), F.lit("")) != "")
    added = new.join(full.select(key), key, "left_anti").select(*old.columns)
    empty = old.join(full.select(key).union(new.select(key)), key, "left_anti").select(*old.columns)
    return full.unionByName(added).unionByName(empty)


def default_enrich(rows: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """Left lookup with an empty default."""
    return rows.join(table.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit("")))


def prefer_first(candidates: DataFrame, group: str, order: Column, keep: list[str]) -> DataFrame:
    """First candidate per group by preference; a min keeps it a partial aggregate."""
    best = F.min_by(F.struct(*keep), order).alias("best")
    return candidates.groupBy(group).agg(best).select(group, "best.*")
