"""Lines that a site repeats on its pages, dropped by their share of its pages.

A line is told by the hash of its trimmed text. Per site, the pages that hold a line are
counted and divided by the site's pages; a line above the ratio on at least
``MIN_PAGES`` pages is boilerplate and is dropped wherever the site has it. Pages of one
site with the same lines are copies of one page, which counts once; so a page that was
copied whole keeps its lines (the stage for near-duplicates decides on it), and one whose
body is short and whose menu is long loses the menu like any other.

Each page's different line hashes are found inside its row and written once; counts are
combined before they are shuffled, so a line that every page has is one number per task.
Of copied pages a task keeps one before the shuffle.
Text is shuffled once, to meet the hashes that are to go, and is cut inside its row.

A 64-bit hash of a line could only do harm by meeting the hash of a boilerplate line of
the same site; with a thousand such lines and a billion lines a site the chance is 1e-7.

Defined results: blank lines are never boilerplate, and don't tell pages apart. A page of
boilerplate alone becomes an empty text. A null site is one site. A null
text stays null and counts with the pages that have no lines. Rows that repeat an id are decided each. Other columns stay as they
are, but for ``n_chars``, which follows the text where it is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, settle, unboxed

RATIO = 0.02
MIN_PAGES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(line, "\r$", "")))


def boilerplate(keys: DataFrame, pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(site, key)`` of boilerplate lines from ``keys (site, key)``, one row a page and line."""
    totals = settle(pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages")), "sites").withColumnRenamed("site", "s")
    counts = keys.groupBy("site", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    joined = counts.join(totals, F.col("site").eqNullSafe(F.col("s")))
    return joined.where(F.col("n") > F.col("pages") * ratio).select("site", "key")


def drop_lines(docs: DataFrame, site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, figures: bool = False) -> DataFrame:
    """The documents without their site's boilerplate lines; ``figures`` adds what went.

    Those are ``lines`` and ``dropped_lines``, before the row's own columns.
    """
    rows = boxed(docs)
    text = F.col("row.text")
    own = F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(F.regexp_replace(x, "\r$", "")) != ""), _key))
    held = settle(rows.select(F.col("row.doc_id").alias("id"), F.col("row").getField(site).alias("site"), own.alias("keys")), "lines")
    each = held.select("id", "site", F.explode("keys").alias("key"))
    page = F.xxhash64(F.array_sort("keys"))
    pages = settle(held.groupBy("site", page.alias("page")).agg(F.first("keys").alias("keys")), "pages")
    table = settle(boilerplate(pages.select("site", F.explode("keys").alias("key")), pages, ratio, min_pages).withColumnRenamed("site", "s").withColumnRenamed("key", "k"), "boilerplate")
    hits = each.join(table, F.col("site").eqNullSafe(F.col("s")) & (F.col("key") == F.col("k")))
    gone = hits.groupBy("id", "site").agg(F.collect_set("key").alias("gone")).withColumnRenamed("id", "i").withColumnRenamed("site", "s")
    met = rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("i")) & F.col("row").getField(site).eqNullSafe(F.col("s")), "left").select("row", "gone")

    none = F.col("gone").isNull()
    lines = met.select("row", "gone", F.when(~none, _lines(text)).alias("all"))
    left = F.filter("all", lambda x: (F.trim(F.regexp_replace(x, "\r$", "")) == "") | ~F.array_contains("gone", _key(x)))
    cut = lines.select("row", "all", F.when(~none, left).alias("left"))
    whole = F.col("left").isNull()
    out = cut.select("row", whole.alias("whole"), "left", F.when(whole, 0).otherwise(F.size("all") - F.size("left")).alias("dropped_lines"))
    new = F.when(F.col("whole"), text).otherwise(F.array_join("left", "\n"))
    row = F.col("row").withField("text", new)
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("whole"), F.col("row.n_chars")).otherwise(F.length(F.array_join("left", "\n")).cast(docs.schema["n_chars"].dataType)))
    if figures:
        return out.select(F.size(_lines(text)).alias("lines"), "dropped_lines", row.alias("row")).select("lines", "dropped_lines", "row.*")
    return unboxed(out.select(row.alias("row")))
