"""URL filter: host and path rules, and a list behind a blocked Bloom filter.

Listed URLs are compared in a canonical form. A blocked Bloom filter of the list (256 bits
a block, four bits a URL, all of one URL in one block) is a table of at most ``BLOCKS``
rows whatever the list, so it is sent to all tasks; a fuller filter lets more through and
never loses a listed URL. Only pages that pass it are joined with the list itself, by the
canonical URL, which removes the false positives. All other pages aren't shuffled.

Defined results: a URL that is null or has no ``://`` has an empty host and path, meets
no rule, has no canonical form and is allowed. Listed URLs that are null or have no
canonical form are left out, repeats count once. Every row of the pages gives one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Most blocks of the filter: 2 MB of bits, a few times that as rows of a join.
BLOCKS = 1 << 16
#: Query parts that name the visitor's way here and not the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a last ``/``, sorted query without tracking parts."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    place = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), r"/+$", ""))
    whole = F.when(F.size(parts) > 0, F.concat(place, F.lit("?"), F.array_join(parts, "&"))).otherwise(place)
    return F.when(url.contains("://"), whole)


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule ``(verdict, host, path)`` that fits, as text, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, at, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == at) | F.endswith(host_, F.lit("." + at))) & F.startswith(path_, F.lit(start))
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block and its bit in each of the block's four words."""
    first, second = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))
    words = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(second, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")) for i in range(4)]
    return F.pmod(first, F.lit(blocks)).cast("int"), words


def bloom(keys: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``(block, w0..w3)`` of the column ``key``; blocks without a key have no row."""
    block, words = _bits(F.col("key"), blocks)
    named = [w.alias(f"w{i}") for i, w in enumerate(words)]
    return keys.select(block.alias("block"), *named).groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], blocks: int = BLOCKS) -> DataFrame:
    """Per page its host, path, rule and verdict, and whether its URL is ``listed (url)``."""
    url = F.col("url")
    keys = settle(listed.select(canonical(url).alias("key")).where("key IS NOT NULL").distinct(), "listed")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    read = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), canonical(url).alias("key"))
    block, words = _bits(F.col("key"), blocks)
    ruled = read.select("*", rule.alias("rule"), says.alias("says"), block.alias("block"))
    # At most BLOCKS rows of five numbers, so it may be sent to every task.
    probed = ruled.join(F.broadcast(bloom(keys, blocks)), "block", "left")
    held = [F.col(f"w{i}").bitwiseAND(w) != 0 for i, w in enumerate(words)]
    maybe = F.coalesce(held[0] & held[1] & held[2] & held[3], F.lit(False))
    names = ["page_id", "host", "path", "rule", "says", "key"]
    passed = probed.where(maybe).select(*names)
    exact = passed.join(keys.select("key", F.lit(True).alias("listed")), "key", "left").select(*names, F.coalesce("listed", F.lit(False)).alias("listed"))
    rest = probed.where(~maybe).select(*names, F.lit(False).alias("listed"))
    verdict = F.coalesce("says", F.when(F.col("listed"), "block").otherwise("allow"))
    return rest.union(exact).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")
