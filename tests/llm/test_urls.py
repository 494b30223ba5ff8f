"""URL verdicts against plain string work."""

import itertools

from pyspark.sql import functions as F

from lectern.llm import urls
from lectern.llm.queries import LISTED_LABELS, URL_RULES, URLS_SQL, op3_url_filter
from tests.check_oracle import compare, connect

PAGES = "page_id long, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    end = min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end], rest[end:]


def canonical(url):
    if url is None or "://" not in url:
        return None
    host, path, rest = split(url)
    query = rest[1:].split("#")[0] if rest.startswith("?") else ""
    parts = sorted(p for p in query.split("&") if p and not (p.startswith("utm_") or p.split("=")[0] in ("ref", "fbclid", "gclid")))
    host = host[4:] if host.startswith("www.") else host
    return host + path.rstrip("/") + ("?" + "&".join(parts) if parts else "")


def judge(url, listed):
    host, path, _ = split(url)
    fits = [r for r in URL_RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    hit = canonical(url) in listed
    return host, path, best and best[1] + best[2], best[0] if best else ("block" if hit else "allow"), hit


def check(pages, listed, blocks=urls.BLOCKS):
    keys = {canonical(r.url) for r in listed.collect()} - {None}
    got = sorted(str(tuple(r)) for r in urls.judge(pages, listed, URL_RULES, blocks).collect())
    assert got == sorted(str((r.page_id, *judge(r.url, keys))) for r in pages.collect())


def test_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    check(pages, pages.where(F.col("url").rlike("|".join(LISTED_LABELS))))
    assert compare(op3_url_filter(spark, folder), connect(folder), URLS_SQL) is None


def test_made_up_urls(spark):
    hosts = ["example.org", "a.EXAMPLE.org", "notexample.org", "org", "x.com", "com", "b.net", "www.b.net", "", "é.org"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?q=1&utm_x=2", "/fr/#/de/", "?a=://x/y", "/de/x", "#f", "/p//", "/p?b=2&a=1&ref=z", "/p?a=1&b=2#q"]
    made = [f"{s}://{h}{p}" for s, h, p in itertools.product(["http", "HTTPS", ""], hosts, paths)] + [None, "", "nothing", "mailto:x", "a://b://c/d"]
    rows = [(i, u, None) for i, u in enumerate(made * 2)]
    pages = spark.createDataFrame(rows, PAGES)
    check(pages, pages.where("page_id % 7 = 0"))
    check(pages, pages.where("page_id % 2 = 0"), blocks=1)  # a full filter only costs time


def test_nothing_listed_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://b.net/x", None), (None, None, None)], PAGES)
    check(pages, pages.limit(0))
    check(pages.limit(0), pages)


def test_filter_lets_few_others_through(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("h/"), "id").alias("key"))
    others = spark.range(20_000, 60_000).select(F.concat(F.lit("h/"), "id").alias("key"))
    block, words = urls._bits(F.col("key"), 4096)
    met = others.withColumn("block", block).join(urls.bloom(keys, 4096), "block")
    hit = met.where((F.col("w0").bitwiseAND(words[0]) != 0) & (F.col("w1").bitwiseAND(words[1]) != 0) & (F.col("w2").bitwiseAND(words[2]) != 0) & (F.col("w3").bitwiseAND(words[3]) != 0))
    assert hit.count() < 0.01 * 40_000
