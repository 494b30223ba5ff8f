"""The registered query of each operator, with its SQL where SQL can express it."""

from __future__ import annotations

from typing import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import load, new_path, settle
from . import ann, lines, mixing, packing, quality, rollups, runs, secrets, simhash, toxicity, trie, urls, vector_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if sql is not None:
            ORACLE[name] = sql
        return plan

    return add


@query("op1_simhash")
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.assign(load(spark, folder, "documents"))


@query("op7_packing")
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(load(spark, folder, "documents"), ids=False)
    return packed.drop("ids")


#: Lines that a revision takes out of a document.
LICENCE_LINES = r"(?:^|\n)[^\n]*(?:License|Licensed|licensed|rights reserved)[^\n]*"


@query("op10_token_rollups")
def op10_token_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """All documents enter, licence lines are revised away, toxic documents are taken down.

    Whether a document is revised is seen in its row, and what is taken down is looked up
    among the counts, so no text is shuffled. The last batch is sent twice and counts once.
    """
    docs = load(spark, folder, "documents").withColumn("revised", F.coalesce(F.col("text").rlike(LICENCE_LINES), F.lit(False)))
    rollup = rollups.Rollup(spark, new_path(spark, "rollup"))
    counts = settle(rollups.counted(docs, extra=("revised",)), "counts")
    rollup.commit("load", rollups.inserts(counts))
    changed = docs.where("revised").withColumn("after", F.regexp_replace("text", LICENCE_LINES, ""))
    old = rollups.counted(changed, extra=("after",)).withColumnsRenamed({"tokens": "old_tokens", "after": "text"})
    new = settle(rollups.counted(old, extra=("old_tokens",)), "revisions")
    rollup.commit("revise", rollups.revisions(new))
    held = counts.where("NOT revised").drop("revised").unionByName(new.drop("old_tokens"))
    toxic = load(spark, folder, "labels").where("toxic = 1").select("doc_id").distinct()
    gone = rollups.deletes(held.join(toxic, "doc_id", "left_semi"))
    rollup.commit("takedown", gone)
    rollup.commit("takedown", gone)
    return rollup.totals()


@query("op2_quality")
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(load(spark, folder, "documents"), load(spark, folder, "labels"))


@query("op6_mixing")
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan(load(spark, folder, "documents"))


@query("op5_nearest")
def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(load(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op8_secrets")
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(load(spark, folder, "documents"))


@query("op9_vector_dedup")
def op9_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.dedup(load(spark, folder, "embeddings"))


# The rules of the filter as (verdict, host, path), and the labels of hosts
# whose pages make up the list.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]
LISTED_LABELS = ["spam-farm", "cheap-pills", "casino-win", "adult-x", "free-bets", "ads-track"]

_LABELS = "|".join(LISTED_LABELS)
_RULE = "CASE " + " ".join(
    f"WHEN (host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}') THEN {{{v}_{i}}}"
    for i, (v, h, p) in enumerate(sorted(URL_RULES, key=lambda r: -len(r[1] + r[2])))
) + " END"
_IN_ORDER = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
_RULE_TEXT = _RULE.format(**{f"{v}_{i}": f"'{h}{p}'" for i, (v, h, p) in enumerate(_IN_ORDER)})
_RULE_SAYS = _RULE.format(**{f"{v}_{i}": f"'{v}'" for i, (v, h, p) in enumerate(_IN_ORDER)})
_CANONICAL = r"""
  parts AS (SELECT page_id, url, host, path,
      list_sort(list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
        lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) AS query
    FROM split_),
  keyed AS (SELECT page_id, host, path, CASE WHEN contains(url, '://') THEN
      regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS key
    FROM parts)"""
URLS_SQL = rf"""
WITH split_ AS (SELECT page_id, url,
      translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
  {_CANONICAL},
  listed AS (SELECT DISTINCT key FROM keyed WHERE key IS NOT NULL AND regexp_matches(host, '(^|\.)({_LABELS})\.'))
SELECT page_id, host, path, {_RULE_TEXT} AS rule,
  coalesce({_RULE_SAYS}, CASE WHEN key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(key IN (SELECT key FROM listed), false) AS listed
FROM keyed"""


@query("op3_url_filter", URLS_SQL)
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The rules first; the list is the URLs the pages have on hosts of the named labels."""
    pages = load(spark, folder, "pages")
    listed = pages.where(urls.host(F.col("url")).rlike(rf"(^|\.)({_LABELS})\.")).select("url")
    return urls.judge(pages, listed, URL_RULES)


LINES_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, source, text, string_split(text, chr(10)) AS held FROM documents),
  each AS (SELECT n, source, unnest(held) AS line, generate_subscripts(held, 1) AS place FROM docs),
  kept AS (SELECT n, source, line, place, trim(regexp_replace(line, '\r$', ''), ' ') AS told FROM each),
  own AS (SELECT n, list_sort(list(DISTINCT told)) AS page FROM kept WHERE told <> '' GROUP BY n),
  pages AS (SELECT DISTINCT source, coalesce(page, []) AS page FROM docs LEFT JOIN own USING (n)),
  totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
  counts AS (SELECT source, told, count(*) AS n FROM (SELECT source, unnest(page) AS told FROM pages) GROUP BY source, told),
  plate AS (SELECT c.source, c.told FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
    WHERE c.n >= {lines.MIN_PAGES} AND c.n > t.pages * CAST({lines.RATIO} AS DOUBLE)),
  marked AS (SELECT k.*, p.told IS NOT NULL AS plate FROM kept k
    LEFT JOIN plate p ON k.source IS NOT DISTINCT FROM p.source AND k.told = p.told),
  left_ AS (SELECT n, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT plate), '') AS text,
    count(*) FILTER (WHERE plate) AS dropped FROM marked GROUP BY n)
SELECT d.doc_id, CASE WHEN l.dropped > 0 THEN l.text ELSE d.text END AS text,
  CAST(len(d.held) AS INTEGER) AS lines, CAST(coalesce(l.dropped, 0) AS INTEGER) AS dropped_lines
FROM docs d LEFT JOIN left_ l ON d.n = l.n"""


@query("op4_line_dedup", LINES_SQL)
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without their source's boilerplate lines."""
    found = lines.drop_lines(load(spark, folder, "documents"), figures=True)
    return found.select("doc_id", "text", "lines", "dropped_lines")


def planted_runs(doc_id, words: list[bytes]) -> list[bytes]:
    """Words of a document with the repetition that the query plants in a tenth of them.

    A document without an id has no such number and stays as it is.
    """
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    unit = words[at:at + period]
    return words[:at] + (unit * (-(-(n - at) // period)))[: n - at]


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digest(runs.detect(load(spark, folder, "documents"), planted_runs))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations, and the turns of each after its head was copied from another.

    Conversation c takes the first h turns of c - c % 100 (with the non-negative remainder)
    and goes on with its own after its first h; h is its id's checksum modulo 6.
    """
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).alias("head")
    base = (F.col("conv_id") - F.pmod("conv_id", F.lit(100))).alias("base")
    convs = settle(turns.select("conv_id").distinct().select("conv_id", base, head), "convs")
    heads = turns.where((F.col("at") < 5) & (F.pmod("conv_id", F.lit(100)) == 0)).select(F.col("conv_id").alias("base"), "at", "told", "chars")
    copied = convs.join(heads, "base").where("at < head").select("conv_id", "at", "told", "chars")
    sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("held"))
    own = turns.select("*", base, head).where("at >= head").join(sizes, "base", "left")
    moved = own.select("conv_id", (F.col("at") - F.col("head") + F.least("head", F.coalesce("held", F.lit(0)))).alias("at"), "told", "chars")
    return convs.select("conv_id"), copied.unionByName(moved)


@query("op13_conversation_trie")
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = settle(trie.numbered(load(spark, folder, "conversations")), "numbered")
    return trie.build(*rebuilt(turns))


@query("op11_toxicity")
def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(load(spark, folder, "documents"), load(spark, folder, "labels"))
