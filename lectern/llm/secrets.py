"""Secrets in whole texts, and what the corpus says about who owns them.

Base kinds are found by their patterns. The method adds a fourth kind: strings that look
like credentials and belong to few owners. The hash of every candidate is counted over
the corpus by distinct repositories and owners; a candidate that many owners or many
repositories have is an example that was copied around, one of few looks live. For
documents the source is the owner and the different text the repository, so copies of a
whole document are one.

Spans come from splitting a text at a pattern: the pieces between matches and the matches
together give every place, in the JVM. Candidates are shuffled as hashes, never as text;
counts are reduced to different (hash, owner, repository) rows and then in steps, so a
candidate that everybody has is a few numbers per task.

Defined results: a null text counts as empty. Matches of one kind don't overlap, matches
of two kinds may. An added span never overlaps a base span. A null owner or repository
counts as one owner or repository. Rows that repeat are judged each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

# The base patterns. Of ``access`` and ``hex`` only matches of 20 and 24
# characters count; for a run of one class that is the same as asking for so many.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
#: Added candidates: whole runs with a digit and a letter and so many different characters.
LIVE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}"
LIVE_DIFFERENT = 10
#: A candidate of more owners than this is an example.
MOST_OWNERS = 2
#: And one of more repositories than this, whoever owns them.
MOST_REPOSITORIES = 20
KINDS = ["assign", "access", "hex", "live"]
_SPAN = "array<struct<start:long,kind:int,end:long,value:string>>"


def _found(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """Spans of a pattern's matches; ``value`` is the group's text."""
    p = F.lit(pattern)
    pairs = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, p, F.lit(group)).alias("value"),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast(_SPAN).alias("spans"))

    def add(state, x):
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(F.coalesce(state["spans"], F.array().cast(_SPAN)), F.array(span)).alias("spans"))

    # The last gap has no match after it.
    spans = F.aggregate(F.filter(pairs, lambda x: x["hit"].isNotNull()), start, add)["spans"]
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    assign = F.filter(_found(text, ASSIGN, 0, 2), lambda x: F.length(x["value"]) >= ASSIGN_LEAST)
    return F.array_sort(F.concat(assign, _found(text, ACCESS, 1), _found(text, HEX, 2)))


def candidates(text: Column, base: Column) -> Column:
    """Strings that look like credentials outside the base spans."""
    return F.filter(
        _found(text, LIVE, 3),
        lambda x: x["value"].rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(x["value"], ""))) >= LIVE_DIFFERENT)
        & ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )


def _hashed(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"], x["kind"], x["end"], F.unhex(F.sha2(x["value"], 256)).alias("hash")))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source", repository: str | None = None) -> DataFrame:
    """``(n, doc_id, owner, repository, base, more)``: spans with the hashes of their values.

    Without a column ``repository`` each different text is one.
    """
    told = F.col(repository).cast("string") if repository else F.xxhash64(F.coalesce(F.col(text), F.lit(""))).cast("string")
    read = docs.select(
        F.monotonically_increasing_id().alias("n"), F.col(doc_id).alias("doc_id"), F.col(owner).alias("owner"),
        told.alias("repository"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    found = read.withColumn("base", base_spans(F.col("text")))
    # A written table, so the patterns run once over each text.
    return settle(
        found.select("n", "doc_id", "owner", "repository", _hashed(F.col("base")).alias("base"),
                     _hashed(candidates(F.col("text"), F.col("base"))).alias("more")), "secrets",
    )


def ownership(spans: DataFrame) -> DataFrame:
    """``(hash, owners, repositories)`` of every candidate in the corpus."""
    each = spans.select(F.explode(F.concat("base", "more")).alias("span"), "owner", "repository")
    different = each.select(F.col("span.hash").alias("hash"), "owner", "repository").distinct()
    by_owner = different.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))


def _few(most_owners: int, most_repositories: int) -> Column:
    """Whether so few have a candidate that it looks live."""
    return (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)


def spans_of(docs: DataFrame, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES) -> DataFrame:
    """One row per span: place, kind, how many own its value, and ``live`` or ``example``."""
    held = scan(docs)
    counts = settle(ownership(held), "ownership")
    each = held.select("doc_id", F.explode(F.concat("base", "more")).alias("span"))
    judged = each.select("doc_id", "span.*").join(counts, "hash")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    verdict = F.when(_few(most_owners, most_repositories), "live").otherwise("example")
    return judged.select("doc_id", kind.alias("kind"), "start", "end", "owners", "repositories", verdict.alias("verdict"))


def _written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    say = F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(say, ",")


def digest(docs: DataFrame, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES) -> DataFrame:
    """Per document the number of base spans by kind, their hash, and all spans."""
    held = scan(docs)
    few = settle(ownership(held).where(_few(most_owners, most_repositories)).select("hash"), "few-owners")
    added = held.select("n", F.explode("more").alias("span")).join(few, F.col("span.hash") == F.col("hash"))
    live = added.groupBy("n").agg(F.collect_list("span").alias("live"))
    base = F.col("base")
    kinds = F.transform(base, lambda x: x["kind"])
    numbers = [F.size(F.array_remove(kinds, k)) for k in range(3)]
    numbers = [(F.size(base) - n).cast("long").alias(f"n_{KINDS[k]}") for k, n in enumerate(numbers)]
    every = F.array_sort(F.concat(base, F.coalesce("live", F.array().cast(held.schema["base"].dataType))))
    return held.join(live, "n", "left").select("doc_id", *numbers, F.sha2(_written(base), 256).alias("base_sha256"), _written(every).alias("spans"))
