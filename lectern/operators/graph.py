"""Citation graph as edge tables: indexes, adjacency, degrees, statistics.

Edges stay one row each. A key cited by a third of the corpus is therefore many rows,
never one array; counts use partial aggregation before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import each, kept, let, run_starts
from ..functions.refs import normalize_ref, parse_internal_refs, unfold_keys, union_keys
from ..schemas import CITATION
from ..session import settle

CITATIONS = f"array<{CITATION}>"

#: Stands between a key and the place where a further line of its list starts.
CONTINUED = "\x1f"

#: Entries up to which a key's lists are made by one task.
MOST = 100_000


def scripture_citations(nodes: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per scripture citation: ``keep``, position, raw text, normalized form.

    Citations are normalized inside the node's row and then unfolded, so a later filter
    on the result does not parse them a second time.
    """
    read = F.transform(
        "citations_out",
        lambda c, i: F.struct(
            i.alias("pos"), c["kind"].alias("kind"), c["raw"].alias("raw"),
            F.when(c["kind"] == "scripture", normalize_ref(c["raw"])).alias("norm"),
        ),
    )
    rows = nodes.select(*keep, F.explode(F.filter(read, lambda c: c["kind"] == "scripture")).alias("c"))
    return rows.select(*keep, "c.pos", "c.raw", "c.norm")


def parsed(citations: DataFrame) -> DataFrame:
    return citations.filter(F.col("norm").isNotNull())


def _keyed(citations: Column) -> Column:
    """Each key of a node once, with the first reference that mentions it."""
    normed = F.transform(
        F.filter(citations, lambda c: c["kind"] == "scripture"), lambda c: normalize_ref(c["raw"])
    )
    entries = F.flatten(
        F.transform(
            normed,
            lambda n, i: F.coalesce(
                F.transform(
                    union_keys(n), lambda k: F.struct(k.alias("key"), i.alias("pos"), n["ref"].alias("ref"))
                ),
                F.array().cast("array<struct<key:string,pos:int,ref:string>>"),
            ),
        )
    )
    return let(
        F.sort_array(entries),
        lambda es: F.when(
            F.size(es) > 0,
            let(run_starts(es, lambda e: e["key"]), lambda st: F.transform(st, lambda p: F.element_at(es, p))),
        ),
    )


#: Digits that a chapter or verse of a short reference has at most.
WIDE = "[0-9]{5,}"


def inverted_index(nodes: DataFrame, keep: tuple[str, ...] = ("id", "citation", "title")) -> DataFrame:
    """``key -> citing node`` rows, one per (node, key).

    Built inside each row, as a reference without a long number names few verses. Nodes
    that write a long number are unfolded in steps and reduced by key instead: the same
    rows, without a list of a range's verses.
    """
    long = F.exists(F.coalesce("citations_out", F.array().cast(CITATIONS)), lambda c: F.coalesce(c["raw"].rlike(WIDE), F.lit(False)))
    edges = nodes.filter(~long).select(*keep, F.explode(_keyed(F.col("citations_out"))).alias("e"))
    short = edges.select(F.col("e.key").alias("key"), *keep, F.col("e.ref").alias("ref"))
    cites = parsed(scripture_citations(nodes.filter(long), keep)).select(*keep, "pos", "norm")
    both = unfold_keys(cites).select(*keep, "key", "pos", "norm.ref").unionByName(
        cites.select(*keep, F.col("norm.chapter_key").alias("key"), "pos", "norm.ref")
    )
    first = both.groupBy(*keep, "key").agg(F.min_by("ref", "pos").alias("ref"))
    return short.unionByName(first.select("key", *keep, "ref"))


def node_refs(nodes: DataFrame) -> DataFrame:
    """``(id, refs)``: each node's distinct normalized references, sorted."""
    refs = F.transform(
        F.filter("citations_out", lambda c: c["kind"] == "scripture"), lambda c: normalize_ref(c["raw"])["ref"]
    )
    listed = F.sort_array(F.array_distinct(F.filter(refs, lambda r: r.isNotNull())))
    return nodes.select("id", kept(listed, lambda r: F.size(r) > 0).alias("refs"))


def book_counts(citations: DataFrame) -> DataFrame:
    return parsed(citations).groupBy(F.col("norm.book").alias("book")).agg(F.count("*").alias("n"))


def verse_counts(citations: DataFrame) -> DataFrame:
    keys = unfold_keys(parsed(citations).select("norm"))
    return keys.groupBy("key").agg(F.count("*").alias("n"))


def unparsed_counts(citations: DataFrame) -> DataFrame:
    return citations.filter(F.col("norm").isNull()).groupBy("raw").agg(F.count("*").alias("n"))


def parse_rate(citations: DataFrame) -> DataFrame:
    good = F.sum(F.when(F.col("norm").isNotNull(), 1).otherwise(0)).cast("long")
    counted = citations.agg(F.count("*").alias("total"), F.coalesce(good, F.lit(0)).alias("parsed"))
    rate = F.when(F.col("total") > 0, F.col("parsed") / F.col("total")).otherwise(0.0)
    return counted.withColumn("rate", F.round(rate, 4))


def internal_edges(nodes: DataFrame, text: str = "text") -> DataFrame:
    """``(src, dst)`` as written, distinct per node, targets not yet checked."""
    return nodes.select(F.col("id").alias("src"), F.explode(parse_internal_refs(F.col(text))).alias("dst"))


def internal_resolve(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose target exists and is not the node itself.

    Targets are reduced to distinct ids before they meet the node table; the edges then
    only need a semi join against that much smaller list. Pass a settled edge table:
    it is read twice.
    """
    others = edges.filter(F.col("src") != F.col("dst"))
    held = others.select("dst").distinct().join(nodes.select(F.col("id").alias("dst")), "dst", "left_semi")
    return others.join(held, "dst", "left_semi").select("src", "dst")


def resolve_rate(edges: DataFrame, resolved: DataFrame) -> DataFrame:
    total = edges.agg(F.count("*").alias("total"))
    good = resolved.agg(F.count("*").alias("n")).scalar()
    return total.select("total", good.alias("resolved")).withColumn(
        "rate", F.round(F.when(F.col("total") > 0, F.col("resolved") / F.col("total")).otherwise(0.0), 4)
    )


def in_degree(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("in_degree"))


def edges_to_meta(edges: DataFrame, meta: DataFrame) -> DataFrame:
    """Citation and title of both ends."""
    src = meta.select(F.col("id").alias("src"), F.col("citation").alias("src_citation"), F.col("title").alias("src_title"))
    dst = meta.select(F.col("id").alias("dst"), F.col("citation").alias("dst_citation"), F.col("title").alias("dst_title"))
    joined = edges.join(src, "src", "left").join(dst, "dst", "left")
    return joined.select(
        "src", F.coalesce("src_citation", F.lit("")).alias("src_citation"), "src_title",
        "dst", "dst_citation", "dst_title",
    )


def most_common(counts: DataFrame, key: str, n: int, by: str = "n") -> DataFrame:
    """Top ``n`` of a count table; equal counts in key order."""
    return counts.orderBy(F.desc(by), key).limit(n)


def fathers_index(pericopes: DataFrame) -> DataFrame:
    """``verse key -> pericope`` rows with the commentators in first-seen order."""
    fathers = F.array_join(F.array_distinct(F.transform("segments", lambda s: s["father"])), ", ")
    named = pericopes.select("id", "citation", fathers.alias("father_summary"), "work", "commented_verse_keys")
    return named.select(each("commented_verse_keys").alias("key"), "id", "citation", "father_summary", "work")


def pericope_refs(pericopes: DataFrame) -> DataFrame:
    """Distinct references per pericope; what cannot be read keeps its raw text."""
    ref = lambda c: F.coalesce(normalize_ref(c["raw"])["ref"], c["raw"])
    refs = F.array_distinct(F.transform(F.filter("citations_out", lambda c: c["kind"] == "scripture"), ref))
    return pericopes.select("id", kept(refs, lambda r: F.size(r) > 0).alias("refs"))


def teaching_refs(nodes: DataFrame) -> DataFrame:
    """Distinct references per node; what cannot be read is left out."""
    ref = lambda c: normalize_ref(c["raw"])["ref"]
    refs = F.transform(F.filter("citations_out", lambda c: c["kind"] == "scripture"), ref)
    listed = F.array_distinct(F.filter(refs, lambda r: r.isNotNull()))
    return nodes.select("id", kept(listed, lambda r: F.size(r) > 0).alias("refs"))


def gloss_weight(pericopes: DataFrame) -> DataFrame:
    """Per verse: named commentators, summed over the pericopes on it."""
    named = F.filter(F.transform("segments", lambda s: F.coalesce(s["father"], F.lit(""))), lambda f: f != "")
    sized = pericopes.select("commented_verse_keys", F.size(F.array_distinct(named)).alias("w"))
    weighted = sized.select(each("commented_verse_keys").alias("key"), "w")
    return weighted.groupBy("key").agg(F.sum("w").cast("long").alias("weight"))


def fragment_totals(pericopes: DataFrame) -> DataFrame:
    """Pericopes, fragments, distinct commentators and verses per gospel.

    Distinct values are reduced per gospel before they are counted, so four groups do
    not mean four tasks that hold every value.
    """
    base = pericopes.select(
        F.col("slug"), F.size("segments").alias("fragments"),
        F.transform("segments", lambda s: s["father"]).alias("fathers"), "commented_verse_keys",
    )
    sums = base.groupBy("slug").agg(F.count("*").alias("pericopes"), F.sum("fragments").cast("long").alias("fragments"))
    distinct = lambda col, name: (
        base.select("slug", each(col).alias("v")).distinct().groupBy("slug").agg(F.count("v").alias(name))
    )
    return (
        sums.join(distinct("fathers", "fathers"), "slug", "left")
        .join(distinct("commented_verse_keys", "verses"), "slug", "left")
        .fillna(0, ["fathers", "verses"])
    )


def adjacency_chunks(
    edges: DataFrame, key: str, entry: list[str], size: int = 1000, most: int = MOST, scratch: list[DataFrame] | None = None
) -> DataFrame:
    """``(key, label, entries)``: each key's entries in order, in lists of up to ``size``.

    A list's label is its key, and for lists after the first also the place it starts at.
    No list grows with the corpus. Edges are ranged over tasks once, and a task sorts and
    numbers the entries of its keys; entries of a key with more than ``most`` have their
    places before and are ranged by list, so no task holds such a key. The lists come
    ranged by (key, chunk). Pass a settled edge table: its keys are counted first. Tables
    that the lists are read from are added to ``scratch``.
    """
    rows = edges.where(F.col(key).isNotNull()).select(key, F.struct(*entry).alias("entry"))
    hot = settle(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(key), "hot-keys")
    own = rows.withColumns({"bucket": F.lit(0).cast("long"), "place": F.lit(0).cast("long")})
    tables, by = [hot], [key]
    if not hot.isEmpty():
        few = F.broadcast(hot)  # no more than the edges by ``most``
        placed, held = _places(rows.join(few, key, "left_semi"), key)
        tables += held
        by = [key, "bucket"]
        lists = placed.select(key, "entry", F.floor(F.col("pos") / size).alias("bucket"), F.col("pos").alias("place"))
        own = own.join(few, key, "left_anti").unionByName(lists)
    if scratch is not None:
        scratch += tables
    # Ranged by list before the lists are made: they stay where their edges are sorted.
    spot = Window.partitionBy(*by).orderBy("place", "entry")
    at = own.repartitionByRange(*by).select(key, "bucket", "entry", (F.col("bucket") * size + F.row_number().over(spot) - 1).alias("pos"))
    chunked = at.withColumn("chunk", F.floor(F.col("pos") / size))
    lists = chunked.groupBy(key, "bucket", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "entry"))).alias("held"))
    label = F.when(F.col("chunk") == 0, F.col(key)).otherwise(F.concat(F.col(key), F.lit(CONTINUED), (F.col("chunk") * size).cast("string")))
    return lists.select(key, "chunk", label.alias("label"), F.transform("held", lambda h: h["entry"]).alias("entries"))


def _places(rows: DataFrame, key: str) -> tuple[DataFrame, list[DataFrame]]:
    """``(key, entry, pos)`` of entries in their key's order, and the tables it is read from.

    Rows are ranged over tasks by (key, entry) and numbered in their range, and the ranges
    before add what they hold of the range's first key.
    """
    # Rows of a sorted range are numbered where they stand, from the range's number times 2 ** 33.
    row = F.monotonically_increasing_id()
    ranged = rows.repartitionByRange(key, "entry").sortWithinPartitions(key, "entry").select(key, "entry", row.alias("row"))
    ranged = settle(ranged.withColumn("part", F.shiftright("row", 33)), "edges")
    held = ranged.groupBy("part", key).agg(F.count("*").alias("n"), F.min("row").alias("first"))
    # Of a key that runs over ranges, how many entries stand in earlier ones.
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A written table: while it is small by its size the edges stay where they are.
    before = settle(held.select("part", key, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("before")), "places")
    return ranged.join(before, ["part", key]).select(key, "entry", (F.col("before") + F.col("row")).alias("pos")), [ranged, before]
