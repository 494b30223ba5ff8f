"""Connected components of an edge table by alternating stars.

Every round replaces edges by edges to smaller nodes and writes the result to the shared
folder, so lineage stays short and a lost executor costs one round. A node of any degree
is only ever reduced by a minimum, which tasks combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, settle


def _print_of(df: DataFrame):
    return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(edges.select("low", "high"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("m"))
    ends = F.explode(F.array("high", "low"))
    return edges.join(least, "high").select(ends.alias("high"), F.col("m").alias("low")).where("high != low").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)`` but the roots themselves.

    The root is the smallest node of a component. Loops and repeated edges do no harm,
    edges with a null end are left out, and an empty table gives an empty one.
    """
    high, low = F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    now = settle(edges.where("a != b").select(high, low).distinct(), "edges")
    before, after = None, _print_of(now)
    while after[0] and after != before:
        large = settle(_large_star(now), "large-star")
        new = settle(_small_star(large), "small-star")
        discard(now, large)
        now, before, after = new, after, _print_of(new)
    return now.select(F.col("high").alias("node"), F.col("low").alias("root"))
