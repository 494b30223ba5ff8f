"""Small helpers of the pipeline operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle


# The words of the contracts are runs of other bytes than these.
WORD = r"[^\x20\x09-\x0D]+"


def column(name: str) -> Column:
    """A top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def boxed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that no working column can clash with them."""
    return df.select(F.struct(*[column(c) for c in df.columns]).alias("row"))


def unboxed(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def keyed(df: DataFrame) -> DataFrame:
    """``(row, ka, kb)``: all columns as one struct, and 128 bits that tell equal rows.

    Hashes skip nulls, so which columns are null is hashed too.
    """
    rows = boxed(df)
    nulls = F.concat(*[F.col("row").getField(c).isNull().cast("string") for c in df.columns])
    return rows.select("row", F.xxhash64("row", nulls).alias("ka"), F.xxhash64(nulls, "row", F.lit(1)).alias("kb"))


def rows_with(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """One of the equal rows of ``rows (row, ka, kb)`` for each key of ``wanted``, with its columns.

    ``wanted (ka, kb, n, ...)`` says how many rows have a key; most are alone and are only
    joined. Rows that repeat are reduced in every task before they are shuffled.
    """
    alone = rows.join(wanted.where("n = 1").drop("n"), ["ka", "kb"])
    equal = rows.join(wanted.where("n > 1").select("ka", "kb"), ["ka", "kb"], "left_semi").groupBy("ka", "kb").agg(F.first("row").alias("row"))
    again = equal.join(wanted.where("n > 1").drop("n"), ["ka", "kb"])
    return alone.unionByName(again)
