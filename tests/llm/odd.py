"""Rows that operators must not trip over."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "Plain words stand here, one after the other.", "en", "a", 44),
    (1, "Plain words stand here, one after the other.", "en", "a", 44),
    (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \t\n ", "de", "b", 4), (None, "no id at all", "en", None, 12),
    (5, "ein  doppelter   Abstand\n\n und <|endoftext|> darin ", "de", "b", 52), (6, "wort " * 60_000, "de", "c", 300_000),
    (7, "Ünïcödé — \U0001f600 text here\r\nnext line", "fr", "", 30), (None, None, None, None, None),
]
#: Names the operators use inside.
CLASH = ["n", "row", "fp", "score", "size", "part", "place", "gone", "left", "key", "copies", "block", "p", "ids", "number"]


def odd_docs(spark, clash=True):
    docs = spark.createDataFrame(ROWS, DOCS)
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)]) if clash else docs


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id long, quality int, toxic int"


def rows_as_text(df):
    return sorted(str(tuple(r)) for r in df.collect())
