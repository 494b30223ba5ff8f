"""Readers for the corpus formats. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import each_at
from ..functions.text import CP1252_FROM, CP1252_TO, decode_cp1252
from ..functions.vectors import unpack_f16
from ..operators.graph import CONTINUED
from ..operators.project import searchable
from . import bigjson


def scan_jsonl(spark: SparkSession, path, schema: str = schemas.NODE) -> DataFrame:
    """JSON-lines nodes; blank lines are skipped, a broken line stops the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_jsonl_filtered(spark: SparkSession, path, schema: str = schemas.NODE) -> DataFrame:
    """Nodes for the keyword index; a node without a type is kept."""
    return searchable(scan_jsonl(spark, path, schema))


def scan_adjacency(spark: SparkSession, path, entry: str = schemas.ADJACENCY_ENTRY, whole: bool = False) -> DataFrame:
    """Key-to-list JSON objects as ``(key, pos, entry...)`` rows.

    ``pos`` is the place in the key's whole list, over however many lines the sink wrote
    it. Lines split over tasks; ``whole`` reads files that are a single object each, in
    splits as well. A path without files gives no rows.
    """
    schema = f"map<string,array<{entry}>>"
    parts = F.split("label", CONTINUED, 2)
    named = F.element_at(parts, 1).alias("key"), F.coalesce(F.try_element_at(parts, F.lit(2)).cast("long"), F.lit(0)).alias("from")
    if whole:
        held = bigjson.scan_object(spark, path).where("pos IS NOT NULL").withColumnRenamed("key", "label")
        read = F.from_json(F.concat(F.lit('{"e":'), "value", F.lit("}")), f"e {entry}")["e"].alias("e")
        rows = held.select(*named, F.col("pos").alias("at"), read)
        return rows.select("key", (F.col("from") + F.col("at")).alias("pos"), "e.*")
    try:
        raw = spark.read.text(path)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        raw = spark.createDataFrame([], "value string")
    keyed = raw.select(F.explode(F.from_json("value", schema)).alias("label", "entries"))
    # A further line of a key is labelled with the place its entries start at.
    rows = keyed.select(*named, "entries").select("key", "from", each_at("entries").alias("at", "e"))
    return rows.select("key", (F.col("from") + F.col("at")).alias("pos"), "e.*")


def scan_html_pages(spark: SparkSession, path, glob: str = "*.htm*") -> DataFrame:
    """Landed pages as ``(url, html)``; undecodable bytes become replacement marks."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("url"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def scan_wholetext(spark: SparkSession, path, separator: str | None = None) -> DataFrame:
    """Long texts as ``(text)`` rows: per file, or per record ending in ``separator``.

    With a separator the file is read in splits, so its size does not matter.
    """
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path, wholetext=separator is None).select(F.col("value").alias("text"))


def scan_lines(spark: SparkSession, path) -> DataFrame:
    """Text files as ``(file, block, seq, value)`` lines in splits: where a split begins and a
    line's place in it, so that (block, seq) is the order of a file's lines."""
    rows = spark.read.text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), "value")


def scan_cp1252(spark: SparkSession, path) -> DataFrame:
    """Windows-1252 text files as ``(path, value)`` lines, read in splits.

    The single-byte charset makes the CSV source a plain line reader here.
    """
    rows = (
        spark.read.schema("value string")
        .option("encoding", "ISO-8859-1").option("sep", "\x01").option("quote", "").option("escape", "\x01")
        .option("lineSep", "\n")
        .csv(path)
    )
    value = F.regexp_replace(F.translate("value", CP1252_FROM, CP1252_TO), r"\r$", "")
    return rows.select(F.col("_metadata.file_path").alias("path"), value.alias("value"))


def scan_cp1252_files(spark: SparkSession, path) -> DataFrame:
    """Windows-1252 files as ``(path, text)``, one row per file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", decode_cp1252(F.col("content")).alias("text"))


def scan_f16_vectors(spark: SparkSession, path) -> DataFrame:
    """Half-precision vectors packed next to their ids: ``(id, vector)``."""
    packed = spark.read.parquet(path)
    return packed.withColumn("vector", unpack_f16("vector"))


def scan_lectionary(spark: SparkSession, path, whole: bool = False) -> DataFrame:
    """Date-to-reading JSON as ``(date, gospel, day)``: an object per line or per file."""
    raw = spark.read.text(path, wholetext=whole)
    entries = raw.select(F.explode(F.from_json("value", "map<string,struct<gospel:string,day:string>>")).alias("d", "e"))
    return entries.select(F.to_date("d").alias("date"), "e.gospel", "e.day")


def scan_verse_map(spark: SparkSession, path) -> DataFrame:
    """The columns a lookup needs of verse files, one row per key: the last one read.

    The order is that of the files' names and of the lines in them.
    """
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return verse_map(scan_jsonl(spark, path, schemas.VERSE).withColumn("place", place), "place")


def verse_map(verses: DataFrame, order: str) -> DataFrame:
    """One row per key, the last by ``order``; a maximum keeps the aggregate partial."""
    kept = F.max_by(F.struct("id", "text", "citation", "book", "chapter", "verse"), order).alias("v")
    return verses.groupBy("verse_key").agg(kept).select("verse_key", "v.*")


def read_json_object(spark: SparkSession, path: str) -> dict:
    """A one-row statistics or manifest file."""
    return json.loads(spark.read.text(path).first()["value"])
