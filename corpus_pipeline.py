"""From raw documents to packed training sequences, one written table a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import lines, mixing, near, packing, quality
from lectern.session import load, settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier doesn't reject."""
    return quality.accepted(docs, load(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines their source repeats."""
    return lines.drop_lines(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 0.8 of their five-word shingles."""
    return near.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every piece and its place in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good), ("line dedup", drop_lines), ("simhash near-dedup", drop_copies),
    ("mix to target weights", mix_sources), ("best-fit packing", pack_sequences),
]
#: The classifier, fingerprints, sampling and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
