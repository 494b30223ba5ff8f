"""Lexical index: per-document term counts, document frequencies, corpus statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import canon
from ..functions.columns import each
from ..functions.text import term_counts, tokenize
from ..session import settle
from . import blockmax

#: The term that stands for the document itself.
SENTINEL = ""
#: Bytes of text that are counted at once.
PIECE = 1 << 21
_WORD = np.zeros(256, bool)
_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyz"]] = True


def analyze(docs: DataFrame, text: Column | str = "text", id_col: str = "id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, dl, terms)``: one row per document, counted in place without a shuffle."""
    text = F.col(text) if isinstance(text, str) else text
    tokens = docs.select(F.col(id_col).alias("id"), *keep, tokenize(text).alias("tokens"))
    return tokens.select("id", *keep, F.size("tokens").alias("dl"), term_counts(F.col("tokens")).alias("terms"))


def _counts(ids: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """``(id, dl, term, f)`` of lower-cased texts, counted over all of them at once.

    The bytes of words are kept and cut into tokens; each is numbered, and equal numbers of
    a text are counted by sorting. A row with the empty term and the length goes ahead of
    the terms of each text.
    """
    raw = text.fill_null("").cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[1:-1][at[1:-1] < len(data)]  # a text's end ends its last word
    first[edges] = inside[edges]
    starts, word = np.nonzero(first)[0], np.cumsum(first)[inside] - 1
    sizes = np.bincount(word, minlength=len(starts))
    long = sizes > 1
    cuts = np.concatenate([[0], np.cumsum(sizes[long])]).astype(np.int32)
    kept = data[inside][long[word]]
    tokens = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(kept)).dictionary_encode()
    row, code = np.searchsorted(at, starts[long], "right") - 1, tokens.indices.to_numpy()
    said = ~pc.is_in(tokens.dictionary, pa.array(canon.STOPWORDS)).to_numpy(zero_copy_only=False)[code]
    row, code = row[said], code[said]
    lengths = pa.array(np.bincount(row, minlength=len(raw)).astype(np.int32), mask=text.is_null().to_numpy(zero_copy_only=False))
    width = len(tokens.dictionary) + 1
    keys, f = np.unique(np.concatenate([row * width + code + 1, np.arange(len(raw)) * width]), return_counts=True)
    row, code = np.divmod(keys, width)
    dl = lengths.take(pa.array(row))
    terms = pa.concat_arrays([pa.array([SENTINEL]), tokens.dictionary]).take(pa.array(code))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), dl, terms, pc.if_else(pa.array(code == 0), dl, pa.array(f.astype(np.int32)))], ["id", "dl", "term", "f"])


def counted(docs: DataFrame, text: Column | str = "text", id_col: str = "id") -> DataFrame:
    """``(id, dl, term, f)``: the rows of ``term_frequency``, and a sentinel row a document.

    The sentinel has the empty term and f = dl. Texts are lower-cased by Spark and counted
    some megabytes at a time, which takes a third of the time of sorting each one's tokens.
    """
    text = F.col(text) if isinstance(text, str) else text
    lowered = docs.select(F.col(id_col).alias("id"), F.lower(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            a = 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PIECE, "right")))
                yield _counts(ids.slice(a, b - a), texts.slice(a, b - a))
                a = b

    return lowered.mapInArrow(run, f"id {dict(lowered.dtypes)['id']}, dl int, term string, f int")


def term_frequency(analyzed: DataFrame) -> DataFrame:
    """``(id, dl, term, f)``, a narrow explode."""
    return analyzed.select("id", "dl", each("terms").alias("t")).select("id", "dl", "t.term", "t.f")


def doc_frequency(tf: DataFrame) -> DataFrame:
    """``(term, df)``; partial counts keep a hot term from crowding one task."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def corpus_stats(analyzed: DataFrame) -> DataFrame:
    """``(n, avgdl)``; documents without tokens count, an empty corpus has avgdl 0."""
    return analyzed.agg(
        F.count("*").alias("n"), F.coalesce(F.avg(F.col("dl").cast("double")), F.lit(0.0)).alias("avgdl")
    )


def term_saturation(f, dl, avgdl, k1: float = canon.BM25_K1, b: float = canon.BM25_B) -> Column:
    return (f * (k1 + 1)) / (f + k1 * (1 - b + b * dl / avgdl))


@dataclass(frozen=True)
class Index:
    """A stored index: ``postings (term, id, f, dl)``, ``terms (term, df)``, ``stats (n, avgdl)``.

    ``blocks (term, block, most, ids, ws)`` are the postings once more, by blocks of documents
    in order of id, with their saturations and the largest of them. One question is answered
    out of ``postings`` and many out of ``blocks``; the one that isn't stored is None.
    """

    postings: DataFrame | None
    terms: DataFrame
    stats: DataFrame
    blocks: DataFrame | None


def write_index(docs: DataFrame, path: str, text: Column | str = "text", id_col: str = "id", stored: tuple[str, ...] = ("postings", "blocks")) -> None:
    """Tokenize the corpus once and store what questions need: ``stored`` besides terms and stats.

    Postings are ranged by (term, id), so a term of a third of the corpus is split over
    files and a rare one is found by the files' and row groups' least and greatest term.
    """
    # Ranged before they are tokenized: the sample that ranges are taken from would do it twice.
    named = docs.select(F.col(id_col).alias("id"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    analyzed = settle(analyze(blockmax.with_blocks(named), keep=("block",)), "analyzed")
    corpus_stats(analyzed).write.parquet(f"{path}/stats")
    avgdl = docs.sparkSession.read.parquet(f"{path}/stats").select("avgdl").scalar()
    tf = analyzed.select("block", "id", "dl", each("terms").alias("t")).select("block", "id", "dl", "t.term", "t.f")
    if "postings" in stored:
        tf.select("term", "id", "f", "dl").repartitionByRange("term", "id").sortWithinPartitions("term", "id").write.parquet(f"{path}/postings")
    doc_frequency(tf).repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{path}/terms")
    if "blocks" not in stored:
        return
    blocks = blockmax.posting_blocks(tf.select("block", "term", "id", term_saturation(F.col("f"), F.col("dl"), avgdl).alias("w")))
    blocks.select("term", "block", "most", "ids", "ws").repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.parquet(f"{path}/blocks")


def read_index(spark: SparkSession, path: str, stored: tuple[str, ...] = ("postings", "blocks")) -> Index:
    return Index(**{name: spark.read.parquet(f"{path}/{name}") if name in ("terms", "stats", *stored) else None for name in ("postings", "terms", "stats", "blocks")})
