"""Token totals by source, language and tokenizer version, kept by signed changes.

A batch of changes is reduced to one signed row per key and written under its own name;
totals are the sums over the committed batches, so an insert, a delete or a revised count
never reads the corpus again. A batch counts from the moment its folder has Spark's
``_SUCCESS`` mark. Committing the same name again changes nothing, and a commit that
broke off is written over by the next try. ``compact`` folds the committed batches into
one table that remembers their names.

Defined results: a null source, language or version is a key of its own; a null text has
no tokens and still counts as a document; null token counts are 0. Each row of a change
table is one document, repeats included. Keys whose documents and tokens are both back at
0 are left out. Without a committed batch the totals are an empty table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import VOCABULARY, Encoder

KEYS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, documents long, tokens long"


def counted(docs: DataFrame, version: str = VOCABULARY, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, source, lang, version, tokens, *extra)`` of every document, whole texts."""

    def run(batches):
        encode = Encoder(version)
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text").cast(pa.binary()))
            tokens = [0 if t is None else len(encode(t.decode("utf-8", "replace"))) // 4 for t in texts]
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(tokens, pa.int64())], [*kept, "tokens"])

    held = docs.select("doc_id", "source", "lang", F.lit(version).alias("version"), *extra, "text")
    return held.mapInArrow(run, held.drop("text").withColumn("tokens", F.lit(0).cast("long")).schema)


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).alias("documents"), (-F.coalesce("tokens", F.lit(0))).alias("tokens"))


def revisions(counts: DataFrame, old: str = "old_tokens", new: str = "tokens") -> DataFrame:
    """Changed counts of documents that stay under their key."""
    change = F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))
    return counts.select(*KEYS, F.lit(0).alias("documents"), change.alias("tokens"))


def _summed(changes: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast("long").alias(c) for c in ("documents", "tokens")]
    return changes.groupBy(*KEYS).agg(*sums)


class Rollup:
    """Totals in a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _there(self, name: str) -> bool:
        files, path = self._path(f"{name}/_SUCCESS")
        return files.exists(path)

    def _names(self, kind: str) -> list[str]:
        files, path = self._path(kind)
        found = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return sorted(n for n in found if self._there(f"{kind}/{n}"))

    def _base(self) -> tuple[str | None, set[str]]:
        """The newest compacted table and the batches in it."""
        bases = self._names("bases")
        if not bases:
            return None, set()
        names = self.spark.read.schema("batch string").parquet(f"{self.folder}/bases/{bases[-1]}/batches")
        return bases[-1], {r.batch for r in names.collect()}

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of signed changes; False if it is there already."""
        if batch in self._base()[1] or self._there(f"batches/{batch}"):
            return False
        _summed(changes).write.mode("overwrite").parquet(f"{self.folder}/batches/{batch}")
        return True

    def totals(self) -> DataFrame:
        base, inside = self._base()
        paths = [f"{self.folder}/batches/{n}" for n in self._names("batches") if n not in inside]
        paths += [f"{self.folder}/bases/{base}/totals"] if base else []
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return _summed(self.spark.read.schema(SCHEMA).parquet(*paths)).where("documents != 0 OR tokens != 0")

    def compact(self) -> None:
        """Fold all committed batches into one table; their folders are no longer read."""
        base, inside = self._base()
        names = sorted(inside | set(self._names("batches")))
        number = int(base) + 1 if base else 0
        into = f"{self.folder}/bases/{number:08d}"
        self.totals().write.mode("overwrite").parquet(f"{into}/totals")
        self.spark.createDataFrame([(n,) for n in names], "batch string").write.mode("overwrite").parquet(f"{into}/batches")
        files, mark = self._path(f"bases/{number:08d}/_SUCCESS")
        files.create(mark, True).close()
