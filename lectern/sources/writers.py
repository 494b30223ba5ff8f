"""Writers: partitioned node files, adjacency, statistics, bundles, vectors."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import pack_f16
from ..operators.graph import adjacency_chunks
from ..session import discard, lean
from .halves import _at

#: Files of a folder that pages are written to.
FOLDER_FILES = 1000


def packed(rows: DataFrame, level: str = "FOUR") -> DataFrameWriter:
    """Writer of JSON lines in gzip files, which Spark's text and JSON readers open by their name.

    Of the nine levels the sixth is gzip's own; on check_s's texts the fourth is 4 % larger
    and three times as fast.
    """
    return rows.write.option("compression", "gzip").option("zlib.compress.level", level)


def sink_jsonl_partitioned(nodes: DataFrame, path: str, by: str, order: list[str], rows_per_file: int = 200_000) -> None:
    """JSON lines under one folder per ``by`` value, each file in ``order``.

    Range partitioning on (by, order) splits a large value over several tasks and keeps
    small ones together.
    """
    (
        nodes.repartitionByRange(by, *order)
        .sortWithinPartitions(by, *order)
        .write.option("maxRecordsPerFile", rows_per_file)
        .option("ignoreNullFields", "false")
        .partitionBy(by)
        .json(path)
    )


def sink_adjacency(
    edges: DataFrame, path: str, key: str, entry: list[str], size: int = 1000, whole: bool = False, level: str = "FOUR"
) -> None:
    """JSON objects ``{key: [entries]}``, keys and entries in order: one a line, or one a file.

    A key with more than ``size`` entries takes several lists; each says where it starts.
    Lines are packed; an object a file is not, as it is read in splits.
    """
    scratch: list[DataFrame] = []

    def one_object(batches):
        began = False
        for batch in batches:
            # The members of a line's object, behind a comma but for the first.
            members = [v[1:-1] for v in batch.column("value").to_pylist()]
            if members:
                lines = [("," if began or i else "{") + m for i, m in enumerate(members)]
                began = True
                yield pa.RecordBatch.from_arrays([pa.array(lines)], ["value"])
        if began:
            yield pa.RecordBatch.from_arrays([pa.array(["}"])], ["value"])

    with lean(edges.sparkSession):
        chunks = adjacency_chunks(edges, key, entry, size, scratch=scratch).sortWithinPartitions(key, "chunk")
        lines = chunks.select(F.to_json(F.create_map(F.col("label"), F.col("entries"))).alias("value"))
        if whole:
            lines.mapInArrow(one_object, "value string").write.text(path)
        else:
            packed(lines, level).text(path)
    discard(*scratch)


def to_object(row: DataFrame) -> DataFrame:
    return row.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def sink_stats(row: DataFrame, path: str) -> None:
    """A one-row aggregate as one JSON object."""
    to_object(row).coalesce(1).write.text(path)


def sink_manifest(counts: DataFrame, path: str, **fixed: str) -> None:
    """Counts plus the descriptive fields of an edition."""
    sink_stats(counts.select("*", *[F.lit(v).alias(k) for k, v in fixed.items()]), path)


def sink_vectors(rows: DataFrame, path: str, vector: str = "vector") -> None:
    """Unit vectors in half precision next to their ids."""
    rows.select("id", pack_f16(vector).alias("vector")).write.parquet(path)


def sink_pages(pages: DataFrame, path: str) -> None:
    """``(page_id, value)`` as a file ``page_id=<id>.txt`` for each page, its value behind a line end.

    A task writes its pages one after the other into folders of its own, so nothing is left
    to be renamed page by page when it ends; run again, it writes the same files. Rows of
    one id in a task share a file, a row without a value is an empty line.
    """

    def run(batches):
        (files, where), task = _at(path), TaskContext.get().partitionId()
        last, held, count = None, [], 0

        def put():
            nonlocal count
            folder = f"{where}/part=t{task}n{count // FOLDER_FILES}"
            if count % FOLDER_FILES == 0:
                files.create_dir(folder, recursive=True)
            with files.open_output_stream(f"{folder}/page_id={'' if last is None else last}.txt") as out:
                out.write(b"".join(held))
            count += 1

        for batch in batches:
            for page, value in zip(batch.column("page_id").to_pylist(), batch.column("value").to_pylist()):
                if held and page != last:
                    put()
                    held = []
                last = page
                held.append((value or b"") + b"\n")
        if held:
            put()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["files"])

    files, where = _at(path)
    files.create_dir(where, recursive=True)  # also for a table without pages
    sorted_ = pages.select("page_id", F.col("value").cast("binary").alias("value")).sortWithinPartitions("page_id")
    sorted_.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def counting(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows`` with a counter that the write of them fills; nothing is read again."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def counts_of(spark: SparkSession, seen: dict[str, Observation], name: str) -> DataFrame:
    """``(name, rows)`` of counters whose writes are done."""
    return spark.createDataFrame([(k, o.get.get("rows", 0)) for k, o in seen.items()], f"{name} string, rows long")


def export_bundle(subsets: dict[str, DataFrame], path: str, spent: dict[str, list[DataFrame]] | None = None) -> DataFrame:
    """Write each flat subset and return ``(subset, rows)`` for the card, counted by the writes.

    ``spent`` has, by the last subset that reads them, settled tables that are removed after it.
    """
    seen, spark = {}, next(iter(subsets.values())).sparkSession
    with lean(spark):
        for name, rows in subsets.items():
            held, seen[name] = counting(rows)
            packed(held).json(f"{path}/{name}")
            discard(*(spent or {}).get(name, []))
    return counts_of(spark, seen, "subset")


def sink_keyed(rows: DataFrame, key: Column, value: Column, path: str, level: str = "FOUR") -> None:
    """``{key: value}`` lines, the split form of one large JSON object."""
    packed(rows.select(F.to_json(F.create_map(key, value)).alias("value")), level).text(path)
