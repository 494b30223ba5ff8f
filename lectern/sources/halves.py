"""A Spark data source for vectors in bare half-precision files.

A table is a folder: every part is a file of little-endian half-precision rows, nothing
else, beside a file of its ids, and ``meta.json`` names the parts, their rows and the
length of a vector. A file and a list of ids written by another program are read as they
are (``file`` and a ``meta`` that holds ``ids``).

Rows have one length, so a file is read from any row on: a task gets a file, a first row
and a number of rows, reads those bytes and hands on one Arrow batch; no row becomes a
Python object. Tasks of a write put their parts under a name of their own; the commit
names them in ``meta.json``, which is written last, so a reader sees all of a write or
nothing of it, and an aborted write leaves only files that no table names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FORMAT = "half_vectors"
#: Rows of a task of a read, and of a batch of ids.
SPLIT_ROWS = 1 << 16


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a plain path or a URI that Arrow knows."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _read(path: str, first: int = 0, size: int | None = None) -> bytes:
    files, where = _at(path)
    with files.open_input_file(where) as held:
        return held.read_at(held.size() - first if size is None else size, first)


def _size(path: str) -> int:
    files, where = _at(path)
    found = files.get_file_info(where)
    return found.size if found.type == pafs.FileType.File else -1


@dataclass
class Rows(InputPartition):
    """So many rows of a file from ``first`` on; ``ids`` where they are not in a file."""

    file: str
    first: int
    rows: int
    batch: int | None = None
    ids: list | None = None


@dataclass
class Part(WriterCommitMessage):
    name: str
    rows: int
    dims: int


class Reader(DataSourceReader):
    def __init__(self, folder: str | None, meta: dict, file: str | None, split: int):
        self.folder, self.meta, self.file, self.split = folder, meta, file, split

    def partitions(self) -> list[Rows]:
        width, out = 2 * self.meta["dims"], []
        if self.file:
            parts = [(self.file, len(self.meta["ids"]), self.meta["ids"])]
        else:
            parts = [(f"{self.folder}/{p['name']}", p["rows"], None) for p in self.meta["parts"]]
        for file, rows, ids in parts:
            name = file if ids is not None else f"{file}.f16.bin"
            if _size(name) != rows * width:
                raise ValueError(f"{name} has {_size(name)} bytes where {rows} rows of {width} are named")
            for number, first in enumerate(range(0, rows, self.split)):
                n = min(self.split, rows - first)
                out.append(Rows(file, first, n, None if ids is not None else number, None if ids is None else ids[first:first + n]))
        return out

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        dims = self.meta["dims"]
        name = part.file if part.ids is not None else f"{part.file}.f16.bin"
        data = np.frombuffer(_read(name, part.first * dims * 2, part.rows * dims * 2), "<f2").astype(np.float32)
        offsets = np.arange(part.rows + 1, dtype=np.int32) * dims
        kind = pa.int64() if self.meta["id"] == "long" else pa.string()
        if part.ids is not None:
            ids = pa.array(part.ids, kind)
        else:
            files, where = _at(f"{part.file}.ids.arrow")
            with pa.ipc.open_file(files.open_input_file(where)) as held:
                ids = held.get_batch(part.batch).column("id")
        yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(data))], ["id", "vector"])


class Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, id_kind: str, overwrite: bool, split: int):
        self.folder, self.id_kind, self.overwrite, self.split = folder, id_kind, overwrite, split

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        """Unit vectors in half precision; a zero vector stays as it is. Vectors must be there and of one length."""
        name, total, dims = f"part-{uuid.uuid4().hex}", 0, 0
        files, where = _at(self.folder)
        files.create_dir(where, recursive=True)
        kind = pa.int64() if self.id_kind == "long" else pa.string()
        schema, waiting = pa.schema([("id", kind)]), []
        with files.open_output_stream(f"{where}/{name}.f16.bin") as out, files.open_output_stream(f"{where}/{name}.ids.arrow") as beside:
            with pa.ipc.new_file(beside, schema) as ids:
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    lists, id_ = batch.column("vector"), batch.column("id")
                    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                    if lists.null_count or id_.null_count or lists.flatten().null_count or len({*sizes.tolist()}) > 1 or (dims and sizes[0] != dims) or not sizes[0]:
                        raise ValueError("every row needs an id and a vector, and all vectors one length")
                    dims = int(sizes[0])
                    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                    norms = np.sqrt(np.einsum("ij,ij->i", x, x))
                    out.write(np.ascontiguousarray((x / np.where(norms == 0, 1.0, norms)[:, None]).astype("<f2")).tobytes())
                    total += len(x)
                    waiting.append(id_.cast(kind))
                    # Batches of ids as long as a split of a read, so that each is found by its number.
                    while sum(map(len, waiting)) >= self.split:
                        held = pa.concat_arrays(waiting)
                        ids.write_batch(pa.record_batch([held[: self.split]], schema))
                        waiting = [held[self.split:]]
                rest = pa.concat_arrays(waiting) if waiting else pa.array([], kind)
                if len(rest):
                    ids.write_batch(pa.record_batch([rest], schema))
        return Part(name, total, dims)

    def commit(self, messages: list[Part | None]) -> None:
        parts = [m for m in messages if m and m.rows]
        self._remove([m.name for m in messages if m and not m.rows])
        lengths = {m.dims for m in parts}
        if len(lengths) > 1:
            self.abort(messages)
            raise ValueError(f"vectors of {sorted(lengths)} components in one table")
        files, where = _at(self.folder)
        there = _size(f"{self.folder}/meta.json") >= 0
        old = json.loads(_read(f"{self.folder}/meta.json"))["parts"] if there else []
        if there and old and not self.overwrite and lengths and json.loads(_read(f"{self.folder}/meta.json"))["dims"] not in lengths:
            self.abort(messages)
            raise ValueError("the table's vectors have another length")
        kept = [] if self.overwrite else old
        meta = {
            "dims": lengths.pop() if lengths else 0, "count": sum(p["rows"] for p in kept) + sum(m.rows for m in parts), "dtype": "float16",
            "normalized": True, "id": self.id_kind, "split": self.split, "parts": kept + [{"name": m.name, "rows": m.rows} for m in parts],
        }
        if kept and not meta["dims"]:
            meta["dims"] = json.loads(_read(f"{self.folder}/meta.json"))["dims"]
        files.create_dir(where, recursive=True)
        temporary = f"{where}/meta-{uuid.uuid4().hex}.json"
        with files.open_output_stream(temporary) as out:
            out.write(json.dumps(meta).encode())
        files.move(temporary, f"{where}/meta.json")
        if self.overwrite:
            self._remove([p["name"] for p in old])

    def abort(self, messages: list[Part | None]) -> None:
        self._remove([m.name for m in messages if m])

    def _remove(self, names: list[str]) -> None:
        files, where = _at(self.folder)
        for name in names:
            for end in ("f16.bin", "ids.arrow"):
                if files.get_file_info(f"{where}/{name}.{end}").type == pafs.FileType.File:
                    files.delete_file(f"{where}/{name}.{end}")


class HalfVectors(DataSource):
    """``id`` and ``vector`` rows of a folder, or of a ``file`` and the ``meta`` beside it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _meta(self) -> dict:
        if "file" in self.options:
            meta = json.loads(_read(self.options["meta"]))
            return {**meta, "id": "long" if all(isinstance(i, int) for i in meta["ids"]) and meta["ids"] else "string"}
        return json.loads(_read(f"{self.options['path']}/meta.json"))

    def schema(self) -> str:
        return f"id {self._meta()['id']}, vector array<float>"

    def reader(self, schema) -> Reader:
        meta = self._meta()
        return Reader(self.options.get("path"), meta, self.options.get("file"), meta.get("split", SPLIT_ROWS) if "file" not in self.options else int(self.options.get("split", SPLIT_ROWS)))

    def writer(self, schema, overwrite: bool) -> Writer:
        kind = {f.name: f.dataType.simpleString() for f in schema.fields}["id"]
        return Writer(self.options["path"], "string" if kind == "string" else "long", overwrite, int(self.options.get("split", SPLIT_ROWS)))


def scan(spark: SparkSession, path: str) -> DataFrame:
    """``(id, vector)`` of a folder that ``sink`` wrote."""
    spark.dataSource.register(HalfVectors)
    return spark.read.format(FORMAT).load(path)


def scan_file(spark: SparkSession, file: str, meta: str, split: int = SPLIT_ROWS) -> DataFrame:
    """``(id, vector)`` of one bare file and the JSON that lists its ids in order."""
    spark.dataSource.register(HalfVectors)
    return spark.read.format(FORMAT).option("file", file).option("meta", meta).option("split", split).load()


def sink(rows: DataFrame, path: str, overwrite: bool = False, split: int = SPLIT_ROWS) -> None:
    """Write ``rows (id, vector)`` scaled to unit length; without ``overwrite`` they are added."""
    rows.sparkSession.dataSource.register(HalfVectors)
    rows.select("id", "vector").write.format(FORMAT).option("split", split).mode("overwrite" if overwrite else "append").save(path)
