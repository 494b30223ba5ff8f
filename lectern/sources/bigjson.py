"""One huge JSON object read by many tasks.

A file is cut at byte offsets, wherever they fall. What a cut needs to know is the state
there: whether it stands inside a string, how deep, under which key and after how many of
its entries. Each split is summarised without knowing its own state (its quotes' parity,
and its depth for either state of its start), the summaries are composed from the file's
beginning on, and a second summary with the state known tells the keys and entries. Only
then rows are made: a split gives the entries whose opening mark stands in it and reads
on past its end for the last one. So an entry is parsed once, by one task, whatever the
size of the object or of one key's list. The driver holds one small row for each split.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from .halves import _at

#: Bytes of a split, and read past its end at first.
SPLIT = 16 << 20
TAIL = 1 << 16
_BLANK = (32, 9, 10, 13)
_MARK = np.isin(np.arange(256), list(b"{}[],:"))
_SPAN = "file string, number long, begin long, end long, size long, inside int, depth int, kind int, key string, pos long"


def _bytes(file: str, begin: int, end: int) -> np.ndarray:
    files, where = _at(file)
    with files.open_input_file(where) as held:
        return np.frombuffer(held.read_at(max(0, end - begin), begin), np.uint8)


def _slashes(file: str, begin: int) -> int:
    """How many backslashes stand right before a place, modulo two."""
    at = begin
    while at > 0:
        data = _bytes(file, max(0, at - 256), at)
        other = np.nonzero(data != 92)[0]
        if len(other):
            return (begin - (at - len(data) + int(other[-1]) + 1)) % 2
        at -= len(data)
    return begin % 2


def _quotes(data: np.ndarray, slashes: int) -> np.ndarray:
    """Which bytes are quotes that open or close a string."""
    quotes = data == 34
    slash = np.nonzero(data == 92)[0]
    begins, ends = slash[np.diff(slash, prepend=-2) != 1], slash[np.diff(slash, append=len(data) + 1) != 1] + 1
    # A run of backslashes at the start goes on from those before it.
    odd = ends[(ends - begins + np.where(begins == 0, slashes, 0)) % 2 == 1]
    quotes[odd[odd < len(data)]] = False
    if slashes == 1:
        quotes[:1] = False
    return quotes


def _parity(quotes: np.ndarray) -> np.ndarray:
    """Quotes up to each byte, modulo two."""
    return np.bitwise_xor.accumulate(quotes.view(np.uint8)) if len(quotes) else quotes.view(np.uint8)


def _steps(kinds: np.ndarray) -> np.ndarray:
    """How marks change the depth."""
    return ((kinds == 123) | (kinds == 91)).astype(np.int64) - ((kinds == 125) | (kinds == 93))


@dataclass
class Marks:
    """Where a piece of JSON has its quotes, its marks outside strings, and how deep those stand."""

    data: np.ndarray
    quotes: np.ndarray
    places: np.ndarray
    kinds: np.ndarray
    depth: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, slashes: int, inside: int, depth: int) -> "Marks":
        quotes = _quotes(data, slashes)
        places = np.nonzero(_MARK[data] & (_parity(quotes) == inside))[0]
        kinds = data[places]
        step = _steps(kinds)
        return cls(data, np.nonzero(quotes)[0], places, kinds, depth + np.cumsum(step) - step)

    def at(self, mark: str, depth: int) -> np.ndarray:
        return self.places[(self.kinds == ord(mark)) & (self.depth == depth)]

    def solid(self, place: int) -> int:
        """The first byte after a place that is no white space; -1 past the end."""
        if place + 1 < len(self.data) and self.data[place + 1] not in _BLANK:
            return place + 1
        rest = self.data[place + 1:]
        found = np.nonzero(~np.isin(rest[:4096], _BLANK))[0]
        if not len(found) and len(rest) > 4096:
            found = np.nonzero(~np.isin(rest, _BLANK))[0]
        return place + 1 + int(found[0]) if len(found) else -1


def _opened(marks: Marks, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Commas between a list's entries and the kind of value open at each place asked for."""
    openers = np.sort(np.concatenate([marks.at("[", 1), marks.at("{", 1)]))
    commas = marks.at(",", 2)
    last = np.searchsorted(openers, commas) - 1
    kinds = np.where(last < 0, kind, marks.data[openers[np.maximum(last, 0)]] if len(openers) else kind)
    return commas[kinds == 91], openers


def _key(file: str, begin: int, marks: Marks, colon: int) -> str:
    """The key before a colon; it may begin in front of the split."""
    before = int(np.searchsorted(marks.quotes, colon))
    if before >= 2:
        return json.loads(marks.data[marks.quotes[before - 2]:marks.quotes[before - 1] + 1].tobytes())
    room = 1024
    while True:
        low = max(0, begin + colon - room)
        text = _bytes(file, low, begin + colon).tobytes().rstrip()
        at = len(text) - 1
        while (at := text.rfind(b'"', 0, at)) >= 0:
            slashes = len(text[:at]) - len(text[:at].rstrip(b"\\"))
            if slashes % 2 == 0 and (slashes < at or low == 0):
                return json.loads(text[at:])
        if low == 0:
            raise ValueError(f"no key before byte {begin + colon} of {file}")
        room *= 4


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parity of a split's quotes and its change of depth for either state of its start."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            data, slashes = _bytes(r["file"], r["begin"], r["end"]), _slashes(r["file"], r["begin"])
            quotes = _quotes(data, slashes)
            places = np.nonzero(_MARK[data])[0]
            step, within = _steps(data[places]), _parity(quotes)[places] == 1
            out.append((r["file"], r["number"], int(quotes.sum() % 2), int(step[~within].sum()), int(step[within].sum())))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["file", "number", "parity", "out", "within"])


def _entries(r: dict, marks: Marks, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks before ``limit`` that open an entry of a list, colons of keys, and openers of values."""
    commas, openers = _opened(marks, r["kind"])
    lists = [p for p in marks.at("[", 1).tolist() if p < limit and marks.data[marks.solid(p)] != 93]
    opens = np.sort(np.concatenate([np.array(lists, dtype=np.int64), commas[commas < limit]]))
    colons = marks.at(":", 1)
    return opens, colons[colons < limit], openers[openers < limit]


def _whole(r: dict, more: int) -> tuple[Marks, int]:
    """A split with some of what follows, and its own length."""
    end = min(r["size"], r["end"] + more)
    return Marks.of(_bytes(r["file"], r["begin"], end), _slashes(r["file"], r["begin"]), r["inside"], r["depth"]), r["end"] - r["begin"]


def _settled(r: dict, marks: Marks, own: int, end: int) -> bool:
    """Whether what follows each own mark is in sight."""
    last = [held[held < own][-1:].tolist() for held in (marks.at("[", 1), marks.at(":", 1))]
    return end >= r["size"] or all(marks.solid(p) >= 0 for p in last[0] + last[1])


def _second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A split's last key, the kind of its last value, and its entries before and after the keys."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            more = TAIL
            while True:
                marks, own = _whole(r, more)
                if _settled(r, marks, own, r["end"] + more):
                    break
                more *= 4
            opens, colons, openers = _entries(r, marks, own)
            key = _key(r["file"], r["begin"], marks, int(colons[-1])) if len(colons) else None
            head = int((opens < colons[0]).sum()) if len(colons) else len(opens)
            # The kind of the value open at the start is not known yet, so its commas are counted apart.
            unknown = marks.at(",", 2)
            unknown = int((unknown < min(own, int(openers[0]) if len(openers) else own)).sum())
            out.append((r["file"], r["number"], key, int(marks.data[openers[-1]]) if len(openers) else None, head, len(opens) - head, unknown))
        if out:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["file", "number", "last", "opened", "head", "tail", "unknown"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, pos, value)`` of a split: its lists' entries, and values that are no list with ``pos`` null."""
    for batch in batches:
        for r in batch.to_pylist():
            more = TAIL
            while True:
                marks, own = _whole(r, more)
                opens, colons, _ = _entries(r, marks, own) if _settled(r, marks, own, r["end"] + more) else (None, None, None)
                if opens is not None:
                    plain = [c for c in colons.tolist() if marks.data[marks.solid(c)] != 91]
                    inner = np.sort(np.concatenate([marks.at(",", 2), marks.at("]", 2)]))
                    outer = np.sort(np.concatenate([marks.at(",", 1), marks.at("}", 1)]))
                    late = (opens[-1:].tolist() and not (inner > opens[-1]).any()) or (plain and not (outer > plain[-1]).any())
                    if not late:
                        break
                if r["end"] + more >= r["size"]:
                    raise ValueError(f"{r['file']} ends inside a value")
                more *= 4
            keys = [_key(r["file"], r["begin"], marks, c) for c in colons.tolist()]
            under = np.searchsorted(colons, opens) - 1
            first = np.searchsorted(under, under)
            place = np.arange(len(opens)) - first + np.where(under < 0, r["pos"], 0)
            ends = inner[np.searchsorted(inner, opens, side="right")] if len(opens) else opens
            text = lambda a, b: marks.data[a + 1:b].tobytes().decode()
            rows = [(keys[u] if u >= 0 else r["key"], int(p), text(a, b)) for u, p, a, b in zip(under.tolist(), place.tolist(), opens.tolist(), ends.tolist())]
            number = {c: i for i, c in enumerate(colons.tolist())}
            rows += [(keys[number[c]], None, text(c, int(outer[np.searchsorted(outer, c, side="right")]))) for c in plain]
            for at in range(0, len(rows), 4096):
                part = rows[at:at + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), (pa.string(), pa.int64(), pa.string()))], ["key", "pos", "value"])


def _files(path: str) -> list[tuple[str, int]]:
    files, where = _at(path)
    info = files.get_file_info(where)
    if info.type == pafs.FileType.Directory:
        found = files.get_file_info(pafs.FileSelector(where, recursive=True))
        prefix = path[: len(path) - len(where)] if path.endswith(where) else ""
        return sorted((prefix + f.path, f.size) for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))
    return [(path, info.size)] if info.type == pafs.FileType.File else []


def scan_object(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """``(key, pos, value)`` of the objects in a file or folder, values as JSON text.

    The entries of a list are a row each; a value that is no list is one row without
    ``pos``. A path without files gives no rows, a file that is cut off stops the read.
    """
    spans = [
        {"file": f, "number": n, "begin": b, "end": min(size, b + split), "size": size, "inside": 0, "depth": 0, "kind": 0, "key": None, "pos": 0}
        for f, size in _files(path) for n, b in enumerate(range(0, size, split))
    ]
    frame = lambda: spark.createDataFrame([tuple(s.values()) for s in spans], _SPAN).repartition(max(1, len(spans)), "file", "number")
    if spans:
        found = {(r.file, r.number): r for r in frame().mapInArrow(_first, "file string, number long, parity long, out long, within long").collect()}
        inside = depth = 0
        for s in spans:
            inside, depth = (0, 0) if not s["number"] else (inside, depth)
            s["inside"], s["depth"] = inside, depth
            r = found[s["file"], s["number"]]
            depth += r.within if inside else r.out
            inside ^= r.parity
            if s["end"] == s["size"] and (inside or depth):
                raise ValueError(f"{s['file']} is no whole JSON object")
        schema = "file string, number long, last string, opened int, head long, tail long, unknown long"
        found = {(r.file, r.number): r for r in frame().mapInArrow(_second, schema).collect()}
        kind, key, pos = 0, None, 0
        for s in spans:
            kind, key, pos = (0, None, 0) if not s["number"] else (kind, key, pos)
            s["kind"], s["key"], s["pos"] = kind, key, pos
            r = found[s["file"], s["number"]]
            # Commas of a list that was open at the start are entries of it.
            extra = r.unknown if kind == 91 else 0
            pos = r.tail if r.last is not None else pos + r.head + extra
            kind, key = r.opened or kind, r.last if r.last is not None else key
    return frame().mapInArrow(_rows, "key string, pos long, value string")
