"""Periodic runs of words: where a text says the same over and over, and the text without it.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
equal) that is at least ``max(LEAST, TIMES * q)`` long and that no neighbouring word extends.

Periods are taken by octaves, ``2 ** k <= q < 2 ** (k + 1)``. A document is exploded into
overlapping tiles of each octave, which hold boundaries every ``2 ** k`` words. A tile is
solved alone: at each boundary ``c`` one Z-function of the words after it and one of the
words before it, read backwards, tell how far the words around ``c`` agree with those
around ``c + q``, for all ``q`` of the octave at once. That gives fragments of runs; they
are shuffled by document and period, and fragments that share at least ``q`` words are
stitched to one. A run meets three boundaries or more, so its fragments always overlap.

Only tiles that may hold a run are made: a run's first boundary stands before ``2 ** (k +
1)`` words that follow again ``q`` words later, which hashes of such blocks tell (equal
blocks have equal hashes, so nothing is lost), and boundaries deep inside a stretch of a
smaller period can't have a period of this octave as their smallest. Tiles have a bounded
number of words or of boundaries. The task that reads a document solves its tiles one by
one; those of a document of more than ``SPREAD`` words are dealt over all tasks, so a very
long text is solved by many. What is shuffled is fragments, and the texts that have some.

Defined results: a null text has no words. Words are compared byte by byte. Rows that
repeat are judged each; ids may be null. A text without runs stays as its words, joined
by one space. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

LEAST = 6
TIMES = 4
#: Words of a tile, but for octaves whose tile of one boundary is longer.
TILE = 8192
#: Words from which on a document's tiles are dealt over the tasks, and tiles of such a task.
SPREAD = 100_000
TASK_TILES = 256
#: Rows and bytes of text handed on at a time.
BATCH, BYTES = 1024, 1 << 22
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: A function of (doc_id, words) that gives the words to look at.
Rewrite = Callable[[object, list[bytes]], list[bytes]]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _A
    return x ^ (x >> np.uint64(29))


def numbers_of(words: list[bytes]) -> np.ndarray:
    """A number for each word; equal words have equal numbers and no others."""
    seen: dict[bytes, int] = {}
    add = seen.setdefault
    return np.fromiter((add(w, len(seen)) for w in words), np.int32, len(words))


def boundaries(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """``(octave, first, last)`` of the groups of boundaries that may see a run."""
    n, k, found = len(ids), 0, []
    name = _mixed(ids.astype(np.uint64) + np.uint64(1))
    stretches: list[tuple[int, int]] = []  # of smaller periods, each at least as long as asked below
    while n >= max(LEAST, TIMES << k):
        step = 1 << k
        name = _mixed(name[:-step] + _B * name[step:])  # of blocks of twice the step
        rows = -(-len(name) // step)
        held = np.zeros(rows * step, np.uint64)
        held[: len(name)] = name
        held = held.reshape(rows, step)
        same = held[1:] == held[:-1, :1]
        at = np.nonzero(same.any(axis=1))[0]
        if len(at):
            offset = same[at].argmax(axis=1) + step
            keep = np.ones(rows + 4, dtype=bool)
            for a, b in stretches:
                if b - a >= 4 * step:
                    keep[-(-a // step):(b - 4 * step) // step + 1] = False
            # Boundaries in a row that agree at one offset stand in a stretch of that period.
            cuts = np.nonzero((np.diff(at) != 1) | (np.diff(offset) != 0))[0]
            for i, j in zip([0, *(cuts + 1)], [*cuts, len(at) - 1]):
                a, b = int(at[i]) * step, int(at[j]) * step + 2 * step + int(offset[i])
                if b - a >= 8 * step:
                    stretches.append((a, b))
            at = at[keep[at]]
        if len(at):
            cuts = np.nonzero(np.diff(at) > 3)[0]
            found += [(k, int(at[i]), int(at[j]) + 2) for i, j in zip([0, *(cuts + 1)], [*cuts, len(at) - 1])]
        k += 1
    return found


def cut(ids: np.ndarray, tile: int = TILE) -> list[tuple[int, int, int, int, np.ndarray]]:
    """Tiles ``(octave, first, last, low, ids)``: boundaries and the words from ``low`` on."""
    out = []
    for k, first, last in boundaries(ids):
        step, more = 1 << k, max(1, tile >> k)
        for a in range(first, last + 1, more):
            b = min(a + more - 1, last)
            if a * step < len(ids):
                low = max(0, (a - 1) * step)
                out.append((k, a, b, low, ids[low:b * step + 3 * step]))
    return out


def z_function(s: list) -> list[int]:
    """How many items from each place on agree with the beginning."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def divisors(q: int) -> list[int]:
    small = [d for d in range(1, int(q**0.5) + 1) if q % d == 0]
    return [d for d in {*small, *(q // d for d in small)} if d < q]


def solve(k: int, first: int, last: int, low: int, ids: np.ndarray) -> list[tuple[int, int, int]]:
    """Fragments ``(period, start, end)`` of runs in a tile, those that hang together as one."""
    step, words, open_, done = 1 << k, ids.tolist(), {}, []
    for number in range(first, last + 1):
        c = number * step - low
        if c >= len(words):
            break
        after = z_function(words[c:c + 3 * step])
        left = words[max(0, c - step):c][::-1]
        # Backwards: the words before c, a mark, then the words from c + 2 * step down.
        back = z_function(left + [-1] + words[max(0, c - step):c + 2 * step][::-1])
        top = len(left) + 1 + min(2 * step, len(words) - c)
        for q in range(step, min(2 * step, len(after))):
            if after[q] + back[top - q] < step:
                continue
            if any(after[d] >= q - d for d in divisors(q)):
                continue
            a, b = number * step - back[top - q], number * step + q + after[q]
            if q in open_ and a + q <= open_[q][1]:
                open_[q][1] = max(open_[q][1], b)
            else:
                if q in open_:
                    done.append((q, *open_[q]))
                open_[q] = [a, b]
    return done + [(q, *span) for q, span in open_.items()]


def _scan(docs: DataFrame, rewrite: Rewrite | None, tile: int, spread: int) -> DataFrame:
    """A row for each document and one for each fragment or unsolved tile of it.

    A fragment has a ``period``, a tile an ``octave``; a document has its text's words in
    ``joined`` if there is either.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"n long, doc_id {kind}, words long, told string, joined binary, octave int, first long, last long, low long, ids binary, period long, start long, end long"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            doc_ids, rows, size = batch.column("doc_id"), [], 0
            kinds = [pa.int64(), doc_ids.type, pa.int64(), pa.string(), pa.binary(), pa.int32(), *[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 3]
            out = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
            for n, doc_id, text in zip(batch.column("n"), doc_ids, batch.column("text").cast(pa.binary())):
                n, doc_id, words = n.as_py(), doc_id.as_py(), (text.as_py() or b"").split()
                if rewrite:
                    words = rewrite(doc_id, words)
                joined, tiles, spans = b" ".join(words), cut(numbers_of(words), tile), []
                if len(words) <= spread:
                    tiles, spans = [], [span for t in tiles for span in solve(*t)]
                held = joined if tiles or spans else None
                rows.append((n, doc_id, len(words), hashlib.sha256(joined).hexdigest(), held, *[None] * 8))
                rows += [(n, *[None] * 9, *span) for span in spans]
                size += len(held or b"")
                for k, a, b, low, ids in tiles:
                    rows.append((n, *[None] * 4, k, a, b, low, ids.tobytes(), *[None] * 3))
                    size += ids.nbytes
                    if size >= BYTES:
                        yield out()
                        rows, size = [], 0
                if len(rows) >= BATCH or size >= BYTES:
                    yield out()
                    rows, size = [], 0
            if rows:
                yield out()

    return docs.select(F.monotonically_increasing_id().alias("n"), "doc_id", "text").mapInArrow(run, schema)


def _fragments(tiles: DataFrame) -> DataFrame:
    """``(n, period, start, end)`` of the tiles' solutions."""

    def run(batches):
        for batch in batches:
            own = [batch.column(c).to_pylist() for c in ("n", "octave", "first", "last", "low")]
            rows = []
            for n, k, first, last, low, ids in zip(*own, batch.column("ids")):
                found = solve(k, first, last, low, np.frombuffer(ids.as_buffer(), np.int32))
                rows += [(n, *span) for span in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["n", "period", "start", "end"])

    return tiles.mapInArrow(run, "n long, period long, start long, end long")


def stitch(fragments: DataFrame) -> DataFrame:
    """Runs ``(n, start, length, period)`` from fragments that share a period's words."""
    order = Window.partitionBy("n", "period").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("start") + F.col("period") > reach).cast("int"), F.lit(1))
    parted = fragments.withColumn("new", new).withColumn("island", F.sum("new").over(order))
    whole = parted.groupBy("n", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    return whole.where(length >= F.greatest(F.lit(LEAST), F.col("period") * TIMES)).select("n", "start", length.alias("length"), "period")


def _collapsed(found: DataFrame) -> DataFrame:
    """``found``'s columns with ``joined`` cut: a run's words after its first period go."""

    def run(batches):
        for batch in batches:
            at, out = batch.schema.get_field_index("joined"), []
            for joined, spans in zip(batch.column("joined"), batch.column("runs")):
                spans = spans.as_py()
                if not spans:
                    out.append(None)
                    continue
                words = joined.as_py().split(b" ")
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for s in spans:
                    gone[s["start"] + s["period"]] += 1
                    gone[s["start"] + s["length"]] -= 1
                out.append(b" ".join(words[i] for i in np.nonzero(np.cumsum(gone[:-1]) == 0)[0].tolist()))
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), pa.array(out, pa.binary())],
                                             [*(c for c in batch.schema.names if c != "joined"), "joined"])

    kept = [c for c in found.columns if c != "joined"]
    return found.select(*kept, "joined").mapInArrow(run, found.select(*kept, "joined").schema)


def detect(docs: DataFrame, rewrite: Rewrite | None = None, tile: int = TILE, spread: int = SPREAD) -> DataFrame:
    """Per document ``(doc_id, words, runs, collapsed, told)``.

    ``runs`` are ``(start, period, length)`` by start, then period; ``collapsed`` is the text
    without repetition where there are runs, else null; ``told`` is the SHA-256 of the whole
    text's words joined by one space.
    """
    held = settle(_scan(docs, rewrite, tile, spread), "tiles")
    tiles = held.where("octave IS NOT NULL").select("n", "octave", "first", "last", "low", "ids")
    found = held.where("period IS NOT NULL").select("n", "period", "start", "end")
    many = tiles.count()
    if many:
        dealt = tiles.repartition(-(-many // TASK_TILES), "n", "octave", "first")
        found = found.unionByName(settle(_fragments(dealt), "fragments"))
    by_doc = stitch(found).groupBy("n").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    spans = by_doc.schema["runs"].dataType
    texts = held.where("words IS NOT NULL").select("n", "doc_id", "words", "told", "joined")
    plain = texts.where("joined IS NULL").select("doc_id", "words", "told", F.lit(None).cast("binary").alias("joined"), F.array().cast(spans).alias("runs"))
    met = texts.where("joined IS NOT NULL").join(by_doc, "n", "left").select("doc_id", "words", "told", "runs", "joined")
    cut_ = _collapsed(met).withColumn("runs", F.coalesce("runs", F.array().cast(spans)))
    every = cut_.unionByName(plain)
    return every.select("doc_id", "words", "runs", F.col("joined").cast("string").alias("collapsed"), "told")


def digest(found: DataFrame) -> DataFrame:
    """Of ``detect``'s rows the number of runs, the longest one, and hashes of all of it."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    read = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.coalesce(F.sha2("collapsed", 256), "told").alias("collapsed_sha256"))
    start, period, length = -F.col("best.start"), -F.col("best.period"), F.col("best.length")
    milli = F.floor((length * 1000 - length * 1000 % period) / period)
    return read.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
                       milli.cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
