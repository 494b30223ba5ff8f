"""Documents packed into sequences of a fixed number of tokens by minimum bin slack.

A document is its ids and one end id. Only what is longer than a sequence is cut, into
pieces of a whole sequence, the first of which may be shorter. Pieces of one length are
alike, so the bins are planned on the counts by length, a table with no more rows than a
sequence has tokens, however large the corpus. Per bin, a dynamic programme over bitsets
finds the fullest combination that holds the longest piece left; the combination is
removed as often as the counts allow, which is one step of the plan.

Each piece gets the number it has among the pieces of its length: its number in the task
that read it and the number of such pieces in the tasks before. A length that a third of
all pieces have needs no window and no sort. The plan then gives the place by number.

Defined results: a null or empty text is one piece, the end id. Ids of documents may be
null or repeat, every row is packed. An empty table gives no sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .tokens import VOCABULARY, Encoder

SIZE = 1024
END_ID = 2
#: Pieces a task hands on at a time; a longer document's come together.
BATCH = 2048
_PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long, part int, place long, ids array<int>"


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, vocabulary: str = VOCABULARY, ids: bool = True) -> DataFrame:
    """Pieces of every document; ``place`` is the number among its task's of that length."""
    keep_ids = ids
    schema = _PIECE.format(id=docs.schema["doc_id"].dataType.simpleString())

    def run(batches):
        encode, end = Encoder(vocabulary), np.array([end_id], dtype="<u4").tobytes()
        part, places = TaskContext.get().partitionId(), np.zeros(size + 1, dtype=np.int64)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place", "ids"]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())

        def made(batch, at, rows, held):
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            ids = pa.array(held, pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *arrays, ids], names)

        for batch in batches:
            at, rows, held = [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                text = text.as_py()
                found = encode(None if text is None else text.decode("utf-8", "replace")) + end
                total = len(found) // 4
                start, length = 0, total % size or size
                for piece in range(-(-total // size)):
                    cut = found[4 * start:4 * (start + length)]
                    at.append(i)
                    rows.append((piece, start, length, zlib.crc32(cut), part, places[length]))
                    held.append(np.frombuffer(cut, dtype="<i4") if keep_ids else None)
                    places[length] += 1
                    start, length = start + length, size
                if len(rows) >= BATCH:
                    yield made(batch, at, rows, held)
                    at, rows, held = [], [], []
            if rows:
                yield made(batch, at, rows, held)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how many of each come closest to ``room`` without passing it."""
    limit, reach, steps = (1 << room + 1) - 1, 1, []
    for length in sorted((k for k in counts if k <= room and counts[k]), reverse=True):
        more = reach
        for copies in range(1, min(counts[length], room // length) + 1):
            more |= reach << copies * length
        steps.append((length, reach))
        reach = more & limit
        if reach >> room & 1:
            break
    left, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        copies = 0
        while not before >> left & 1:
            left -= length
            copies += 1
        if copies:
            chosen[length] = copies
    return chosen


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, dict[int, int]]]:
    """Steps of the plan: how many bins, and how many pieces of which length in each."""
    left, steps = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        rest = {**left, longest: left[longest] - 1}
        chosen = fullest(rest, size - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        steps.append((times, chosen))
        for k, n in chosen.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return steps


def places(steps: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length, rows of (first number, pieces a bin, first bin, offset in the bin)."""
    used, found, first_bin = {}, {}, 0
    for times, chosen in steps:
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            found.setdefault(length, []).append((used.get(length, 0), n, first_bin, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        first_bin += times
    return {k: np.array(v, dtype=np.int64) for k, v in found.items()}


def _runs(df: DataFrame, steps: list[tuple[int, dict[int, int]]]) -> DataFrame:
    """``(length, firsts, runs)``: a length's runs in order of their first number.

    A step uses up a length or leaves less of it than a bin takes, so there are a few
    thousand runs at most, whatever the number of pieces.
    """
    rows = []
    for length, found in places(steps).items():
        rows.append((length, found[:, 0].tolist(), [tuple(r) for r in found.tolist()]))
    return df.sparkSession.createDataFrame(rows, "length long, firsts array<long>, runs array<struct<first:long,n:long,bin:long,offset:long>>")


def pack(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, vocabulary: str = VOCABULARY, ids: bool = True) -> DataFrame:
    """Every piece with its ids (if asked for) and its place in a sequence.

    Ids are written once with their piece and read once for the result: places come from
    two small tables, by task and by length, and no piece is shuffled while the table of
    the tasks is small enough to be sent out, which its written size tells.
    """
    held = settle(pieces(docs, size, end_id, vocabulary, ids), "pieces")
    by_part = settle(held.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # Collected: one row for each length there is, at most as many as a sequence has tokens.
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", F.struct("length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n")).alias("held"))
    before = settle(before.groupBy("part").agg(F.map_from_entries(F.collect_list("held")).alias("before")), "numbers")
    names = [c for c in held.columns if c not in ("part", "place")]
    number = (F.element_at("before", F.col("length")) + F.col("place")).alias("number")
    numbered = held.join(before, "part").select(*names, number)
    met = numbered.join(F.broadcast(_runs(docs, plan(counts, size))), "length")
    run = F.element_at("runs", F.size(F.filter("firsts", lambda x: x <= F.col("number"))))
    bin_ = F.expr("run.bin + (number - run.first) div run.n AS sequence_id")
    offset = F.expr("run.offset + (number - run.first) % run.n * length AS offset")
    return met.withColumn("run", run).select(*names, bin_, offset)
