"""Sources mixed to target weights by cube-method balanced sampling.

A source's target over its size says how often each of its documents is taken: a whole
number of times for certain and once more with the fraction that is left, the inclusion
probability. The cube method decides those: it moves the probabilities through the
null-space of the constraints (the documents' sizes and their number), so every step
leaves the expected words and documents of the source as they are, and stops when one of
the probabilities has become 0 or 1. With two constraints three documents are enough for
a step.

Hot sources: documents of a source are dealt into blocks by a hash of their id, text and
number among the rows that have both in common, so that no id fills a block, and every
block is walked on its own; it leaves at most two undecided documents. These meet in
blocks of the next round, until a source has one block. Only there the landing follows:
the number of documents is given up as a constraint, then the words, for the two smallest
documents left. So no task ever holds a source, and words stay balanced through all
rounds.

Rounds depend on ids, sizes and sources alone, so reruns agree. Defined results: a null
or wordless text has size 0 and takes nothing; rows that repeat are decided one by one; a
null source is one source, the last; if no document has a word all targets are 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, keyed, rows_with, settle, unboxed

WEIGHTS = (5, 2, 1)
MOST = 3
#: Documents walked in one task at a time.
BLOCK = 2048
#: Rows that are numbered in one task at a time, as a power of two.
NUMBERED = 11
#: From so many documents on, those that make up for a large one keep their number too.
MANY = 64
SEED = 6
_EPS = 1e-9


def _ranked(sizes: DataFrame) -> DataFrame:
    """Sources numbered from 0 by code point, null last, without one task for all.

    Ranges of sources are counted first; a source's number is its number in its range and
    the sources of the ranges before.
    """
    parted = sizes.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parted = settle(parted, "sources")
    lengths = sorted((r["part"], r["n"]) for r in parted.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, sum_ = {}, 0
    for part, n in lengths:  # one number for each task of the sort
        before[part], sum_ = sum_, sum_ + n
    shift = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("part")) if before else F.lit(0)
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return parted.withColumn("rank", inside - 1 + shift).drop("part")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``(source, source_size, documents, target)`` of a table of sizes by source.

    All sources share the whole of all sizes by weight; a target that would pass ``most``
    times its source's size stops there and the excess goes to the others by weight.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    held = settle(_ranked(sizes).withColumn("weight", weight), "source-weights")
    cap, level = F.col("source_size") * float(most), 0.0
    total = float(held.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        full = F.col("weight") * level > cap
        row = held.agg(
            F.sum(F.when(full, cap).otherwise(0.0)).alias("capped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        new = (total - (row["capped"] or 0.0)) / row["weight"] if row["weight"] else level
        if new <= level:
            return held.select("source", "source_size", "documents", F.least(F.col("weight") * level, cap).alias("target"))
        level = new


def _step(a, b, c):
    """A direction that changes neither the sum nor the size-weighted sum of three."""
    u = (b - c, c - a, a - b)
    return u if any(u) else (1.0, -1.0, 0.0)


def _move(p, u, draw):
    """One step of the martingale along ``u``: some probability becomes 0 or 1."""
    up = down = float("inf")
    for x, d in zip(p, u):
        if d > 0:
            up, down = min(up, (1 - x) / d), min(down, x / d)
        elif d < 0:
            up, down = min(up, -x / d), min(down, -(1 - x) / d)
    by = up if draw * (up + down) < down else -down
    moved = [x + by * d for x, d in zip(p, u)]
    return [0.0 if x < _EPS else 1.0 if x > 1 - _EPS else x for x in moved]


def _against(size, sizes, p):
    """Changes of many documents that make up for one more of ``size``.

    Few documents give up their number as a constraint, so that their words suffice.
    """
    w = p * (1 - p)
    m0, m1, m2 = w.sum(), (w * sizes).sum(), (w * sizes * sizes).sum()
    if len(p) < MANY or m0 * m2 - m1 * m1 <= 1e-9 * m0 * m2:
        return w * (-size / m1)
    slope = (m1 - size * m0) / (m0 * m2 - m1 * m1)
    return w * ((-1 - slope * m1) / m0 + slope * sizes)


def _move_all(p, u, draw):
    """``_move`` of many."""
    to_one, to_zero = np.where(u > 0, 1 - p, p), np.where(u > 0, p, 1 - p)
    with np.errstate(divide="ignore", invalid="ignore"):
        up, down = (np.nanmin(np.where(u == 0, np.inf, room / np.abs(u))) for room in (to_one, to_zero))
    moved = p + (up if draw * (up + down) < down else -down) * u
    return np.where(moved < _EPS, 0.0, np.where(moved > 1 - _EPS, 1.0, moved))


def walk(sizes, probabilities, draws, land: bool):
    """New probabilities of a block, at most two of them undecided; none after landing.

    Documents come with the largest first. Those that make up the larger half of the words
    are walked by threes, what they leave undecided is decided against all the others
    together, and so on with the others. So the documents left at the end are the smallest.
    """
    out = np.array([0.0 if p <= _EPS else 1.0 if p >= 1 - _EPS else p for p in probabilities])
    sizes = np.array(sizes, dtype=float)
    todo, draws, open_ = np.nonzero((out > 0) & (out < 1))[0], iter(draws), []
    while len(todo):
        words = np.cumsum(sizes[todo])
        middle = int(np.searchsorted(words, words[-1] / 2)) + 1 if len(todo) > 4 else len(todo)
        head, todo, open_ = todo[:middle].tolist(), todo[middle:], []
        p, size = out[head].tolist(), sizes[head].tolist()
        for i in range(len(head)):
            open_.append(i)
            if len(open_) == 3:
                for j, x in zip(open_, _move([p[j] for j in open_], _step(*(size[j] for j in open_)), next(draws))):
                    p[j] = x
                open_ = [j for j in open_ if 0 < p[j] < 1]
        out[head] = p
        open_ = [head[j] for j in open_]
        for i in open_:
            while 0 < out[i] < 1 and len(todo):
                u = np.append(1.0, _against(sizes[i], sizes[todo], out[todo]))
                both = np.append(i, todo)
                out[both] = _move_all(out[both], u, next(draws))
                todo = todo[(out[todo] > 0) & (out[todo] < 1)]
        open_ = [i for i in open_ if 0 < out[i] < 1]
    if land and len(open_) == 2:
        i, j = open_
        out[[i, j]] = _move([out[i], out[j]], (sizes[j], -sizes[i]), next(draws))
        open_ = [k for k in open_ if 0 < out[k] < 1]
    if land and open_:
        out[open_[0]] = float(next(draws) < out[open_[0]])
    return out.tolist()


def _round(df: DataFrame, number: int) -> DataFrame:
    """Walk every block; ``last`` blocks are a source's only one and land."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "pick", "n"], ascending=[False, True, True], kind="stable")
        first = group.iloc[0]
        rng = np.random.default_rng([SEED, number, int(first["pick"]) & 0x7FFFFFFF, len(group)])
        land = bool(first["last"])
        group["p"] = walk(group["size"].tolist(), group["p"].tolist(), rng.random(2 * len(group) + 4).tolist(), land)
        return group[["n", "source", "size", "pick", "p"]]

    return df.groupBy("source", "block").applyInPandas(run, "n long, source string, size long, pick long, p double")


def _blocks(df: DataFrame, block: int, number: int) -> DataFrame:
    """Deal the undecided documents of each source into blocks of about ``block``."""
    counts = df.groupBy("source").agg(F.count(F.lit(1)).alias("here"))
    joined = df.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    blocks = F.ceil(F.col("here") / block).cast("long")
    dealt = F.pmod(F.xxhash64("pick", F.lit(number)), blocks)
    return joined.select(*df.columns, dealt.alias("block"), (blocks == 1).alias("last"))


def sample(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(n, chosen)`` of units ``(n, source, size, pick, p)``: 1 for those the walk takes.

    ``n`` is unique, ``pick`` orders and deals the units and ``p`` is the probability.
    """
    undecided = (F.col("p") > _EPS) & (F.col("p") < 1 - _EPS)
    decided, number = units.where(~undecided), 0
    left = settle(units.where(undecided), "undecided")
    while not left.isEmpty():
        done = settle(_round(_blocks(left, block, number), number), "walked")
        decided = decided.union(done.where(~undecided))
        left, number = done.where(undecided), number + 1
    return decided.select("n", (F.col("p") >= 0.5).cast("long").alias("chosen"))


def sized(df: DataFrame, *more: str) -> DataFrame:
    """``(n, doc_id, source, size, told, *more)`` of documents, written once; ``n`` is unique."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    return settle(df.select("doc_id", "source", words, F.xxhash64("text").alias("told"), *more).withColumn("n", F.monotonically_increasing_id()), "sizes")


def picked(held: DataFrame) -> DataFrame:
    """``held (n, doc_id, source, size, told)`` with ``pick``, a hash that tells all rows apart.

    Rows alike in all but ``n`` are numbered, in runs of ``n`` so that no task has them all;
    which of them has which number makes no difference, so reruns agree.
    """
    alike, run = F.xxhash64("doc_id", "source", "size", "told"), F.shiftrightunsigned("n", NUMBERED)
    rows = held.withColumn("alike", alike).withColumn("run", run)
    counts = rows.groupBy("alike", "run").agg(F.count(F.lit(1)).alias("here"))
    before = F.sum("here").over(Window.partitionBy("alike").orderBy("run")) - F.col("here")
    place = F.row_number().over(Window.partitionBy("alike", "run").orderBy("n"))
    numbered = rows.withColumn("place", place).join(counts.withColumn("before", before).drop("here"), ["alike", "run"])
    pick = F.xxhash64("doc_id", "alike", F.col("before") + F.col("place"), F.lit(SEED)).alias("pick")
    return numbered.select(*held.columns, pick)


def decide(held: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """Copies of each row of ``held (n, doc_id, source, size, told)``, with its source's figures."""
    sums = [F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")]
    by_source = settle(targets(held.groupBy("source").agg(*sums), weights, most).withColumnRenamed("source", "s"), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = held.join(by_source, F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", rate)
    whole = F.floor(F.col("rate") + _EPS)
    units = picked(joined.where("size > 0")).select("n", "source", "size", "pick", F.greatest(F.col("rate") - whole, F.lit(0.0)).alias("p"))
    chosen = sample(units, block)
    copies = (whole + F.coalesce("chosen", F.lit(0))).cast("long").alias("copies")
    return joined.join(chosen, "n", "left").select("n", "doc_id", "source", "size", "source_size", "target", copies)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The documents the mix takes, as often as it takes them, with their columns."""
    rows = keyed(docs)
    names = [F.col("row").getField(c).alias(c) for c in ("doc_id", "source", "text")]
    held = sized(rows.select(*names, "ka", "kb"), "ka", "kb")
    decided = decide(held, weights, most).select("n", "copies").join(held.select("n", "ka", "kb", "size"), "n")
    # Equal rows are decided one by one and then taken together.
    sums = [F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("size") > 0, F.col("copies")).otherwise(0)).alias("copies")]
    taken = settle(decided.groupBy("ka", "kb").agg(*sums).where("copies > 0"), "taken")
    return unboxed(rows_with(rows, taken).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per document its size, its source's size and target and the words taken of it."""
    held = sized(docs.select("doc_id", "source", "text"))
    return decide(held, weights, most).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
