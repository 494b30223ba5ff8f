"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes ratios.

A text's features are its different character n-grams, ``SHORTEST`` to ``LONGEST`` code
points of the lower-cased text with white space as single blanks. Each n-gram has a
log-count ratio: how much more often it stands in a toxic labelled document than in
another one. A logistic model is trained on features that are worth their ratio instead
of one, so that an n-gram that tells something starts with a large step and one that is
as frequent in both classes does nothing; those below ``LEAST_RATIO``, or in fewer than
``LEAST_DOCS`` labelled documents, are left out. A scale and a shift that were fitted on
labelled documents kept aside from counts and training turn its sum into a probability.

n-grams are hashed to ``1 << BITS`` numbers. Counting is a job over the labelled texts
whose tasks add up before they shuffle; the driver gets one row for each n-gram that is
frequent and telling enough, and the features of the labelled documents. Only labels are
sampled: at most ``SAMPLE`` labelled documents, those with the smallest hash of their id,
are learned from. Every document is scored by its whole text. Labels, language, source
and id are no inputs.

Defined results: a null text counts as empty, and an empty text gets the score of a text
without telling n-grams. Labels that are null are left out, those of one id are averaged,
and of rows that repeat a labelled id one is learned from. Without labels, or with one
class only, the score is the share of 1 (0.5 without labels). An empty table gives an
empty one.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, settle
from .quality import held_out

SHORTEST, LONGEST = 2, 6
BITS = 22
#: Most labelled documents learned from; the only sample.
SAMPLE = 40_000
#: An n-gram is a feature if so many labelled documents have it and its ratio is so far from 0.
LEAST_DOCS = 3
LEAST_RATIO = 1.0
#: One of so many labelled documents is kept aside for the probability.
ASIDE = 3
STEPS = 80
RATE = 0.2
DECAY = 1e-4
#: Weight of a toxic document in training, as they are few.
RARE = 3.0
UNIT = 0.1
THRESHOLD = 0.5
#: Code points hashed at a time, so a very long text needs little memory.
BLOCK = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def grams(text: bytes | None) -> Iterator[np.ndarray]:
    """Hashed n-grams of a text, block by block, repeats included."""
    plain = " " + " ".join((text or b"").decode("utf-8", "replace").lower().split()) + " "
    for at in range(0, max(1, len(plain) - 1), BLOCK):
        codes = np.frombuffer(plain[at:at + BLOCK + LONGEST - 1].encode("utf-32-le"), np.uint32).astype(np.uint64)
        h, found = codes + np.uint64(1), []
        for n in range(2, LONGEST + 1):
            if n > len(codes):
                break
            h = ((h[:-1] * _MIX) ^ (h[:-1] >> np.uint64(31))) + codes[n - 1:]
            if n >= SHORTEST:
                # A gram that starts in the next block is that block's.
                found.append(((h[:BLOCK] * _MIX) >> np.uint64(64 - BITS)).astype(np.int32))
        if found:
            yield np.concatenate(found)


def different(text: bytes | None, among: np.ndarray | None = None) -> np.ndarray:
    """The text's n-grams, each once and in order; ``among`` marks those that are wanted."""
    held = [np.unique(g if among is None else g[among[g]]) for g in grams(text)]
    return np.unique(np.concatenate(held)) if len(held) > 1 else held[0] if held else np.zeros(0, np.int32)


def learned(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``(toxic, aside, text)`` of the labelled documents learned from, written once."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = known.groupBy("doc_id").agg(F.avg("toxic").alias("toxic"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` ids are sent out; of rows that repeat an id one is kept, told by a
    # hash and reduced before the shuffle.
    every = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = every.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("told"), "text")).alias("first"))
    aside = (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(ASIDE)) == 0).alias("aside")
    return settle(one.select("doc_id", "toxic", aside, F.col("first.text").alias("text")), "labelled")


def counts(rows: DataFrame) -> DataFrame:
    """``(gram, toxic, other)``: how many documents of ``rows (toxic, text)`` have an n-gram, by class."""

    def run(batches):
        found = np.zeros((2, 1 << BITS), dtype=np.int32)
        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").cast(pa.binary())):
                found[0 if toxic >= 0.5 else 1, different(text.as_py())] += 1
        there = np.nonzero(found.any(axis=0))[0]
        if len(there):
            yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(found[0, there].astype(np.int64)), pa.array(found[1, there].astype(np.int64))], ["gram", "toxic", "other"])

    parts = rows.select("toxic", "text").mapInArrow(run, "gram int, toxic long, other long")
    return parts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def ratios(found: DataFrame, toxic: int, other: int, least_docs: int = LEAST_DOCS, least_ratio: float = LEAST_RATIO) -> tuple[np.ndarray, np.ndarray]:
    """n-grams in order and their log-count ratios, of those that tell something."""
    ratio = F.log((F.col("toxic") + 1) / F.lit(toxic + 2)) - F.log((F.col("other") + 1) / F.lit(other + 2))
    held = found.select("gram", (F.col("toxic") + F.col("other")).alias("docs"), ratio.alias("ratio"))
    table = held.where((F.col("docs") >= least_docs) & (F.abs("ratio") >= least_ratio)).select("gram", "ratio").toArrow()  # at most 1 << BITS
    order = np.argsort(table.column("gram").to_numpy())
    return table.column("gram").to_numpy()[order], table.column("ratio").to_numpy()[order]


@dataclass
class Model:
    """Weights of n-grams, the sum without any, and what makes a probability of a sum."""

    features: np.ndarray
    weights: np.ndarray
    start: float
    scale: float = 1.0
    shift: float = 0.0

    def scorer(self):
        """A function of texts; made in each task, with a table of all n-grams."""
        table = np.zeros(1 << BITS, dtype=np.float32)
        table[self.features] = self.weights
        among = table != 0

        def score(texts: list[bytes | None]) -> np.ndarray:
            z = np.array([table[different(t, among)].sum(dtype=np.float64) for t in texts]) + self.start
            return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -40, 40)))

        return score


def _constant(share: float) -> Model:
    odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), float(odds))


def _descend(slope, start: list[np.ndarray], steps: int, rate: float) -> list[np.ndarray]:
    """Gradient steps of a size that follows each number's own slopes."""
    now, first, second = [np.array(s, dtype=float) for s in start], [0.0] * len(start), [0.0] * len(start)
    for step in range(1, steps + 1):
        for i, g in enumerate(slope(*now)):
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.99 * second[i] + 0.01 * g * g
            now[i] = now[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return now


def train(row: np.ndarray, feature: np.ndarray, worth: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and start of a logistic model; document ``row[i]`` has ``feature[i]``."""
    value, n = worth[feature], len(y)
    share = np.where(y >= 0.5, RARE, 1.0)
    share = share / share.sum()

    def slope(w, b):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[feature] * value, n) + b, -40, 40)))
        error = share * (p - y)
        return np.bincount(feature, error[row] * value, len(worth)) + DECAY * w, error.sum()

    w, b = _descend(slope, [np.zeros(len(worth)), np.zeros(())], STEPS, RATE)
    return w * worth, float(b)


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift under which sums of rows never trained on are probabilities."""
    if len(y) < 20 or y.min() == y.max():
        return 1.0, 0.0

    def slope(a, c):
        error = 1 / (1 + np.exp(-np.clip(a * z + c, -40, 40))) - y
        return (error * z).mean() + 1e-3 * (a - 1), error.mean()

    a, c = _descend(slope, [np.ones(()), np.zeros(())], 400, 0.05)
    return (float(a), float(c)) if a > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = learned(docs, labels, sample)
    sizes = {r["toxic"]: r["n"] for r in rows.where("NOT aside").groupBy((F.col("toxic") >= 0.5).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not other:
        return _constant(rows.agg(F.coalesce(F.avg("toxic"), F.lit(0.5))).first()[0])
    features, ratio = ratios(counts(rows.where("NOT aside")), toxic, other)

    def run(batches):
        among, place = np.zeros(1 << BITS, dtype=bool), np.zeros(1 << BITS, dtype=np.int32)
        among[features], place[features] = True, np.arange(len(features), dtype=np.int32)
        for batch in batches:
            held = [place[different(t.as_py(), among)].tobytes() for t in batch.column("text").cast(pa.binary())]
            ids = batch.column("doc_id").cast(pa.string())
            yield pa.RecordBatch.from_arrays([ids, batch.column("toxic"), batch.column("aside"), pa.array(held, pa.binary())], ["doc_id", "toxic", "aside", "features"])

    # At most ``sample`` rows come to the driver.
    table = rows.mapInArrow(run, "doc_id string, toxic double, aside boolean, features binary").toArrow().sort_by("doc_id")
    y, aside = table.column("toxic").to_numpy(), table.column("aside").to_numpy()
    own = [np.frombuffer(b.as_buffer(), np.int32) for b in table.column("features")]

    def flat(rows_of):
        chosen = [own[i] for i in rows_of]
        return np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]), np.concatenate(chosen)

    early, late = np.nonzero(~aside)[0], np.nonzero(aside)[0]
    weights, start = train(*flat(early), ratio * UNIT, y[early])
    z = np.array([weights[own[i]].sum() for i in late]) + start
    used = weights != 0
    return Model(features[used], weights[used].astype(np.float32), start, *calibrate(z, y[late]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row."""

    def run(batches):
        score = model.scorer()
        for batch in batches:
            found = score([t.as_py() for t in batch.column("text").cast(pa.binary())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    held = docs.select("doc_id", "text")
    return held.mapInArrow(run, held.select("doc_id", F.lit(0.0).alias("score")).schema)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Every document's score and the class it is given."""
    return scored(docs, fit(docs, labels, sample)).select(
        "doc_id", F.coalesce(held_out(column("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
