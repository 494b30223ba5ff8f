"""Document quality by random-indexing word vectors and a small network.

Random indexing: every word has a fixed sparse ternary index vector, and a word's vector
is the sum of the index vectors of the words around it, over all occurrences in all
documents. Words are hashed to a fixed number of rows, so the vectors are a table of a
fixed size whatever the vocabulary; each task adds up its own table in whole numbers and
Spark sums them, so the vectors don't depend on the order of anything. A document is
pooled from its words' vectors: their mean, the mean product of neighbours, and how many
there are. A network of two layers, trained in numpy, scores that mean,
and a temperature fitted on rows kept out of its training calibrates the probability.

Only labels are sampled: at most ``SAMPLE`` labelled documents, those with the smallest
hash of their id, train the network. Word vectors come from all documents, and every
document is scored by its whole text. Labels, language, source and id are no inputs.

Defined results: a null text counts as empty, and an empty text has the zero vector,
which the network scores like any other. Labels that are null are left out, those of one
id are averaged, and of rows that repeat a labelled id one trains. Without labels, or with one class only, the score is the share of 1
(0.5 without labels). An empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, column, unboxed

#: Rows and columns of the word vectors, words looked at on either side, ones of an index vector.
ROWS = 8192
DIM = 32
WINDOW = 2
ONES = 4
SEED = 2
#: Most labelled documents used for training; the only sample.
SAMPLE = 20_000
HIDDEN = 24
EPOCHS = 30
DECAY = 2e-3
THRESHOLD = 0.3
#: Words counted at a time, so a very long text needs little memory.
BLOCK = 200_000


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def word_rows(text: bytes | None) -> np.ndarray:
    words = (text or b"").split()
    return np.fromiter(map(crc32, words), np.int64, len(words)) % ROWS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the ones of each row's index vector."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((ROWS, DIM)), axis=1)[:, :ONES]
    return places, rng.choice([-1.0, 1.0], size=(ROWS, ONES))


def _blocks_of_words(batches):
    """Word rows of many texts at a time, a number for each text, and which words count.

    A text longer than a block is cut; the words after a cut stand at the end of the
    block before it once more, uncounted, as neighbours of its last words.
    """
    held, size, number = [], 0, 0

    def joined():
        counts = np.concatenate([np.arange(len(r)) < BLOCK for r, _ in held])
        return np.concatenate([r for r, _ in held]), np.repeat([n for _, n in held], [len(r) for r, _ in held]), counts

    for batch in batches:
        for text in batch.column("text").cast(pa.binary()):
            rows = word_rows(text.as_py())
            for at in range(0, len(rows), BLOCK):
                held.append((rows[at:at + BLOCK + WINDOW], number := number + 1))
                size += len(held[-1][0])
                if size >= BLOCK:
                    yield joined()
                    held, size = [], 0
    if held:
        yield joined()


def context_sums(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the index vectors around each row's words, and how often the row occurs.

    The sums come to the driver: a table of ``ROWS`` by ``DIM`` at any corpus size.
    """
    names = [f"c{i}" for i in range(DIM)]

    def run(batches):
        places, signs = index_vectors()
        sums, seen = np.zeros(ROWS * DIM), np.zeros(ROWS, dtype=np.int64)
        for rows, doc, counts in _blocks_of_words(batches):
            for step in range(1, WINDOW + 1):
                near = np.nonzero((doc[:-step] == doc[step:]) & counts[:-step])[0]
                left, right = rows[near], rows[near + step]
                for one in range(ONES):
                    sums += np.bincount(left * DIM + places[right, one], signs[right, one], ROWS * DIM)
                    sums += np.bincount(right * DIM + places[left, one], signs[left, one], ROWS * DIM)
            seen += np.bincount(rows[counts], minlength=ROWS)
        if seen.any():
            table = sums.reshape(ROWS, DIM).astype(np.int64)
            own = np.nonzero(seen)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(seen[own]), *(pa.array(table[own, i]) for i in range(DIM))], ["row", "seen", *names]
            )

    parts = docs.select("text").mapInArrow(run, ", ".join(f"{c} long" for c in ["row", "seen", *names]))
    sums, seen = np.zeros((ROWS, DIM)), np.zeros(ROWS)
    for r in parts.groupBy("row").agg(F.sum("seen").alias("seen"), *[F.sum(c).alias(c) for c in names]).collect():
        sums[r["row"]], seen[r["row"]] = [r[c] for c in names], r["seen"]
    return sums, seen


def word_vectors(sums: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Unit vectors of what each row's surroundings have beyond the usual."""
    usual = sums.sum(axis=0) / max(seen.sum(), 1)
    own = sums - seen[:, None] * usual
    return (own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pooled(text: bytes | None, vectors: np.ndarray) -> np.ndarray:
    """Mean vector, mean product and cosine of vectors that follow each other, log length.

    Those of neighbours tell texts that say one word again and again from those that don't.
    """
    rows, dim = word_rows(text), vectors.shape[1]
    out = np.zeros(2 * dim + 2)
    for at in range(0, len(rows), BLOCK):
        part = vectors[rows[at:at + BLOCK + 1]]
        out[:dim] += part[:BLOCK].sum(axis=0, dtype=np.float64)
        out[dim:-2] += (part[:-1] * part[1:]).sum(axis=0, dtype=np.float64)
    out[:dim] /= max(len(rows), 1)
    out[dim:-2] /= max(len(rows) - 1, 1)
    out[-2], out[-1] = out[dim:-2].sum(), np.log1p(len(rows))
    return out


@dataclass
class Network:
    """Two layers over standardized inputs; a temperature divides the last."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _constant(dim: int, share: float) -> Network:
    odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    zero = np.zeros((dim, 1))
    return Network(np.zeros(dim), np.ones(dim), zero, np.zeros(1), np.zeros(1), float(odds))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit the network on four fifths of the rows and the temperature on the fifth."""
    if len(y) < 10 or y.min() == y.max():
        return _constant(x.shape[1], float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    late, order = order[: len(y) // 5], order[len(y) // 5:]
    mean, scale = x[order].mean(axis=0), x[order].std(axis=0) + 1e-9
    net = Network(mean, scale, rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    names = ("w1", "b1", "w2", "b2")
    first, second, step = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(order)
        for at in range(0, len(order), 128):
            own = order[at:at + 128]
            inputs = (x[own] - mean) / scale
            hidden = np.tanh(inputs @ net.w1 + net.b1)
            error = (1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -40, 40))) - y[own]) / len(own)
            back = np.outer(error, net.w2) * (1 - hidden**2)
            slopes = {
                "w1": inputs.T @ back + DECAY * net.w1, "b1": back.sum(axis=0),
                "w2": hidden.T @ error + DECAY * net.w2, "b2": error.sum(),
            }
            step += 1
            for k, g in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                change = 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, getattr(net, k) - change)
    z = net.logits(x[late])
    heats = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
    net.temperature = float(heats[int(np.argmin([_loss(z / t, y[late]) for t in heats]))])
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return self.network.scores(np.stack([pooled(t, self.vectors) for t in texts]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Word vectors of all documents; the network from the bounded sample of labels."""
    vectors = word_vectors(*context_sums(docs))
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = known.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches):
        for batch in batches:
            means = [pooled(t.as_py(), vectors) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.string()), batch.column("quality"), pa.array(means, pa.list_(pa.float64()))],
                ["doc_id", "quality", "mean"],
            )

    # At most ``sample`` ids are sent out, and as many vectors of DIM numbers come back: of
    # rows that repeat an id one is taken, told by a hash and reduced before any shuffle.
    every = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    one = every.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("told"), "text")).alias("first"))
    held = one.select("doc_id", "quality", F.col("first.text").alias("text"))
    rows = sorted(held.mapInArrow(run, "doc_id string, quality double, mean array<double>").collect(), key=lambda r: (r["doc_id"], r["mean"]))
    x = np.array([r["mean"] for r in rows]).reshape(len(rows), 2 * DIM + 2)
    return Model(vectors, train(x, np.array([r["quality"] for r in rows], dtype=float)))


def scored(df: DataFrame, model: Model, text) -> DataFrame:
    """``df``'s columns and ``score``; ``text`` is the path of the text's column."""

    def run(batches):
        for batch in batches:
            values = batch.column(text[0])
            for name in text[1:]:
                values = values.field(name)
            found = model.score([t.as_py() for t in values.cast(pa.binary())])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    return df.mapInArrow(run, df.withColumn("score", F.lit(0.0)).schema)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every document's score and the class it is given."""
    found = scored(docs.select("doc_id", "text"), fit(docs, labels), ["text"])
    return found.select(
        "doc_id", F.coalesce(held_out(column("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    return unboxed(scored(boxed(docs), fit(docs, labels), ["row", "text"]).where(F.col("score") >= threshold))
