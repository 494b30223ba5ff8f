"""Near-duplicate documents by SimHash over a byte-position index.

A fingerprint has 8 positional bytes. Two fingerprints that differ in at most 2 bits
differ in at most 2 bytes, so they share at least 6 positional bytes: that is the
guaranteed minimum of the count filter. A posting list of the inverted index belongs to
4 positions and their bytes (the 6 ways to take two of the four byte pairs); every pair
that shares 6 bytes stands in at least one list. Inside a list the shared positional
bytes of each pair are tallied, pairs below 6 fall out, and the rest are verified by
their differing bits. Lists that are too long for that are split into lists of 6
positions, which can't hold more than 65,536 different fingerprints; there the
neighbours of a fingerprint are looked up instead of compared.

The index holds each fingerprint once, however many documents have it. A list gives a
spanning forest of its links and never its pairs, so output is linear.

Defined results: a null text counts as empty; a text without words has fingerprint 0,
which is linked like any other. Rows that repeat are members like all others. A null
doc_id never is a component's id unless all its documents have none. An empty table
gives an empty one. Other columns are kept by ``dedup`` whatever their names.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, rows_with, settle, unboxed
from .components import components

WORDS = 3
MAX_BITS = 2
SEED = 42
#: Lists up to this length are tallied pair by pair, longer ones are split.
LIST_ROWS = 512
#: Shingles hashed and counted at a time, so a very long text needs little memory.
BLOCK = 200_000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LANES = np.uint64(0x0101010101010101)


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, lowest first."""
    sums = np.zeros((8, 8), dtype=np.int64)
    cuts = np.arange(0, len(hashes), 255)  # a lane of 8 bits holds up to 255 ones
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, cuts)
        sums[:, shift] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sums.reshape(64)


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """SimHash of a text's word shingles as an unsigned number."""
    parts = (text or b"").translate(_LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(parts) > words:
        starts, ends = starts[: len(parts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    sums = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), BLOCK):
        cut = map(joined.__getitem__, map(slice, starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist()))
        n = min(BLOCK, len(starts) - at)
        sums += _bit_sums(np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), np.uint64, n))
    return int(np.packbits(sums * 2 > len(starts), bitorder="little").view("<u8")[0])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64), pa.int64())


def with_fingerprints(df: DataFrame, words: int = WORDS) -> DataFrame:
    """``df``'s columns but ``text``, and ``fp``, the text's fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = _signed([fingerprint(t.as_py(), words) for t in texts])
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), fps], [*kept, "fp"])

    return df.mapInArrow(run, df.drop("text").withColumn("fp", F.lit(0).cast("long")).schema)


def _position_masks(bytes_kept: int) -> list[int]:
    """Signed masks of the byte positions of a posting list."""
    from itertools import combinations

    if bytes_kept == 4:
        chosen = [(2 * i, 2 * i + 1, 2 * j, 2 * j + 1) for i, j in combinations(range(4), 2)]
    else:
        chosen = list(combinations(range(8), bytes_kept))
    masks = [sum(0xFF << 8 * p for p in positions) for positions in chosen]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _postings(fps: DataFrame, bytes_kept: int) -> DataFrame:
    lists = [
        F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("held"))
        for k, m in enumerate(_position_masks(bytes_kept))
    ]
    return fps.select("fp", F.explode(F.array(*lists)).alias("at")).select("at.k", "at.held", "fp")


def _spanned(linked: np.ndarray) -> np.ndarray:
    """For each node of a link matrix, the first node of its component."""
    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(linked)).min(axis=1)
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tally(fps: np.ndarray, shared: int, max_bits: int) -> np.ndarray:
    """Roots of a short list: tally shared positional bytes, filter, verify the bits."""
    parts = fps.view(np.uint8).reshape(-1, 8)
    matches = np.zeros((len(fps), len(fps)), dtype=np.uint8)
    for p in range(8):
        matches += parts[:, None, p] == parts[None, :, p]
    linked = matches >= shared
    a, b = np.nonzero(linked)
    linked[a, b] = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    return _spanned(linked)


def look_up(fps: np.ndarray, positions: list[int], max_bits: int) -> np.ndarray:
    """Roots of a list whose fingerprints differ only in two byte positions."""
    parts = fps.view(np.uint8).reshape(-1, 8).astype(np.int64)
    rest = parts[:, positions[0]] * 256 + parts[:, positions[1]]
    steps = np.array([m for m in range(1, 1 << 16) if m.bit_count() <= max_bits])
    at = np.full(1 << 16, len(fps))
    at[rest] = np.arange(len(fps))
    root = np.append(np.arange(len(fps)), len(fps))
    while True:
        new = root.copy()
        for m in steps:
            np.minimum(new[:-1], root[at[rest ^ m]], out=new[:-1])
        new[:-1] = new[new[:-1]]
        if (new == root).all():
            return root[:-1]
        root = new


def _linked(lists: DataFrame, roots) -> DataFrame:
    """Forest edges ``(a, b)`` of lists ``(k, fps)``; ``roots(k, fps)`` finds each root."""

    def run(batches):
        for batch in batches:
            for k, values in zip(batch.column("k").to_pylist(), batch.column("fps")):
                fps = np.sort(values.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                root = roots(k, fps)
                far = np.nonzero(root != np.arange(len(fps)))[0]
                if len(far):
                    ends = [pa.array(x.view(np.int64), pa.int64()) for x in (fps[far], fps[root[far]])]
                    yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return lists.select("k", "fps").mapInArrow(run, "a long, b long")


def links(fps: DataFrame, max_bits: int = MAX_BITS, list_rows: int = LIST_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints ``fp`` (distinct) within ``max_bits``.

    Exact for up to two differing bits, the number the six shared bytes guarantee.
    """
    from itertools import combinations

    if not 0 <= max_bits <= 2:
        raise ValueError("six shared positional bytes are guaranteed for up to two differing bits")
    postings = _postings(fps, 4)
    lengths = postings.groupBy("k", "held").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    shared = settle(postings.join(lengths, ["k", "held"]), "postings")
    gather = F.collect_list("fp").alias("fps")
    short = shared.where(F.col("length") <= list_rows).groupBy("k", "held").agg(gather)
    long = shared.where(F.col("length") > list_rows).select("fp").distinct()
    split = _postings(long, 6).groupBy("k", "held").agg(gather).where(F.size("fps") > 1)
    free = [[p for p in range(8) if p not in held] for held in combinations(range(8), 6)]
    near = _linked(short, lambda k, x: tally(x, 8 - max_bits, max_bits))
    return near.union(_linked(split, lambda k, x: look_up(x, free[k], max_bits))).distinct()


def classes(prints: DataFrame) -> DataFrame:
    """``(fp, root)`` of every fingerprint in ``prints``, the root being one of its class."""
    fps = settle(prints.select("fp").distinct(), "fingerprints")
    found = components(links(fps)).withColumnRenamed("node", "fp")
    return fps.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def _class_table(prints: DataFrame, best) -> DataFrame:
    """``(fp, best)``: of the class of each fingerprint, the least ``best``; written once."""
    least = prints.groupBy("fp").agg(F.min(best).alias("best"))
    rooted = settle(classes(prints).join(least, "fp"), "classes")
    of_root = rooted.groupBy("root").agg(F.min("best").alias("best"))
    return settle(rooted.select("fp", "root").join(of_root, "root").select("fp", "best"), "class-table")


def assign(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document its id, fingerprint (16 hex digits) and component's smallest id."""
    prints = settle(with_fingerprints(docs.select("doc_id", "text"), words), "prints")
    table = _class_table(prints, F.col("doc_id")).withColumnRenamed("best", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(table, "fp").select("doc_id", digits, "component_id")


def dedup(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents, one of each class: that with the smallest id (nulls last).

    Of different rows with the smallest id one stays, told by a hash; text is shuffled once.
    """
    rows = keyed(docs)
    prints = settle(with_fingerprints(rows.select("ka", "kb", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")), words), "prints")
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ka", "kb")
    kept = _class_table(prints, best).select("best.ka", "best.kb").distinct()
    counts = prints.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("n"))
    return unboxed(rows_with(rows, settle(kept.join(counts, ["ka", "kb"]), "kept")))
