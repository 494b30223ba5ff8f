"""Near-duplicate documents by SimHash: positional bytes, counted and then verified exactly.

A text has ``BANDS`` SimHash fingerprints of 64 bits, each the bitwise majority of the
hashes of ``DRAWN`` of its five-word shingles. The shingles of a fingerprint are drawn by
minimum hashes over all of the text's shingles, so two texts draw the same shingle with a
chance of their similarity, and what differs between them leaves most of the bits alone.
One fingerprint over all shingles would differ in 15 % of its bits at the threshold; a
byte of it would be shared with a chance of 0.27, and no few lists would hold all pairs.

A fingerprint has ``BAND`` = 8 positional bytes. A posting list of the inverted index holds
the texts that share a fingerprint's bytes. Inside a list the shared positional bytes of
each pair are tallied over all fingerprints, pairs below ``LEAST`` or with more than
``MOST_BITS`` differing bits fall out, and the rest are verified by exact Jaccard
similarity, shingle by shingle. A pair at the threshold of 0.8 stands in no list with a
chance of at most (1 - 0.8 ** 5) ** 32 = 3e-6, falls below the count with one of 2e-6 and
has too many differing bits with one of 4e-5; that is all that can be missed.

First each list's texts meet its smallest one, which joins large groups of copies at the
cost of one pair a text. Then only pairs of different components are tallied, each pair in
the first list that holds it. Texts of a list's largest component don't meet one another,
and a long list is cut into blocks that meet two by two in tasks of their own. A text
hands on its best ``EACH`` partners; where it has more, another round follows that hands
on four times as many, so rounds grow with the logarithm of what there is to verify.

Texts that are equal but for case and white space are one unit from the start.

Defined results: a null text counts as empty, and texts without words are one class. A
text of fewer words than a shingle is one shingle. Classes are connected components.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard
from .common import keyed, rows_with, settle, unboxed
from .components import components

WORDS = 5
#: The threshold of similarity as a fraction of whole numbers.
SIMILAR = (4, 5)
#: Fingerprints of a text, the positional bytes of each, and the shingles it is the majority of.
BANDS = 32
BAND = 8
DRAWN = 5
#: Least shared positional bytes of a pair that is verified.
LEAST = 32
#: Most differing bits of such a pair.
MOST_BITS = 500
#: Partners a text hands on from each of its lists in the first round.
EACH = 1
#: Texts of a block; lists up to SHORT texts are tallied many in a group.
SPLIT = 512
SHORT = 64
GROUP_ROWS = 4096
SEED = 43
#: Shingles hashed at a time and hashed anew at a time.
BLOCK = 200_000
STEP = 1024
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_RNG = np.random.default_rng(SEED)
_TIMES = _RNG.integers(0, 1 << 31, (BANDS * DRAWN, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, (BANDS * DRAWN, 1), dtype=np.uint32)


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LOWER).split()


def _hashes(parts: list[bytes], joined: bytes):
    """Hashes of the shingles of a text's words, so many at a time."""
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(parts) > WORDS:
        starts, ends = starts[: len(parts) - WORDS + 1], ends[WORDS - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    for at in range(0, len(starts), BLOCK):
        cut = map(joined.__getitem__, map(slice, starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist()))
        yield np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), np.uint64, min(BLOCK, len(starts) - at))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits that depend on all bits of each number."""
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return x ^ (x >> np.uint64(31))


def signature(parts: list[bytes], joined: bytes) -> bytes:
    """The positional bytes of a text's fingerprints, one fingerprint after the other."""
    least = np.full(BANDS * DRAWN, 0xFFFFFFFF, dtype=np.uint32)
    room = np.empty((BANDS * DRAWN, STEP), dtype=np.uint32)
    for hashes in _hashes(parts, joined):
        folded = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
        for at in range(0, len(folded), STEP):
            x = folded[at:at + STEP]
            held = room[:, : len(x)]
            np.multiply(_TIMES, x, out=held)
            np.add(held, _PLUS, out=held)
            np.minimum(least, held.min(axis=1), out=least)
    # A draw's least value names its shingle; its hash is another for each draw.
    drawn = _mixed(least + (np.arange(BANDS * DRAWN, dtype=np.uint64) << np.uint64(32)))
    bits = np.unpackbits(drawn.view(np.uint8).reshape(BANDS, DRAWN, BAND), axis=2)
    return np.packbits(bits.sum(axis=1) * 2 > DRAWN, axis=1).tobytes()


def shingle_set(text: bytes | None) -> np.ndarray:
    parts = _words(text)
    if not parts:
        return np.zeros(0, np.int64)
    return np.unique(np.concatenate(list(_hashes(parts, b" ".join(parts))))).view(np.int64)


def with_signatures(df: DataFrame) -> DataFrame:
    """``df``'s columns but ``text``, 128 bits ``ha``, ``hb`` of its words, and ``sig`` (null without words)."""

    def run(batches):
        for batch in batches:
            ha, hb, sigs = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                parts = _words(text.as_py())
                joined = b" ".join(parts)
                both = np.frombuffer(xxhash.xxh128_digest(joined), np.int64)
                ha.append(int(both[0])), hb.append(int(both[1]))
                sigs.append(signature(parts, joined) if parts else None)
            kept = [c for c in batch.schema.names if c != "text"]
            more = [pa.array(ha, pa.int64()), pa.array(hb, pa.int64()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *more], [*kept, "ha", "hb", "sig"])

    long = F.lit(0).cast("long")
    return df.mapInArrow(run, df.drop("text").select("*", long.alias("ha"), long.alias("hb"), F.lit(None).cast("binary").alias("sig")).schema)


def _sets(texts: DataFrame) -> DataFrame:
    """``(u, shingles)`` of ``(u, text)``."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [shingle_set(t.as_py()) for t in part.column("text").cast(pa.binary())]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column("u"), lists], ["u", "shingles"])

    return texts.mapInArrow(run, "u long, shingles array<long>")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs (a, b)`` whose shingle sets reach the threshold."""
    one, two = (sets.select(F.col("u").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    shared = F.size(F.array_intersect("sa", "sb"))
    least, whole = SIMILAR
    # Sizes alone rule out some pairs before their shingles are looked at.
    able = F.least(F.size("sa"), F.size("sb")) * whole >= F.greatest(F.size("sa"), F.size("sb")) * least
    met = pairs.join(one, "a").join(two, "b").where(able).select("a", "b", shared.alias("n"), (F.size("sa") + F.size("sb")).alias("sum"))
    return met.where((F.col("n") * whole) >= (F.col("sum") - F.col("n")) * least).select("a", "b")


def near_enough(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row of ``a`` shares enough positional bytes and bits with that of ``b``, and how many bytes."""
    shared = (a == b).sum(axis=1)
    far = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)).sum(axis=1, dtype=np.int64)
    return (shared >= LEAST) & (far <= MOST_BITS), shared


def counted(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Those of ``pairs (a, b)`` that share enough positional bytes and bits."""
    one, two = (units.select(F.col("u").alias(c), F.col("sig").alias(f"s{c}")) for c in "ab")

    def run(batches):
        for batch in batches:
            sigs = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BANDS * BAND) for c in ("sa", "sb")]
            if batch.num_rows:
                yield batch.select(["a", "b"]).filter(pa.array(near_enough(*sigs)[0]))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def pairs_of(starts: np.ndarray, mine: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows that stand in one list, or in its two blocks; lists begin at ``starts``."""
    sizes = np.diff(np.append(starts, len(mine)))
    end = np.repeat(starts + sizes, sizes)
    one = i == j
    left = np.nonzero(one)[0]
    count = end[left] - left - 1
    first = np.repeat(left, count)
    second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
    out = [(first, second)]
    for s, n in zip(starts, sizes):
        if not one[s]:
            own = np.arange(s, s + n)
            x, y = own[mine[s:s + n] == i[s]], own[mine[s:s + n] == j[s]]
            out.append((np.repeat(x, len(y)), np.tile(y, len(x))))
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def tally(k: np.ndarray, sigs: np.ndarray, roots: np.ndarray, rest: np.ndarray, x: np.ndarray, y: np.ndarray, each: int):
    """Those of the pairs ``(x, y)`` of rows to verify, and whether some row has more of them.

    A pair counts if it differs in its component, has one text outside the list's largest
    component, shares no band before its list's ``k`` and enough positional bytes and bits.
    """
    fits = (roots[x] != roots[y]) & (rest[x] | rest[y])
    x, y = x[fits], y[fits]
    bands = np.ascontiguousarray(sigs).view(np.uint64)
    kept, shared = [], []
    for at in range(0, len(x), 32_768):
        a, b = x[at:at + 32_768], y[at:at + 32_768]
        earlier = ((bands[a] == bands[b]) & (np.arange(BANDS)[None, :] < k[a][:, None])).any(axis=1)
        fits, n = near_enough(sigs[a], sigs[b])
        held = ~earlier & fits
        kept.append(held), shared.append(n[held])
    held = np.concatenate(kept) if kept else np.zeros(0, dtype=bool)
    x, y, shared = x[held], y[held], np.concatenate(shared) if shared else np.zeros(0, int)
    more, best = False, np.zeros(len(x), dtype=bool)
    for ends in (x, y):
        order = np.lexsort((-shared, ends))
        place = np.arange(len(order)) - np.searchsorted(ends[order], ends[order])
        more |= bool((place >= each).any())
        best[order[place < each]] = True
    return x[best], y[best], more


def proposed(rows: DataFrame, each: int) -> DataFrame:
    """``(a, b, more)`` of ``rows (k, held, u, root, sig, main, n_main, n_rest)`` of open lists."""
    rest = F.col("root") != F.col("main")
    blocks = [F.greatest(F.lit(1), F.ceil(F.col(c) / SPLIT)).cast("int") for c in ("n_main", "n_rest")]
    short = F.col("n_main") + F.col("n_rest") <= SHORT
    # Blocks of the largest component are numbered -1, -2, ...; the others from 0.
    mine = F.when(short, 0).when(rest, F.pmod(F.xxhash64("u"), blocks[1])).otherwise(-1 - F.pmod(F.xxhash64("u"), blocks[0])).cast("int")
    others = F.when(short, F.array(F.lit(0))).when(rest, F.concat(F.sequence(-blocks[0], F.lit(-1)), F.sequence(F.lit(0), blocks[1] - 1))).otherwise(F.sequence(F.lit(0), blocks[1] - 1))
    met = F.transform("others", lambda o: F.struct(F.least("mine", o).alias("i"), F.greatest("mine", o).alias("j")))
    named = rows.select("k", "held", "u", "root", "sig", rest.alias("rest"), short.alias("short"), mine.alias("mine"), others.alias("others"))
    dealt = named.select("k", "held", "u", "root", "sig", "rest", "short", "mine", F.explode(met).alias("pair"))
    groups = max(1, -(-rows.count() // GROUP_ROWS))
    group = F.when(F.col("short"), F.pmod(F.xxhash64("k", "held"), F.lit(groups))).otherwise(-1 - F.abs(F.xxhash64("k", "held", "pair") % (1 << 40)))
    dealt = dealt.select("k", "held", "u", "root", "sig", "rest", "mine", "pair.i", "pair.j", group.alias("g"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("k", "ascending"), ("held", "ascending"), ("i", "ascending"), ("j", "ascending"), ("u", "ascending")])
        k, u, root, mine, i, j = (table.column(c).to_numpy() for c in ("k", "u", "root", "mine", "i", "j"))
        rest = table.column("rest").to_numpy(zero_copy_only=False)
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(len(u), -1)
        held = np.array(table.column("held").to_pylist(), dtype=object)
        new = np.ones(len(u), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (held[1:] != held[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        x, y = pairs_of(np.nonzero(new)[0], mine, i, j)
        x, y, more = tally(k, sigs, root, rest, x, y, each)
        return pa.table({"a": np.minimum(u[x], u[y]), "b": np.maximum(u[x], u[y]), "more": np.full(len(x), more)})

    return dealt.repartition(max(1, groups // 4), "g").groupBy("g").applyInArrow(run, "a long, b long, more boolean")


def classes(lists: DataFrame, units: DataFrame, sets: DataFrame, each: int = EACH) -> DataFrame:
    """``(node, root)`` of linked units ``(u, sig)``; ``lists (k, held, u)`` names the candidates."""
    pivots = lists.groupBy("k", "held").agg(F.min("u").alias("p"))
    star = lists.join(pivots, ["k", "held"]).where("u != p").select(F.col("p").alias("a"), F.col("u").alias("b")).distinct()
    tested = settle(counted(star, units), "pairs")
    links = settle(similar(tested, sets), "links")
    while True:
        roots = settle(components(links).withColumnRenamed("node", "u"), "roots")
        named = lists.join(roots, "u", "left").select("k", "held", "u", F.coalesce("root", "u").alias("root"))
        sizes = named.groupBy("k", "held", "root").agg(F.count(F.lit(1)).alias("n"))
        largest = F.max(F.struct("n", "root")).alias("main")
        open_ = sizes.groupBy("k", "held").agg(F.count(F.lit(1)).alias("roots"), F.sum("n").alias("all"), largest).where("roots > 1")
        open_ = open_.select("k", "held", F.col("main.root").alias("main"), F.col("main.n").alias("n_main"), (F.col("all") - F.col("main.n")).alias("n_rest"))
        rows = settle(named.join(open_, ["k", "held"]).join(units.select("u", "sig"), "u"), "open-lists")
        found = settle(proposed(rows, each), "proposed")
        pairs = settle(found.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        new = settle(similar(pairs, sets), "links")
        more = not found.where("more").isEmpty()
        discard(rows, found)
        if not more and new.isEmpty():
            return roots.withColumnRenamed("u", "node")
        tested, links, each = tested.union(pairs), links.union(new), each * 4
        if not more:
            return components(links)


def dedup(docs: DataFrame) -> DataFrame:
    """The documents, one of each class: that with the smallest id (nulls last).

    Of different rows with the smallest id one stays, told by a hash.
    """
    rows = keyed(docs)
    prints = settle(with_signatures(rows.select("ka", "kb", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))), "prints")
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ka", "kb")
    units = prints.groupBy("ha", "hb").agg(F.min(best).alias("best"), F.min("sig").alias("sig"))
    units = settle(units.select(F.monotonically_increasing_id().alias("u"), "best", "sig"), "units")
    counts = prints.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("n"))
    bands = F.array(*[F.struct(F.lit(k).alias("k"), F.substring("sig", k * BAND + 1, BAND).alias("held")) for k in range(BANDS)])
    postings = units.where("sig IS NOT NULL").select("u", F.explode(bands).alias("at")).select("at.k", "at.held", "u")
    lengths = postings.groupBy("k", "held").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    lists = settle(postings.join(lengths.drop("length"), ["k", "held"]), "lists")
    asked = units.join(lists.select("u").distinct(), "u", "left_semi").select("u", F.col("best.ka").alias("ka"), F.col("best.kb").alias("kb"))
    texts = rows.select(F.struct(F.col("row.text").alias("text")).alias("row"), "ka", "kb")
    sets = settle(_sets(rows_with(texts, settle(asked.join(counts, ["ka", "kb"]), "asked")).select("u", "row.text")), "shingles")
    rooted = units.join(classes(lists, units.where("sig IS NOT NULL"), sets).withColumnRenamed("node", "u"), "u", "left").select("best", F.coalesce("root", "u").alias("root"))
    kept = rooted.groupBy("root").agg(F.min("best").alias("best")).select("best.ka", "best.kb").distinct()
    return unboxed(rows_with(rows, settle(kept.join(counts, ["ka", "kb"]), "kept")))
