"""Prefix trie of conversations and sums over its subtrees by centroid decomposition.

Every distinct sequence of a conversation's first turns is a node. A node is told by 128
bits of its turns: a polynomial of the turns' hashes modulo a prime, which blocks of turns
give on their own and which put together by blocks, so a conversation of any length is
hashed by many tasks. Members, ends and depths of nodes are plain counts.

Sums over subtrees come from the forest of edges to the parent. A component (at first the
whole trie) is split at its centroid: the deepest node that more than half of the
component's members' turns pass. Its subtree's total within the component is added to all
nodes on the path from the centroid to the component's top; then the centroid goes, and
the subtrees of its children and what is left above are components of their own. Every
pair of a node and one below it is parted by one centroid, which stands on the path
between them, so each node gets each value below it once. Weights halve, so a chain of any
depth takes as many rounds as a bushy trie of its size. The centroid's path is known
without walking it: it is the path of any conversation that starts with it. Components of
at most ``LOCAL`` nodes are solved the same way inside a task.

Defined results: null roles and texts are empty. Turns that a conversation's order leaves
tied are ordered by role, then text, byte by byte; rows that repeat are turns of their
own. Rows without a conv_id belong to no conversation and are left out. A conversation
without turns is a member of the root. Without conversations there is no root and the
result is empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard
from .common import settle

#: Turns hashed at a time.
BLOCK = 512
#: Nodes of a component that one task solves.
LOCAL = 20_000
#: Bytes of ids hashed at a time.
PIECE = 1 << 16
_PRIME = (1 << 127) - 1
_BASE = int.from_bytes(hashlib.blake2b(b"turns", digest_size=15).digest(), "big")
ROOT = bytes(16)


def numbered(conversations: DataFrame) -> DataFrame:
    """``(conv_id, at, told, chars)``: each turn's place from 0, hash and code points.

    Turns are sorted by ranges, so that no task needs a whole conversation: a turn's place
    is its place in its range and the turns of the ranges before.
    """
    role, text = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    read = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", role, text)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranged = read.repartitionByRange(*order).sortWithinPartitions(*order)
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    told = F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("told")
    seen = settle(ranged.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"), told, F.length("text").cast("long").alias("chars")), "turns")
    spans = seen.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("here"))
    before = F.sum("here").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("here")
    met = seen.join(spans.select("conv_id", "part", "first", before.alias("before")), ["conv_id", "part"])
    return met.select("conv_id", (F.col("before") + F.col("seq") - F.col("first")).alias("at"), "told", "chars")


def _values(blocks: DataFrame) -> DataFrame:
    """``(conv_id, block, n, value)``: the polynomial of each block's turns."""

    def run(batches):
        for batch in batches:
            found, sizes = [], []
            for items in batch.column("items"):
                h = 0
                for t in items.values.field("told").to_pylist():
                    h = (h * _BASE + int.from_bytes(t, "big") + 1) % _PRIME
                found.append(h.to_bytes(16, "big")), sizes.append(len(items))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                                             ["conv_id", "block", "n", "value"])

    return blocks.select("conv_id", "block", "items").mapInArrow(run, "conv_id long, block long, n long, value binary")


def _starts(values: DataFrame) -> DataFrame:
    """``(conv_id, block, start)``: the polynomial of all blocks before, of conversations of several."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("block")
        h, starts = 0, []
        for n, value in zip(group.column("n").to_pylist(), group.column("value").to_pylist()):
            starts.append(h.to_bytes(16, "big"))
            h = (h * pow(_BASE, n, _PRIME) + int.from_bytes(value, "big")) % _PRIME
        return pa.table({"conv_id": group.column("conv_id"), "block": group.column("block"), "start": pa.array(starts, pa.binary())})

    several = values.where("block > 0").select("conv_id").distinct()
    return values.join(several, "conv_id", "left_semi").groupBy("conv_id").applyInArrow(run, "conv_id long, block long, start binary")


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, depth, key, up, chars, rest)`` of every prefix with a turn.

    ``key`` and ``up`` tell the node and its parent, ``rest`` counts the prefixes from this
    one to the conversation's last.
    """
    dealt = turns.groupBy("conv_id", F.floor(F.col("at") / block).alias("block"))
    blocks = settle(dealt.agg(F.array_sort(F.collect_list(F.struct("at", "told", "chars"))).alias("items")), "blocks")
    values = settle(_values(blocks), "values")
    lengths = values.groupBy("conv_id").agg(F.sum("n").alias("turns"))
    rows = blocks.join(lengths, "conv_id").join(_starts(values), ["conv_id", "block"], "left")

    def run(batches):
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "block", "turns", "start")]
            for conv, number, length, start, items in zip(*columns, batch.column("items")):
                up, depth = start or ROOT, number * block
                h = int.from_bytes(up, "big")
                for t, chars in zip(items.values.field("told").to_pylist(), items.values.field("chars").to_pylist()):
                    h = (h * _BASE + int.from_bytes(t, "big") + 1) % _PRIME
                    key, depth = h.to_bytes(16, "big"), depth + 1
                    out.append((conv, depth, key, up, chars, length - depth + 1))
                    up = key
            if out:
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["conv_id", "depth", "key", "up", "chars", "rest"])

    schema = "conv_id long, depth long, key binary, up binary, chars long, rest long"
    return rows.select("conv_id", "block", "turns", "start", "items").mapInArrow(run, schema)


def ends_hash(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of the ids ``(key, conv_id)`` in order, joined by commas.

    Ids are sorted by ranges and written as pieces of text; one hash reads its pieces one
    after the other and keeps none.
    """

    def pieces(batches):
        key, held, seq, size = None, [], 0, 0
        for batch in batches:
            out = []
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if held and (k != key or size > PIECE):
                    out.append((key, seq, ",".join(held)))
                    held, size, seq = [], 0, seq + 1
                key, text = k, str(c)
                held.append(text)
                size += len(text) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], ["key", "seq", "ids"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((key, seq, ",".join(held)), (pa.binary(), pa.int64(), pa.string()))], ["key", "seq", "ids"])

    def hashes(batches):
        key, hasher = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if hasher:
                        out.append((key, hasher.hexdigest()))
                    key, hasher = k, hashlib.sha256(ids.encode())
                else:
                    hasher.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], ["key", "ends_sha256"])
        if hasher:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([hasher.hexdigest()])], ["key", "ends_sha256"])

    ranged = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    written = settle(ranged.mapInArrow(pieces, "key binary, seq long, ids string").withColumn("part", F.spark_partition_id()), "ids")
    return written.repartition("key").sortWithinPartitions("key", "part", "seq").select("key", "ids").mapInArrow(hashes, "key binary, ends_sha256 string")


def rollup(parents: list[int], values: list[tuple[int, int]]) -> list[list[int]]:
    """Subtree sums of a forest whose nodes come after their parents (-1: none)."""
    n = len(parents)
    out, size, piece_of = [[0, 0] for _ in range(n)], [0] * n, [0] * n
    tops: dict[int, list[int]] = {}
    root = [0] * n
    for v, p in enumerate(parents):
        root[v] = v if p < 0 else root[p]
        tops.setdefault(root[v], []).append(v)
    todo, number = list(tops.values()), 0
    while todo:
        piece, number = todo.pop(), number + 1
        for v in piece:
            size[v], piece_of[v] = 1, number
        for v in reversed(piece[1:]):
            size[parents[v]] += size[v]
        centroid = next(v for v in reversed(piece) if 2 * size[v] > len(piece))
        above, below, at = [], {}, {centroid: centroid}
        first, second = values[centroid]
        for v in piece:
            p = parents[v]
            if v == centroid:
                continue
            if p in at and piece_of[p] == number:
                at[v] = v if p == centroid else at[p]
                below.setdefault(at[v], []).append(v)
                first, second = first + values[v][0], second + values[v][1]
            else:
                above.append(v)
        v, top = centroid, piece[0]
        while True:
            out[v][0] += first
            out[v][1] += second
            if v == top:
                break
            v = parents[v]
        todo += ([above] if above else []) + list(below.values())
    return out


def _solved(small: DataFrame, local: int) -> DataFrame:
    """Sums within components that fit a task; ``small`` has columns as ``sums``' state."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("depth")
        own = {c: group.column(c).to_pylist() for c in ("conv_id", "depth", "parent", "tc", "td", "leaf", "saved")}
        place = {(c, d): i for i, (c, d) in enumerate(zip(own["conv_id"], own["depth"]))}
        parents = [
            -1 if (c, d) == (tc, td) else place[p, d - 1]
            for c, d, p, tc, td in zip(own["conv_id"], own["depth"], own["parent"], own["tc"], own["td"])
        ]
        found = np.array(rollup(parents, list(zip(own["leaf"], own["saved"]))), dtype=np.int64).reshape(-1, 2)
        return pa.table({"conv_id": group.column("conv_id"), "depth": group.column("depth"), "leaf": found[:, 0], "saved": found[:, 1]})

    buckets = max(1, -(-small.count() // local))
    dealt = small.withColumn("bucket", F.pmod(F.xxhash64("tc", "td"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(run, "conv_id long, depth long, leaf long, saved long")


def sums(nodes: DataFrame, paths: DataFrame, local: int = LOCAL) -> DataFrame:
    """``(conv_id, depth, n_leaves, saved_tokens)`` over the subtree of every node.

    ``nodes (conv_id, depth, parent, w, leaf, saved)`` is one tree whose ``w`` is the weight
    of a node's subtree; ``paths (c, depth, node, up)`` names the nodes on the way of every
    conversation that names a node, by their own conversation, and the ones above them.
    """
    top = nodes.where("depth = 0").select(F.col("conv_id").alias("tc"), F.col("depth").alias("td"))
    state, parts, given = nodes.crossJoin(F.broadcast(top)), [], []  # one row: the root
    component = ["tc", "td"]
    while True:
        sizes = state.groupBy(*component).agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("total"))
        large = settle(sizes.where(F.col("n") > local).select(*component, "total"), "large")
        if large.isEmpty():
            parts.append(state)
            break
        parts.append(state.join(large, component, "left_anti"))
        split = state.join(large, component)
        deepest = F.max(F.struct(F.col("depth").alias("xd"), F.col("conv_id").alias("xc"), F.col("w").alias("xw"))).alias("x")
        cents = settle(split.where("2 * w > total").groupBy(*component).agg(deepest).select(*component, "x.*"), "centroids")
        at = paths.select(F.col("c").alias("conv_id"), (F.col("depth") - 1).alias("xd"), "node", "up")
        met = split.drop("total").join(cents, component).join(at, ["conv_id", "xd"], "left")
        under = (F.col("depth") > F.col("xd")) & (F.col("up") == F.col("xc"))
        is_x = (F.col("depth") == F.col("xd")) & (F.col("conv_id") == F.col("xc"))
        side = F.when(is_x, "x").when(F.coalesce(under, F.lit(False)), "under").otherwise("above")
        met = settle(met.withColumn("side", side), "sides")
        totals = met.where("side != 'above'").groupBy(*component, "xc", "xd", "xw").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        way = paths.select(F.col("c").alias("xc"), "depth", F.col("node").alias("conv_id"))
        along = totals.join(way, "xc").where("depth BETWEEN td AND xd").select("conv_id", "depth", "leaf", "saved", "xw")
        along = settle(along, "along")
        given.append(along.select("conv_id", "depth", "leaf", "saved"))
        names = ["conv_id", "depth", "parent", "w", "leaf", "saved", *component]
        below = met.where("side = 'under'").withColumn("tc", F.col("node")).withColumn("td", F.col("xd") + 1).select(*names)
        less = along.select("conv_id", "depth", F.col("xw").alias("less"))
        above = met.where("side = 'above'").select(*names).join(less, ["conv_id", "depth"], "left").withColumn("w", F.col("w") - F.coalesce("less", F.lit(0))).select(*names)
        state = settle(below.unionByName(above), "components")
        discard(met)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    every = _solved(settle(whole, "small"), local)
    for more in given:
        every = every.unionByName(more)
    return every.groupBy("conv_id", "depth").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def build(convs: DataFrame, turns: DataFrame, block: int = BLOCK, local: int = LOCAL) -> DataFrame:
    """One row a node of the trie of ``turns (conv_id, at, told, chars)``.

    ``convs (conv_id)`` names every conversation once, also those without turns.
    """
    rows = settle(prefixes(turns, block), "prefixes")
    members = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).first()
    if not members["n_convs"]:
        return convs.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    root_conv = F.lit(members["conv_id"])
    figures = [F.min("depth").alias("depth"), F.min("up").alias("up"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"), F.sum("rest").alias("w")]
    plain = settle(rows.groupBy("key").agg(*figures), "nodes")
    # Parents by key; the root, which most nodes may have as parent, needs no join.
    named = plain.select(F.col("key").alias("up"), F.col("conv_id").alias("parent"))
    deep = plain.where("depth > 1").join(named, "up").unionByName(plain.where("depth = 1").withColumn("parent", root_conv))
    children = plain.groupBy("up").agg(F.count(F.lit(1)).alias("n_children"))
    weight = plain.where("depth = 1").agg(F.coalesce(F.sum("w"), F.lit(0)) + F.lit(members["n_convs"])).first()[0]
    root = convs.sparkSession.createDataFrame(
        [(bytearray(ROOT), 0, None, members["conv_id"], members["n_convs"], 0, weight, None)],
        "key binary, depth long, up binary, conv_id long, n_convs long, chars long, w long, parent long",
    )
    every = deep.unionByName(root).join(children.withColumnRenamed("up", "key"), "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = settle(every, "tree")
    worth = nodes.select("conv_id", "depth", "parent", "w", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    reps = nodes.select("conv_id").distinct()
    way = rows.select("conv_id", "key").join(reps, "conv_id", "left_semi").join(nodes.select("key", "depth", F.col("conv_id").alias("node"), F.col("parent").alias("up")), "key")
    start = reps.select("conv_id", F.lit(0).cast("long").alias("depth"), root_conv.alias("node"), F.lit(None).cast("long").alias("up"))
    paths = settle(way.select("conv_id", "depth", "node", "up").unionByName(start).withColumnRenamed("conv_id", "c"), "paths")
    totals = settle(sums(worth, paths, local), "sums")
    empty = convs.join(rows.where("depth = 1").select("conv_id"), "conv_id", "left_anti").select(F.lit(bytearray(ROOT)).alias("key"), "conv_id")
    ends = settle(ends_hash(rows.where("rest = 1").select("key", "conv_id").unionByName(empty)), "ends")
    out = nodes.join(totals, ["conv_id", "depth"]).join(ends, "key", "left")
    return out.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def of_conversations(conversations: DataFrame, block: int = BLOCK, local: int = LOCAL) -> DataFrame:
    """The trie of conversations as they stand."""
    turns = settle(numbered(conversations), "numbered")
    return build(turns.select("conv_id").distinct(), turns, block, local)
