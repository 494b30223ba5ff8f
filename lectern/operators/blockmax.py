"""Best documents of many questions out of posting blocks with maxima.

Documents stand in blocks. For every term and block there is one row: the postings of the
term in the block and the largest weight among them. What a question can score in a block
is at most the sum of its terms' largest weights there. The blocks where that is largest
are scored first; they give each question a score its ``k`` best reach at least, and a
block whose bound is below it is never joined with the question.

A task scores a block of documents against a block of questions and hands on ``k`` rows a
question, so no row for a pair of question and document is shuffled. A term of a third of
the corpus is one row of bounded length in every block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

#: Documents of a block (a power of two), questions scored together, blocks scored first.
BLOCK_DOCS = 1024
QUESTIONS = 1024
FIRST = 2
#: Scores are sums of whole multiples of this, so no order of adding changes them.
UNIT = 1e-12
_SLACK = 1e-9


def with_blocks(docs: DataFrame, size: int = BLOCK_DOCS) -> DataFrame:
    """``docs`` in order of ``id`` with the number of their ``block``.

    Row numbers of a task start at a multiple of every block size, so no block crosses a
    task's range of ids.
    """
    ranged = docs.repartitionByRange("id").sortWithinPartitions("id")
    return ranged.withColumn("block", F.floor(F.monotonically_increasing_id() / size))


def hashed_block(key: Column, documents: int, size: int = BLOCK_DOCS) -> Column:
    """A block number where documents needn't be in order."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, math.ceil(documents / size))))


def _lists(rows: pa.Table) -> pa.Table:
    """One row for every term of a block: its largest weight and its postings by id."""
    rows = rows.combine_chunks()
    coded = rows.column("term").combine_chunks().dictionary_encode("encode")
    rows = rows.set_column(rows.schema.get_field_index("term"), "term", coded.indices)
    rows = rows.take(pc.sort_indices(rows, [("term", "ascending"), ("id", "ascending"), ("w", "ascending")])).combine_chunks()
    code, w = rows.column("term").to_numpy(), rows.column("w").to_numpy()
    starts = np.nonzero(np.diff(code, prepend=-1))[0]
    cuts = pa.array(np.append(starts, len(code)), pa.int32())
    ids, ws = (pa.ListArray.from_arrays(cuts, rows.column(c).combine_chunks()) for c in ("id", "w"))
    columns = [rows.column("block").take(pa.array(starts)), coded.dictionary.take(pa.array(code[starts])), pa.array(np.maximum.reduceat(w, starts)), ids, ws]
    return pa.table(columns, ["block", "term", "most", "ids", "ws"])


def posting_blocks(postings: DataFrame) -> DataFrame:
    """``(block, term, most, ids, ws)`` of ``postings (block, term, id, w)``.

    Postings are dealt by block as they are and put together there: collected by block and
    term they would be sorted on either side of the shuffle. Ids and weights are two plain
    arrays, in order of id, which are copied at once and not posting by posting.
    """
    kinds = dict(postings.dtypes)
    schema = f"block {kinds['block']}, term string, most double, ids array<{kinds['id']}>, ws array<double>"
    return postings.select("block", "term", "id", "w").groupBy("block").applyInArrow(_lists, schema)


def bounds(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """``(query_id, block, bound)`` for every block that holds a term of the question."""
    met = blocks.select("block", "term", "most").join(weights, "term")
    return met.groupBy("query_id", "block").agg((F.sum(F.col("idf") * F.col("most")) + _SLACK).alias("bound"))


def _score(held: pa.Table, asked: pa.Table, k: int | None):
    """Question, document and score of a block of documents and one of questions."""
    lists = held.column("ids").combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    every_id, w = lists.flatten(), held.column("ws").combine_chunks().flatten().to_numpy()
    ids = every_id.unique().sort()
    doc = np.asarray(pc.index_in(every_id, ids))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    place = {t: i for i, t in enumerate(held.column("term").to_pylist())}
    pairs = asked.column("terms").combine_chunks()
    counts, inner = pairs.value_lengths().to_numpy(zero_copy_only=False), pairs.flatten()
    question = np.repeat(np.arange(len(asked)), counts)
    term = np.array([place.get(t, -1) for t in inner.field("term").to_pylist()], dtype=np.int64)
    idf = inner.field("idf").to_numpy()
    there = term >= 0
    question, term, idf = question[there], term[there], idf[there]
    order = np.argsort(term, kind="stable")
    question, term, idf = question[order], term[order], idf[order]
    total = np.zeros((len(asked), len(ids)), dtype=np.int64)
    cuts = np.append(np.nonzero(np.diff(term, prepend=-1))[0], len(term))
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = slice(starts[term[a]], starts[term[a] + 1])
        total[np.ix_(question[a:b], doc[part])] += np.rint(np.outer(idf[a:b], w[part]) / UNIT).astype(np.int64)
    if k is not None and k < len(ids):
        best = np.argsort(-total, axis=1, kind="stable")[:, :k]
        rows, cols = np.repeat(np.arange(len(asked)), best.shape[1]), best.ravel()
    else:
        rows, cols = np.nonzero(total > 0)
    scores = total[rows, cols]
    rows, cols, scores = rows[scores > 0], cols[scores > 0], scores[scores > 0]
    return asked.column("query_id").take(pa.array(rows)), ids.take(pa.array(cols)), pa.array(scores * UNIT)


def score_blocks(blocks: DataFrame, pairs: DataFrame, weights: DataFrame, k: int | None = None, questions: int = QUESTIONS) -> DataFrame:
    """``(query_id, id, score)`` of ``pairs (query_id, block)``: the ``k`` best of each, or all."""
    kinds = dict(weights.dtypes)["query_id"], blocks.schema["ids"].dataType.elementType.simpleString()
    packed = weights.groupBy("query_id").agg(F.collect_list(F.struct("term", "idf")).alias("terms"))
    packed = settle(packed, "questions")
    groups = max(1, math.ceil(packed.count() / questions))
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("qb")
    asked = pairs.join(packed, "query_id").select("block", group, "query_id", "terms")
    meets = pairs.select("block", group).distinct()
    vocabulary = weights.select(group, "term").distinct()
    held = blocks.select("block", "term", "ids", "ws").join(meets, "block").join(vocabulary, ["qb", "term"], "left_semi").select("block", "qb", "term", "ids", "ws")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "id", "score"]
        if not len(left) or not len(right):
            inner = left.schema.field("ids").type.value_type
            return pa.table([pa.array([], right.schema.field("query_id").type), pa.array([], inner), pa.array([], pa.float64())], names)
        return pa.table(list(_score(left.combine_chunks(), right.combine_chunks(), k)), names)

    schema = f"query_id {kinds[0]}, id {kinds[1]}, score double"
    return held.groupBy("block", "qb").cogroup(asked.groupBy("block", "qb")).applyInArrow(run, schema)


def ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def topk_blocks(blocks: DataFrame, weights: DataFrame, k: int, first: int = FIRST, questions: int = QUESTIONS) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` best documents of every question.

    ``blocks`` as of ``posting_blocks`` and ``weights (query_id, term, idf)`` should be
    written tables; both are read more than once.
    """
    limits = settle(bounds(blocks, weights), "bounds")
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    start = settle(limits.withColumn("n", F.row_number().over(order)).where(F.col("n") <= first).select("query_id", "block"), "first-blocks")
    found = settle(ranked(score_blocks(blocks, start, weights, k, questions), k), "first-found")
    reached = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select("query_id", "least")
    rest = limits.join(start, ["query_id", "block"], "left_anti").join(reached, "query_id", "left")
    rest = settle(rest.where(F.col("bound") >= F.coalesce("least", F.lit(0.0))).select("query_id", "block"), "open-blocks")
    if rest.isEmpty():
        return found
    more = score_blocks(blocks, rest, weights, k, questions)
    return ranked(found.select("query_id", "id", "score").unionByName(more), k)
