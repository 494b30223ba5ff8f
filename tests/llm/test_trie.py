"""The trie against one built turn by turn in memory."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lectern.llm import trie
from lectern.llm.queries import op13_conversation_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(rows):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            held[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, v in held.items()}


def with_heads(held):
    out = {}
    for c, turns in held.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = held.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(held):
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, turns in held.items():
        node = ()
        members[node].append(c)
        for t in turns:
            children[node].add(node + (t,))
            node += (t,)
            members[node].append(c)
        ends[node].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (min(members[n]), len(n), min(members[n[:-1]]) if n else -1, len(members[n]), len(children[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n in members
    )


def told(df):
    rows = [tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows)


def made(rng, convs):
    """Conversations that share heads of all lengths, copies, gaps and odd cells."""
    rows, held = [], []
    for c in rng.sample(range(3 * convs), convs):
        turns = list(rng.choice(held)[: rng.randrange(0, 9)]) if held and rng.random() < 0.7 else []
        turns += [(rng.choice(["user", "assistant", "", None]), rng.choice(["yes", "no", "", None, "é\U0001f600 long text"])) for _ in range(rng.randrange(0, 7))]
        held.append(turns)
        rows += [(c, None if i == 0 and rng.random() < 0.1 else i, role, text) for i, (role, text) in enumerate(turns)]
    rows += [(rng.choice(rows)[0], 3, "user", "tie") for _ in range(10)] + [rows[5]] * 3 + [(None, 1, "user", "lost")] * 2
    return rows


@pytest.mark.parametrize("local,block", [(trie.LOCAL, trie.BLOCK), (4, 2)])
def test_trie_of_made_conversations(spark, local, block):
    rows = made(random.Random(local), 90)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    held = conversations(rows)
    assert told(trie.of_conversations(df, block, local)) == brute(held)
    turns = trie.settle(trie.numbered(df), "numbered")
    assert told(trie.build(*rebuilt(turns), block, local)) == brute(with_heads(held))


def test_deep_chain_and_hot_node(spark):
    chain = [(7, i, "user", f"turn {i % 3}") for i in range(400)]
    rows = chain + [(c, i, "user", "same") for c in range(100, 400) for i in range(2)] + [r for k in (8, 9) for r in [(k, *t[1:]) for t in chain[: 100 * k - 700]]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert told(trie.of_conversations(df, block=64, local=100)) == brute(conversations(rows))


def test_query_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(op13_conversation_trie(spark, "/root/testdata/sf0.01")) == brute(with_heads(conversations(rows)))


def test_rollup_of_forests():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 60)
        parents = [-1 if i == 0 or rng.random() < 0.05 else rng.choice([i - 1, rng.randrange(i)]) for i in range(n)]
        values = [(rng.randrange(3), rng.randrange(100)) for _ in range(n)]
        want = [list(v) for v in values]
        for i in reversed(range(n)):
            if parents[i] >= 0:
                want[parents[i]][0] += want[i][0]
                want[parents[i]][1] += want[i][1]
        assert trie.rollup(parents, values) == want


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.of_conversations(none).count() == 0
    rows = [(None, 0, "user", "x"), (-5, None, None, None), (-5, None, None, None), (3, 1, "user", "long " * 200_000), (3, 1, "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS depth", "3 AS at", "4 AS told", "5 AS w")
    assert told(trie.of_conversations(df)) == brute(conversations(rows))
