from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from cartpath.llm import oracle, queries
from cartpath.llm.forward import MessageQueue, forward
from cartpath.llm.prefix_trie import prefix_trie
from compare import oracle_rows, spark_rows

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
DDL = "conv_id long, turn long, role string, text string"


def plain_trie(turns: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for conv_id, turn, role, text in turns:
        if conv_id is not None:
            own[conv_id].append(((turn is not None, turn or 0, role or "", text or ""), (role or "", text or "")))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        family = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole = tuple(own.get(family, [])[:h] + mine[h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append(c)
        ends[whole].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in nodes:
        if node:
            children[node[:-1]] += 1
    for node, members in nodes.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(members),
            len(node),
            min(nodes[node[:-1]]) if node else None,
            len(members),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, members in nodes.items()
    )


def result(rows, **options) -> list[tuple]:
    return sorted(tuple(r) for r in prefix_trie(rows, **options).select(*NAMES).collect())


def generated(seed: int) -> list[tuple]:
    """Families, copies, long conversations, few words; ties, nulls, repeated rows and a negative id among them."""
    random.seed(seed)
    rows = []
    for c in [*range(0, 260), *range(1000, 1040), -7, -100]:
        for turn in range(random.choice([1, 2, 3, 8, 30])):
            rows.append((c, random.choice([turn, turn, None]), random.choice(["user", "assistant", None]), random.choice(["hi", "ho", "", None, "långt"])))
    rows += [(c, t, "user", f"same {t}") for c in range(2000, 2150) for t in range(4)]
    rows += rows[:40] + [(None, 0, "user", "nobody")]
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_nodes": 40, "queue_messages": 3}, {"shard_nodes": 200, "hot_rows": 10, "block": 4}])
def test_against_plain_version(spark, options):
    rows = generated(len(options))
    assert result(spark.createDataFrame(rows, DDL).repartition(5), **options) == plain_trie(rows)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')")
    assert spark_rows(queries.conversation_trie(spark, folder)) == oracle_rows(connection, oracle.TRIE)


def test_shards_cut_anywhere(spark, monkeypatch):
    """Shards that ignore the tree give the same totals: also a node whose children are all elsewhere is no leaf."""
    monkeypatch.setattr("cartpath.llm.prefix_trie._PATH_TURNS", 0)
    rows = generated(9)
    assert result(spark.createDataFrame(rows, DDL), shard_nodes=25) == plain_trie(rows)


def test_edge_rows(spark):
    assert prefix_trie(spark.createDataFrame([], DDL)).count() == 0
    only_null = [(None, 1, "a", "b")]
    assert prefix_trie(spark.createDataFrame(only_null, DDL)).count() == 0
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2)
    rows = [(turnless, 1, None, None), (turnless, None, "x", "é" * 100_000), (7, 5, "", "")]
    wide = spark.createDataFrame([(*r, 1, "clash") for r in rows], DDL + ", depth int, k1 string")
    assert result(wide) == plain_trie(rows)
    root = next(r for r in plain_trie(rows) if r[1] == 0)
    assert root[3] == 2 and root[7] != hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("most", [1, 5, 10**6])
def test_queue_spills_and_keeps_order(most):
    """A random tree through a queue of a few messages, totals against a plain sum."""
    random.seed(most)
    parent = {i: random.randrange(max(0, i - 50), i) for i in range(1, 800)}
    depth = {0: 0}
    for i in range(1, 800):
        depth[i] = depth[parent[i]] + 1
    total = {i: i for i in range(800)}
    for i in sorted(parent, key=depth.get, reverse=True):
        total[parent[i]] += total[i]
    order = sorted(range(800), key=lambda i: (-depth[i], i))
    queue = MessageQueue(most)
    nodes = [((-depth[i], i, 0), (1 - depth[i], parent.get(i, 0), 0), (0, 0, i)) for i in order]
    got = {key[1]: sums for key, sums, outside in forward(nodes, True, queue) if not outside}
    assert {i: s[2] for i, s in got.items()} == total
    assert {i: s[0] for i, s in got.items()} == {i: sum(p == i for p in parent.values()) for i in range(800)}
    assert (queue.spills > 0) == (most < 100)
    # Half of the nodes only: what the others should have had comes out as messages, once for each.
    outside = [(key, sums) for key, sums, away in forward([n for n in nodes if n[0][1] % 2], True, MessageQueue(most)) if away]
    assert len({key for key, _ in outside}) == len(outside)
    assert sum(s[2] for _, s in outside) == sum(i for i in range(800) if i % 2)
