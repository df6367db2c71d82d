"""The prefix trie of conversations, with totals of each subtree.

A node is a distinct sequence of first turns. Its identity is the exclusive or, over the turns, of a
128-bit hash of place, role and text, so one window gives all prefixes of a conversation and a node
knows its parent. Nodes are cut into shards in the order of a walk that visits a node before its
children; each shard is one task that passes totals up by time-forward processing (``forward``). What
is left for nodes of other shards goes to ancestors of a shard's first node, a few rows per shard; a
last pass over these nodes and their ancestors brings the totals across the shard roots.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpath.llm.common import written
from cartpath.llm.forward import MessageQueue, forward
from cartpath.operators.skew import HOT_GROUP_ROWS, hot_keys, ordered_context, within_limit

KEY = ["depth", "k1", "k2"]
SUMS = ["n_children", "n_leaves", "saved_tokens"]
_BLOCK_TURNS = 4096  # a conversation's turns are summed in blocks of so many
_PATH_TURNS = 16  # first turns that place a node in a shard; they bear on balance alone
_CHUNK = 1 << 20  # bytes of joined ids in one row
# Fixed value: what an empty list of ids hashes to.
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """conv_id, pos (from 1), d1 and d2 (a hash of role and text) and n_chars, in the order of turn, role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    hot = None if within_limit(rows, hot_rows) else hot_keys(rows, ["conv_id"], hot_rows)
    placed = ordered_context(rows, ["conv_id"], ["turn", "role", "text"], number="pos", hot=hot, ties=True)
    digest = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    d1, d2 = (F.conv(F.substring(digest, start, 15), 16, 10).cast("long") for start in (1, 16))
    return placed.select("conv_id", "pos", d1.alias("d1"), d2.alias("d2"), F.char_length("text").cast("long").alias("n_chars"))


def head_turns(conv_id: Column, most: int) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % most


def rebuilt(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """All conversation ids, and the turns of each conversation with its head taken from the first of its family.

    A conversation begins with the first turns of the conversation whose id is its own without the
    remainder by ``family`` (as many as ``head_turns`` says, or as there are); its own turns after so
    many follow.
    """
    first = F.col("conv_id") - F.col("conv_id") % family
    convs = turns.select("conv_id").distinct().select("conv_id", first.alias("_first"), head_turns(F.col("conv_id"), most).alias("_head"))
    heads = turns.where(F.col("conv_id") % family == 0).where(F.col("pos") < most)
    heads = heads.groupBy(F.col("conv_id").alias("_first")).agg(F.array_sort(F.collect_list(F.struct("pos", "d1", "d2", "n_chars"))).alias("_turns"))
    joined = convs.join(heads, "_first", "left")
    given = F.slice("_turns", F.lit(1), F.col("_head").cast("int"))
    sized = written(joined.select("conv_id", "_head", given.alias("_given")), "trie-heads")
    begun = sized.select("conv_id", F.inline("_given"))
    shift = sized.select("conv_id", "_head", F.coalesce(F.size("_given"), F.lit(0)).alias("_size"))
    rest = turns.join(shift, "conv_id").where(F.col("pos") > F.col("_head"))
    rest = rest.select("conv_id", (F.col("pos") - F.col("_head") + F.col("_size")).alias("pos"), "d1", "d2", "n_chars")
    return sized.select("conv_id"), begun.select(rest.columns).unionByName(rest)


def prefixes(turns: DataFrame, block: int = _BLOCK_TURNS) -> DataFrame:
    """The prefix that each turn ends: conv_id, depth, k1, k2, the parent's p1 and p2, n_chars of the last turn, whether it is whole."""
    own = {f"e{i}": F.xxhash64(F.lit(i), "pos", "d1", "d2") for i in (1, 2)}
    rows = written(turns.select("conv_id", F.col("pos").alias("depth"), "n_chars", *(c.alias(n) for n, c in own.items())), "trie-turns")
    longest = rows.agg(F.max("depth")).first()[0] or 0
    before = {"b1": F.lit(0), "b2": F.lit(0)}
    keys = ["conv_id"]
    if longest > block:
        # Blocks of a long conversation are summed by themselves; a block starts with the sum of those before it.
        keys = ["conv_id", "_block"]
        rows = rows.withColumn("_block", F.floor((F.col("depth") - 1) / block))
        earlier = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = rows.groupBy(*keys).agg(F.bit_xor("e1").alias("e1"), F.bit_xor("e2").alias("e2"))
        blocks = blocks.select(*keys, *(F.coalesce(F.bit_xor(f"e{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in (1, 2)))
        rows = rows.join(blocks, keys)
        before = {name: F.col(name) for name in before}
    so_far = Window.partitionBy(*keys).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max("depth").over(Window.partitionBy(*keys))
    summed = rows.select(
        "conv_id",
        "depth",
        *(F.bit_xor(f"e{i}").over(so_far).bitwiseXOR(before[f"b{i}"]).alias(f"k{i}") for i in (1, 2)),
        "e1",
        "e2",
        "n_chars",
        last.alias("_last"),
    )
    if longest > block:
        whole = rows.groupBy("conv_id").agg(F.max("depth").alias("_end"))
        summed = summed.join(whole, "conv_id").withColumn("_last", F.col("_end"))
    return summed.select(
        "conv_id",
        *KEY,
        F.col("k1").bitwiseXOR(F.col("e1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("e2")).alias("p2"),
        "n_chars",
        (F.col("depth") == F.col("_last")).alias("is_whole"),
        "e1",
    )


def _with_root(members: DataFrame, convs: DataFrame) -> DataFrame:
    """Every conversation also has the root as a prefix, and one without turns ends there."""
    turned = members.where("depth = 1").select("conv_id", F.lit(True).alias("_turned"))
    zero = F.lit(0).cast("long")
    root = convs.join(turned, "conv_id", "left").select(
        "conv_id",
        *(zero.alias(c) for c in (*KEY, "p1", "p2", "n_chars")),
        F.col("_turned").isNull().alias("is_whole"),
        zero.alias("e1"),
    )
    return members.unionByName(root)


def ends_hashes(ends: DataFrame, partitions: int) -> DataFrame:
    """SHA-256 of the ascending ids, joined by commas, for each key of ``ends`` (depth, k1, k2, conv_id).

    The ids of one node may be a third of all. They are sorted over all tasks and joined there into
    a few long rows; only these meet, in order, in one hash, which is fed piece by piece.
    """

    def join(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size, made = None, [], 0, []

        def close():
            if ids:
                made.append((*key, ids[0], ",".join(map(str, ids)).encode()))

        for batch in parts:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key or size > _CHUNK:
                    close()
                    key, ids, size = row[:3], [], 0
                ids.append(row[3])
                size += 20
            if len(made) > 10_000 or sum(len(m[4]) for m in made[-8:]) > _CHUNK:
                yield _batch(made, [*KEY, "first", "ids"])
                made = []
        close()
        yield _batch(made, [*KEY, "first", "ids"])

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, made = None, None, []
        for batch in parts:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    if key is not None:
                        made.append((*key, state.hexdigest()))
                    key, state = row[:3], hashlib.sha256(row[4])
                else:
                    state.update(b",")
                    state.update(row[4])
            if len(made) > 10_000:
                yield _batch(made, [*KEY, "ends_sha256"])
                made = []
        if key is not None:
            made.append((*key, state.hexdigest()))
        yield _batch(made, [*KEY, "ends_sha256"])

    ordered = ends.repartitionByRange(partitions, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    joined = written(ordered.mapInArrow(join, "depth long, k1 long, k2 long, first long, ids binary"), "trie-ends")
    grouped = joined.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return grouped.mapInArrow(digest, "depth long, k1 long, k2 long, ends_sha256 string")


_ARROW = {"ids": pa.binary(), "ends_sha256": pa.string(), "is_message": pa.bool_()}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW.get(n, pa.int64())) for n, c in zip(names, columns, strict=True)], names=names)


def _passed_up(sorted_nodes: DataFrame, count_leaves: bool, queue_messages: int) -> DataFrame:
    """Each partition of (depth, k1, k2, p1, p2, sums), in reverse level order, through time-forward processing."""
    names = [*KEY, *SUMS, "is_message"]

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes():
            for batch in parts:
                for depth, k1, k2, p1, p2, *sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield (-depth, k1, k2), (1 - depth, p1, p2), tuple(sums)

        made = []
        for (level, k1, k2), sums, is_message in forward(nodes(), count_leaves, MessageQueue(queue_messages)):
            made.append((-level, k1, k2, *sums, is_message))
            if len(made) >= 10_000:
                yield _batch(made, names)
                made = []
        yield _batch(made, names)

    schema = ", ".join(f"{n} {'boolean' if n == 'is_message' else 'long'}" for n in names)
    return sorted_nodes.select(*KEY, "p1", "p2", *SUMS).mapInArrow(work, schema)


def _reverse_levels(rows: DataFrame) -> DataFrame:
    return rows.sortWithinPartitions(F.col("depth").desc(), "k1", "k2")


def subtree_totals(nodes: DataFrame, members: DataFrame, shards: int, queue_messages: int) -> DataFrame:
    """depth, k1, k2 and the totals of every node.

    ``nodes`` has KEY, p1, p2, conv_id (a member), saved_tokens of the node alone, and ``path``, by which
    the shards are cut; ``members`` the prefixes of every conversation. The shards may lie in any way:
    the paths only keep the rows of the last pass, one task, at about the shards times the turns of
    their first conversations.
    """
    zero = F.lit(0).cast("long")
    own = nodes.select(*KEY, "p1", "p2", zero.alias("n_children"), zero.alias("n_leaves"), "saved_tokens", "path")
    dealt = _reverse_levels(own.repartitionByRange(shards, "path", *KEY))
    passed = written(_passed_up(dealt, True, queue_messages), "trie-shards")
    local, messages = (passed.where(F.col("is_message") == flag).drop("is_message") for flag in (False, True))
    left = written(messages.groupBy(*KEY).agg(*(F.sum(c).alias(c) for c in SUMS)), "trie-messages")
    if left.isEmpty():
        return local
    targets = left.join(nodes.select(*KEY, "conv_id"), KEY).groupBy("conv_id").agg(F.max("depth").alias("_deepest"))
    spine = members.join(targets, "conv_id").where(F.col("depth") <= F.col("_deepest"))
    spine = spine.groupBy(*KEY).agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    inside = local.withColumnRenamed("n_children", "_inside").select(*KEY, "_inside")
    got = spine.join(left, KEY, "left").join(inside, KEY)
    # A node whose children are all elsewhere was taken for a leaf by its shard.
    mistaken = ((F.col("n_children") > 0) & (F.col("_inside") == 0)).cast("long")
    leaves = F.col("n_leaves") - mistaken
    injected = got.select(*KEY, "p1", "p2", *(F.coalesce(c, zero).alias(n) for n, c in zip(SUMS, ("n_children", leaves, "saved_tokens"), strict=True)))
    across = _passed_up(_reverse_levels(injected.coalesce(1)), False, queue_messages)
    more = across.select(*KEY, *(F.col(c).alias(f"_{c}") for c in SUMS))
    joined = local.join(written(more, "trie-across"), KEY, "left")
    return joined.select(*KEY, *((F.col(c) + F.coalesce(f"_{c}", zero)).alias(c) for c in SUMS))


def prefix_trie(
    conversations: DataFrame,
    family: int = 100,
    most_head: int = 6,
    shard_nodes: int = 100_000,
    queue_messages: int = 200_000,
    hot_rows: int = HOT_GROUP_ROWS,
    block: int = _BLOCK_TURNS,
) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), then role and text, a null of which is empty; rows that
    are equal in all of these are turns of their own. Rows without conv_id belong to nothing. A
    conversation that is left without turns is a member of the root, which ends it. An empty table
    has no nodes, not even a root. Other columns are not read.
    """
    turns = written(numbered_turns(conversations, hot_rows), "trie-numbered")
    convs, again = rebuilt(turns, family, most_head)
    members = written(_with_root(prefixes(again, block), convs), "trie-members")
    grouped = members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *(F.min(c).alias(c) for c in ("p1", "p2", "n_chars")),
    )
    nodes = written(grouped, "trie-nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    paths = members.where(F.col("depth").between(1, _PATH_TURNS)).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "e1"))).alias("_path"))
    path = F.slice(F.coalesce(F.col("_path")["e1"], F.expr("array(0L)")), F.lit(1), F.least("depth", F.lit(_PATH_TURNS)).cast("int"))
    named = nodes.join(parents, ["depth", "p1", "p2"], "left").join(paths, "conv_id", "left")
    full = named.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("n_chars")).withColumn("path", path)
    full = written(full.select("conv_id", *KEY, "p1", "p2", "parent_conv_id", "n_convs", "saved_tokens", "path"), "trie-named")
    shards = max(1, ceil(full.count() / shard_nodes))
    totals = subtree_totals(full, members, shards, queue_messages)
    ends = members.where("is_whole").select(*KEY, "conv_id")
    hashed = ends_hashes(ends, shards)
    out = full.drop("saved_tokens", "path", "p1", "p2").join(totals, KEY).join(hashed, KEY, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", *SUMS, F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")
    )
