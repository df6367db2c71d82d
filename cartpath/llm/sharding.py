"""Sharding by a hierarchical weighted hash tree.

A row descends from the root to a region, a rack and a shard. At each node every child draws
``ln(u) / weight`` with ``u`` from a hash of the key and the child's path, and the largest draw wins,
so a child receives its share of the weight and a changed weight moves rows only to or from the
subtree that changed. A new shard enters as a subtree of its own, and takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpath.llm.common import durable


@dataclass(frozen=True)
class Node:
    """A shard (``shard`` is set) or a group of nodes. A group weighs what its children weigh."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(child.weight for child in self.children) if self.children else self.own_weight


def grid(regions: int, racks: int, shards: int) -> Node:
    """A tree of equal shards, numbered from 0."""
    number = iter(range(regions * racks * shards))
    return Node(
        "root",
        tuple(
            Node(f"region{r}", tuple(Node(f"rack{k}", tuple(Node(f"shard{s}", shard=next(number)) for s in range(shards))) for k in range(racks)))
            for r in range(regions)
        ),
    )


def grown(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a rack and a region of its own."""
    leaf = Node("shard0", shard=shard, own_weight=weight)
    return Node(tree.name, (*tree.children, Node(f"region-of-{shard}", (Node("rack0", (leaf,)),))))


def place(tree: Node, key: Column, path: str = "") -> Column:
    """The shard of ``key``. A null key is a key like any other."""
    if tree.shard is not None:
        return F.lit(tree.shard)
    below = [(place(child, key, f"{path}/{child.name}"), child, f"{path}/{child.name}") for child in tree.children]
    if len(below) == 1:
        return below[0][0]

    def draw(child: Node, name: str) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
        return F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(child.weight)

    winner = F.greatest(*(F.struct(draw(c, p).alias("draw"), F.lit(i).alias("at")) for i, (_, c, p) in enumerate(below)))["at"]
    if all(child.shard is not None for child in tree.children):
        return F.element_at(F.array(*(F.lit(c.shard) for c in tree.children)), winner + 1)
    # ``winner`` appears once; the branches are tried by its number.
    return _switch(winner, [branch for branch, _, _ in below])


def _switch(number: Column, branches: list[Column]) -> Column:
    chosen = F.when(number == 0, branches[0])
    for i, branch in enumerate(branches[1:], 1):
        chosen = chosen.when(number == i, branch)
    return chosen


def shard(rows: DataFrame, key: str, tree: Node, larger: Node) -> DataFrame:
    """Columns of ``rows`` with ``shard``, ``grown_shard`` and ``slot``, the place inside the shard.

    Slots count from 0 without gaps, in the order of the input's partitions. Rows of one shard are
    numbered partition by partition with an offset for each, so no task holds a whole shard; repeated
    rows and null keys are rows like any other. An empty table gives an empty table. Columns of the
    input named like an added one are replaced.
    """
    kept = [name for name in rows.columns if name not in ("shard", "grown_shard", "slot")]
    placed = rows.select(*kept, place(tree, F.col(key)).alias("shard"), place(larger, F.col(key)).alias("grown_shard"))
    # The partition numbers and the order in them must not change between the two uses below.
    fixed = durable(placed).withColumns({"_part": F.spark_partition_id(), "_order": F.monotonically_increasing_id()})
    sizes = fixed.groupBy("_part", "shard").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", "shard", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part", "shard").orderBy("_order"))
    return (
        fixed.withColumn("_inside", inside)
        .join(offsets, ["_part", "shard"])
        .select(*kept, "shard", "grown_shard", (F.col("_before") + F.col("_inside") - 1).alias("slot"))
    )
