"""Ordered window results for groups of any size.

A window puts each of its groups into one task. That is the right plan for sessions and customers
of ordinary size, one exchange and one sort, but not where one key (a bot, or the NULL key of
anonymous traffic) holds a third of all rows. So groups over ``HOT_GROUP_ROWS`` are found first, by
a count that combines before its exchange, and take another way to the same result: their rows are
range-partitioned by key and order, which cuts a big group into chunks of about equal size, and
what a chunk needs from the ones before it (rows so far, running sums, last row, group totals) comes
from one summary row per chunk. Where no group is hot, which is the usual case, the plan is the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpath.session import durable

# A group of this many rows still sorts within one task's memory.
HOT_GROUP_ROWS = 200_000
# Up to this many hot keys are sent to every task; beyond it the split is a shuffled join.
BROADCAST_KEYS = 10_000
# Most range partitions the rows of hot groups are cut into. It bounds tasks, not rows.
MOST_CHUNKS = 20_000


@dataclass(frozen=True)
class HotKeys:
    """Digests of the keys of oversized groups (``_digest``), with their rows (``_rows``)."""

    frame: DataFrame
    few: bool
    total_rows: int
    limit: int

    def side(self) -> DataFrame:
        return F.broadcast(self.frame) if self.few else self.frame

    @property
    def chunks(self) -> int:
        return max(2, min(MOST_CHUNKS, ceil(self.total_rows / self.limit)))


def within_limit(table: DataFrame, limit: int = HOT_GROUP_ROWS) -> bool:
    """Whether a whole table has no more rows than one group may have.

    On a plain scan this is a count from file footers, and saves looking for hot keys.
    """
    return table.count() <= limit


def hot_keys(
    rows: DataFrame,
    keys: Sequence[str],
    limit: int = HOT_GROUP_ROWS,
    size: Column | None = None,
) -> HotKeys | None:
    """Keys of the groups with more than ``limit`` rows, or None where there is no such group.

    ``size`` is the aggregate that gives a group's rows, their count if left out; it may be an upper
    bound, since the way of the hot groups is exact for any group.

    Keys are counted by a digest, which keeps what is exchanged small and treats NULL as a key. Two
    keys with one digest only make a group hot that need not be. At most ``BROADCAST_KEYS`` + 1
    digests reach the driver. Since every one stands for more than ``limit`` rows, more than that
    only occur in very large tables; then the whole set is checkpointed and joined without a
    broadcast.
    """
    size = F.count(F.lit(1)) if size is None else size
    counted = rows.groupBy(_digest(keys)).agg(size.alias("_rows")).where(F.col("_rows") > limit)
    found = counted.limit(BROADCAST_KEYS + 1).collect()
    if not found:
        return None
    if len(found) <= BROADCAST_KEYS:
        frame = rows.sparkSession.createDataFrame(found, counted.schema)
        return HotKeys(frame, True, sum(row["_rows"] for row in found), limit)
    frame = durable(counted)
    return HotKeys(frame, False, frame.agg(F.sum("_rows")).first()[0], limit)


def _digest(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).alias("_digest")


def split_hot(
    rows: DataFrame, keys: Sequence[str], hot: HotKeys | None
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary groups, and those of hot groups (None if there are none)."""
    if hot is None:
        return rows, None
    marked, side = rows.select("*", _digest(keys)), hot.side().select("_digest")
    return tuple(marked.join(side, "_digest", how).drop("_digest") for how in ("left_anti", "left_semi"))


def _on(keys: Sequence[str], left: DataFrame, right: DataFrame) -> Column:
    """Equality of the keys with NULL equal to NULL, as in grouping."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[f"_{k}"]) for k in keys))


def _prefixed(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame.withColumnsRenamed({k: f"_{k}" for k in keys})


def ordered_context(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    number: str,
    previous: dict[str, str] | None = None,
    totals: dict[str, Column] | None = None,
    running: dict[str, Column] | None = None,
    highest: dict[str, Column] | None = None,
    hot: HotKeys | None = None,
    ties: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Number the rows of each group in order, with values of the rows before and of the group.

    ``number`` names the 1-based row number (a bigint), ``previous`` maps new columns to the column whose
    value in the row before they take, ``totals`` maps new columns to aggregates of the group,
    ``running`` maps new columns to bigint expressions that are summed over all rows before, and
    ``highest`` to expressions whose largest value in the rows before they take.
    ``ties`` says that rows may be equal in keys and order, as copies of one event are; any number
    of them is cut into chunks like other rows, in an order that is arbitrary but fixed.
    ``tasks`` is the number of tasks the rows of ordinary groups are dealt out over, by key, instead of
    the session's number of shuffle partitions.
    """
    previous, totals, running, highest = previous or {}, totals or {}, running or {}, highest or {}
    ordinary, oversized = split_hot(rows, keys, hot)
    ordinary = ordinary if tasks is None else ordinary.repartition(tasks, *keys)
    group = Window.partitionBy(*keys)
    in_order = group.orderBy(*order)
    result = ordinary.select(
        "*",
        F.row_number().over(in_order).cast("bigint").alias(number),
        *(F.lag(source).over(in_order).alias(name) for name, source in previous.items()),
        *(_sum_before(value, in_order).alias(name) for name, value in running.items()),
        *(_highest_before(value, in_order).alias(name) for name, value in highest.items()),
        *(total.over(group).alias(name) for name, total in totals.items()),
    )
    if oversized is None:
        return result
    if ties:
        # A written number per row tells copies apart. Unwritten, it could change when a lost task
        # is run again, and rows would then be lost or doubled in the exchange behind it.
        oversized = durable(oversized.withColumn("_tie", F.monotonically_increasing_id()))
        order = [*order, "_tie"]
    chunked = _chunked_context(oversized, keys, order, number, previous, totals, running, highest, hot)
    return result.unionByName(chunked.drop("_tie"))


def _sum_before(value: Column, in_order) -> Column:
    """Sum over the rows before the current one; 0 for the first. The frame ends at the row itself, so that it shares its sort."""
    summed = F.sum(value.cast("bigint")).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return summed - value.cast("bigint")


def _highest_before(value: Column, in_order) -> Column:
    return F.max(value).over(in_order.rowsBetween(Window.unboundedPreceding, -1))


def _chunked_context(rows, keys, order, number, previous, totals, running, highest, hot: HotKeys) -> DataFrame:
    # The chunk of a row is its range partition. The partition id is only stable once written, so
    # the chunked rows are checkpointed and everything below reads that copy.
    chunked = durable(
        rows.repartitionByRange(hot.chunks, *keys, *order).withColumn("_chunk", F.spark_partition_id())
    )
    position = F.struct(*order)
    carried = F.struct(*(F.col(source).alias(name) for name, source in previous.items())) if previous else F.lit(None)
    earlier = Window.partitionBy(*keys).orderBy("_chunk")
    sums = {f"_{i}_sum": value.cast("bigint") for i, value in enumerate(running.values())}
    tops = {f"_{i}_top": value for i, value in enumerate(highest.values())}

    def in_earlier(name: str) -> Column:
        return F.coalesce(F.sum(name).over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    summary = (
        chunked.groupBy(*keys, "_chunk")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max_by(carried, position).alias("_last"),
            *(F.sum(value).alias(name) for name, value in sums.items()),
            *(F.max(value).alias(name) for name, value in tops.items()),
        )
        .select(
            *keys,
            "_chunk",
            in_earlier("_n").alias("_before"),
            F.lag("_last").over(earlier).alias("_carried"),
            *(in_earlier(name).alias(name) for name in sums),
            *(_highest_before(F.col(name), earlier).alias(name) for name in tops),
        )
    )
    # One row per chunk and key: as many as there are chunks and hot keys.
    summary = _prefixed(summary, [*keys, "_chunk"])
    rows = chunked.join(
        F.broadcast(summary) if hot.few else summary, _on([*keys, "_chunk"], chunked, summary)
    ).drop(*(f"_{k}" for k in [*keys, "_chunk"]))
    if totals:
        group = _prefixed(chunked.groupBy(*keys).agg(*(t.alias(name) for name, t in totals.items())), keys)
        rows = rows.join(F.broadcast(group) if hot.few else group, _on(keys, rows, group)).drop(
            *(f"_{k}" for k in keys)
        )
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    place = F.row_number().over(in_chunk)
    return rows.select(
        *(c for c in rows.columns if c not in {"_chunk", "_before", "_carried", *sums, *tops, *totals}),
        (place + F.col("_before")).alias(number),
        *(
            F.when(place == 1, F.col(f"_carried.{name}")).otherwise(F.lag(source).over(in_chunk)).alias(name)
            for name, source in previous.items()
        ),
        *(
            (_sum_before(value, in_chunk) + F.col(carry)).alias(name)
            for (name, value), carry in zip(running.items(), sums, strict=True)
        ),
        *(
            F.greatest(_highest_before(value, in_chunk), F.col(carry)).alias(name)
            for (name, value), carry in zip(highest.items(), tops, strict=True)
        ),
        *totals,
    )
