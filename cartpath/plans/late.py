"""Silver tables that take in late events without being built again.

The tables of sessions are partitioned by a bucket of the session id, those of customers by one of the
customer id. The sessions that new events belong to are put together from their rows in the trail and the
new events, and summed up again; so are the customers of these sessions. Only the buckets that hold any of
them are read and replaced, each table in one step. The funnel and its days are sums over counts that are
kept for each bucket. The result is that of a rebuild from all events.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.functions.stages import CART_ADD, CART_REMOVAL, PAGE_VIEW, PRODUCT_VIEW, PURCHASE, flag_text
from cartpath.operators import funnel, journeys
from cartpath.operators.sessions import (
    PRODUCT_LIST,
    SESSION_KEYS,
    TRAIL_KEYS,
    session_events,
    session_products,
    sessions,
)
from cartpath.operators.skew import HOT_GROUP_ROWS, HotKeys, hot_keys, within_limit
from cartpath.session import written
from cartpath.sources.tables import ensure_schema, write_table
from cartpath.sources.versions import BUCKET, VersionedTable

FLAGS = {
    "is_page_view": PAGE_VIEW,
    "is_product_view": PRODUCT_VIEW,
    "is_add_to_cart": CART_ADD,
    "is_remove_from_cart": CART_REMOVAL,
    "is_purchase": PURCHASE,
}
# What the trail keeps of an event, and all that the tables are made of.
EVENT_COLUMNS = (
    "session_id",
    "customer_id",
    "event_id",
    "event_timestamp",
    "event_type",
    "product_id",
    "product_price",
    "page_url",
    "funnel_stage",
    "_ingested_at",
)
SESSION_TABLES = ("sessions", "session_products", "session_events", "funnel_step_times")
CUSTOMER_TABLES = ("customer_journeys", "customer_journey_sessions")


def _among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows that have one of the keys (``left_semi``) or none (``left_anti``); NULL is a key."""
    renamed = keys.withColumnsRenamed({k: f"_key_{k}" for k in keys.columns})
    same = reduce(lambda a, b: a & b, (rows[k].eqNullSafe(renamed[f"_key_{k}"]) for k in keys.columns))
    return rows.join(renamed, same, how)


@dataclass(frozen=True)
class LateSilver:
    """The silver tables of one schema; ``buckets`` must stay what it was when they were published.

    With more buckets a late batch touches a smaller share of the rows, at more files.
    """

    spark: SparkSession
    silver: str = "silver"
    buckets: int = 64
    hot_rows: int = HOT_GROUP_ROWS

    # --- helpers -----------------------------------------------------------------------------------

    def _table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.silver}.{name}")

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, keys: DataFrame) -> list[int]:
        """Buckets of the keys in a one-column frame, at most as many as there are."""
        return sorted(r[0] for r in keys.select(self._bucket(keys.columns[0])).distinct().collect())

    def _hot(self, rows: DataFrame, keys: Sequence[str]) -> HotKeys | None:
        return None if within_limit(rows, self.hot_rows) else hot_keys(rows, keys, self.hot_rows)

    def _publish(self, rows: DataFrame, name: str, key: str) -> int:
        bucketed = rows.withColumn(BUCKET, self._bucket(key))
        return write_table(_by_bucket(bucketed), f"{self.silver}.{name}", partition_by=(BUCKET,))

    def within(self, name: str, buckets: Sequence[int]) -> DataFrame:
        """The rows of a table in some buckets; files of others are not read."""
        return self._table(name).whole().where(F.col(BUCKET).isin(list(buckets)))

    def _replace(self, name: str, key: str, changed: DataFrame, rows: DataFrame, buckets: Sequence[int]) -> int:
        """In the given buckets, ``rows`` in place of those that have one of the changed keys."""
        kept = _among(self.within(name, buckets), changed, "left_anti")
        fresh = rows.withColumn(BUCKET, self._bucket(key)).select(kept.columns)
        return self._table(name).replace_partitions(_by_bucket(kept.unionByName(fresh)), buckets, "late")

    def _of_sessions(self, events: DataFrame) -> dict[str, DataFrame]:
        trail = session_events(events, self._hot(events, TRAIL_KEYS))
        return {
            "sessions": sessions(events),
            "session_products": session_products(events, self._hot(events, SESSION_KEYS)),
            "session_events": trail,
            "funnel_step_times": funnel.funnel_step_times(events),
        }

    def _of_customers(self, measured: DataFrame, profiles: DataFrame) -> dict[str, DataFrame]:
        ranked = journeys.ranked_sessions(measured, self._hot(measured, journeys.CUSTOMER_KEYS))
        return {
            "customer_journeys": journeys.with_profiles(journeys.journey_metrics(ranked), profiles),
            "customer_journey_sessions": journeys.customer_journey_sessions(ranked),
        }

    def _count_funnel(self) -> None:
        partials = self._table("funnel_partials").whole()
        write_table(funnel.metrics_of_partials(partials), f"{self.silver}.funnel_metrics")
        write_table(funnel.daily_of_partials(partials), f"{self.silver}.funnel_daily")

    # --- what a user calls -------------------------------------------------------------------------

    def publish(self, flat: DataFrame, customers: DataFrame, orders: DataFrame) -> None:
        """Build all tables from flat events."""
        ensure_schema(self.spark, self.silver)
        # Every table is made of them, so they are put together once.
        events = _events(written(_events(flat).select(*EVENT_COLUMNS), "events"))
        for name, rows in self._of_sessions(events).items():
            self._publish(rows, name, "session_id")
        measured = self.spark.table(f"{self.silver}.sessions").drop(PRODUCT_LIST)
        partials = funnel.funnel_partials(self._table("sessions").whole(), BUCKET)
        write_table(partials.repartition(BUCKET), f"{self.silver}.funnel_partials", partition_by=(BUCKET,))
        self._count_funnel()
        self._publish(measured, "customer_sessions", "customer_id")
        self._publish(journeys.customer_profiles(customers, orders), "customer_profiles", "customer_id")
        profiles = self.spark.table(f"{self.silver}.customer_profiles")
        for name, rows in self._of_customers(self.spark.table(f"{self.silver}.customer_sessions"), profiles).items():
            self._publish(rows, name, "customer_id")

    def add(self, flat: DataFrame) -> dict[str, int]:
        """Take in further flat events, of any age; returns how many buckets of sessions and customers were touched.

        An event that is there already counts twice, as it does in a rebuild.
        """
        late = written(_events(flat).select(*EVENT_COLUMNS), "late-events")
        touched = written(late.select("session_id").distinct(), "late-sessions")
        buckets = self._buckets_of(touched)
        if not buckets:
            return {"session_buckets": 0, "customer_buckets": 0}
        held = _among(self.within("session_events", buckets), touched, "left_semi").select(*EVENT_COLUMNS)
        events = _events(written(held.unionByName(late), "late-affected"))
        made = self._of_sessions(events)
        measured = written(made["sessions"], "late-measured")
        for name, rows in {**made, "sessions": measured}.items():
            self._replace(name, "session_id", touched, rows, buckets)
        partials = funnel.funnel_partials(self.within("sessions", buckets), BUCKET)
        self._table("funnel_partials").replace_partitions(partials.repartition(BUCKET), buckets, "late")
        self._count_funnel()

        persons = written(events.select("customer_id").distinct(), "late-customers")
        theirs = self._buckets_of(persons)
        self._replace("customer_sessions", "customer_id", touched, measured.drop(PRODUCT_LIST), theirs)
        mine = _among(self.within("customer_sessions", theirs), persons, "left_semi").drop(BUCKET)
        profiles = self.within("customer_profiles", theirs).drop(BUCKET)
        for name, rows in self._of_customers(mine, profiles).items():
            self._replace(name, "customer_id", persons, rows, theirs)
        return {"session_buckets": len(buckets), "customer_buckets": len(theirs)}


def _by_bucket(rows: DataFrame) -> DataFrame:
    """One file for each bucket and not one for each task and bucket; a large bucket is shared by several tasks."""
    return rows.hint("rebalance", F.col(BUCKET))


def _events(rows: DataFrame) -> DataFrame:
    """Events as flattening gives them, from those of the trail."""
    return rows.select(*EVENT_COLUMNS, *(F.expr(flag_text(kind, "event_type")).alias(name) for name, kind in FLAGS.items()))
