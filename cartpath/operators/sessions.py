"""Session summaries and the ordered trail of events within each session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.functions.measures import seconds_between, total_amount
from cartpath.functions.stages import stage_name
from cartpath.operators.skew import HotKeys, ordered_context

SESSION_KEYS = ("session_id", "customer_id")
TRAIL_KEYS = ("session_id",)
PRODUCT_LIST = "products_interacted"

# The columns of the published session table.
SESSION_COLUMNS = (
    "session_id",
    "customer_id",
    "session_start",
    "session_end",
    "total_events",
    "page_views",
    "product_views",
    "add_to_cart_events",
    "remove_from_cart_events",
    "purchases",
    "unique_products_viewed",
    "max_funnel_stage_reached",
    PRODUCT_LIST,
    "session_revenue",
    "session_duration_seconds",
    "converted",
    "funnel_stage_name",
)


def _measures() -> list[Column]:
    """Aggregates of a session that combine before the exchange."""
    return [
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count("event_id").alias("total_events"),
        F.sum("is_page_view").alias("page_views"),
        F.sum("is_product_view").alias("product_views"),
        F.sum("is_add_to_cart").alias("add_to_cart_events"),
        F.sum("is_remove_from_cart").alias("remove_from_cart_events"),
        F.sum("is_purchase").alias("purchases"),
        F.max("funnel_stage").alias("max_funnel_stage_reached"),
        # NULL, not 0, for a session without a purchase; a purchase without a price counts as 0.
        total_amount(F.when(F.col("is_purchase") == 1, F.coalesce("product_price", F.lit(0.0)))).alias(
            "session_revenue"
        ),
    ]


def _described(measured: DataFrame) -> DataFrame:
    return measured.withColumns(
        {
            "session_duration_seconds": seconds_between(F.col("session_start"), F.col("session_end")),
            "converted": F.col("purchases") > 0,
            "funnel_stage_name": stage_name("max_funnel_stage_reached"),
        }
    )


def session_measures(flat: DataFrame) -> DataFrame:
    """One row per (session, customer) without the list of products.

    Sessions of any size are safe here: all measures combine before their exchange, and the
    distinct count first spreads over the products. It is pruned away, with its exchange, where it
    is not read.
    """
    measured = flat.groupBy(*SESSION_KEYS).agg(
        *_measures(), F.count_distinct("product_id").alias("unique_products_viewed")
    )
    return _described(measured).select(*(c for c in SESSION_COLUMNS if c != PRODUCT_LIST))


def sessions(flat: DataFrame) -> DataFrame:
    """One row per (session, customer), from flat events.

    The distinct products are counted from the collected list, so one exchange serves everything.
    ``products_interacted`` is the whole list for every session, so a session has to fit into one
    row; where some do not, :func:`session_measures` and :func:`session_products` give the same
    without a cell that grows.
    """
    touched = F.when(
        F.col("product_id").isNotNull(), F.struct("event_timestamp", "event_id", "product_id")
    )
    listed = flat.groupBy(*SESSION_KEYS).agg(
        *_measures(), F.sort_array(F.collect_list(touched))["product_id"].alias(PRODUCT_LIST)
    )
    distinct = F.size(F.array_distinct(PRODUCT_LIST)).cast("bigint")
    return _described(listed.withColumn("unique_products_viewed", distinct)).select(*SESSION_COLUMNS)


def session_products(flat: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The products of every session as rows: session, customer, position from 1 in the list, product.

    Sessions of any size are safe here; ``hot`` holds keys by :data:`SESSION_KEYS`. Copies of one
    event have a place each.
    """
    touched = flat.where(F.col("product_id").isNotNull())
    placed = ordered_context(
        touched.select(*SESSION_KEYS, "event_timestamp", "event_id", "product_id"),
        SESSION_KEYS,
        ("event_timestamp", "event_id", "product_id"),
        number="position",
        hot=hot,
        ties=True,
    )
    return placed.select(*SESSION_KEYS, "position", "product_id")


def session_events(flat: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The ordered trail: each event with its place in the session and the event before it.

    Events are ordered by time, then event id. The trail runs over the session id alone, also
    where two customers share a session. ``hot`` holds keys by :data:`TRAIL_KEYS`.
    """
    kept = flat.select(
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
    trail = ordered_context(
        kept,
        TRAIL_KEYS,
        ("event_timestamp", "event_id"),
        number="event_sequence_num",
        previous={"prev_event_type": "event_type", "_prev_timestamp": "event_timestamp"},
        hot=hot,
        ties=True,
    )
    return trail.select(
        "session_id",
        "customer_id",
        "event_sequence_num",
        "event_id",
        "event_timestamp",
        "event_type",
        "prev_event_type",
        seconds_between(F.col("_prev_timestamp"), F.col("event_timestamp")).alias("seconds_since_prev_event"),
        "product_id",
        "product_price",
        "page_url",
        "funnel_stage",
        "_ingested_at",
    )
