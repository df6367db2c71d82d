"""Customer journeys: sessions in order per customer, attribution, conversion and order history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.functions.measures import mean, percent, total_amount
from cartpath.functions.stages import stage_name
from cartpath.operators.sessions import PRODUCT_LIST
from cartpath.operators.skew import HotKeys, ordered_context

CUSTOMER_KEYS = ("customer_id",)
DELIVERED = "delivered"

# Columns of the first and of the last session in a journey row, and the session column of each.
FIRST_TOUCH = {
    "first_session_id": "session_id",
    "first_session_start": "session_start",
    "first_touch_stage": "funnel_stage_name",
    "first_session_converted": "converted",
    "first_session_products_viewed": "unique_products_viewed",
    "first_session_duration_sec": "session_duration_seconds",
}
LAST_TOUCH = {
    "last_session_id": "session_id",
    "last_session_start": "session_start",
    "last_touch_stage": "funnel_stage_name",
    "last_session_converted": "converted",
    "last_session_revenue": "session_revenue",
}

# The columns of the published journey table.
JOURNEY_COLUMNS = (
    "customer_id",
    "total_sessions",
    "total_events",
    "total_product_views",
    "total_add_to_cart_events",
    "total_purchases",
    "total_page_views",
    "first_seen_at",
    "last_seen_at",
    "total_session_seconds",
    "avg_days_between_sessions",
    "total_unique_products_viewed",
    "total_behavioral_revenue",
    "converting_sessions",
    "deepest_funnel_stage_ever",
    "customer_lifetime_days",
    "ever_converted",
    "session_conversion_rate_pct",
    "avg_session_duration_sec",
    "deepest_funnel_stage_name",
    *FIRST_TOUCH,
    *LAST_TOUCH,
    "sessions_before_first_conversion",
    "actual_order_count",
    "first_order_at",
    "last_order_at",
    "delivered_orders",
    "customer_city",
    "customer_state",
)


def ranked_sessions(sessions: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Sessions with their rank in the customer's journey and the days since the one before.

    Sessions are ordered by start, then session id. The last session is the one whose rank is the
    number of sessions, so one sort gives both ends. ``hot`` holds keys by :data:`CUSTOMER_KEYS`;
    a count of events per customer is an upper bound of its sessions and finds them as well.
    """
    ranked = ordered_context(
        sessions.drop(PRODUCT_LIST),
        CUSTOMER_KEYS,
        ("session_start", "session_id"),
        number="session_rank",
        previous={"_prev_start": "session_start"},
        totals={
            "_journey_rows": F.count(F.lit(1)),
            "_journey_sessions": F.count("session_id"),
            "_journey_purchases": F.sum("purchases"),
            "_journey_stage": F.max("max_funnel_stage_reached"),
        },
        hot=hot,
    )
    return ranked.withColumns(
        {
            "is_first_session": F.col("session_rank") == 1,
            "is_last_session": F.col("session_rank") == F.col("_journey_rows"),
            "days_since_prev_session": F.datediff(F.to_date("session_start"), F.to_date("_prev_start")),
        }
    )


def _packed(columns: dict[str, str]) -> Column:
    return F.struct(*(F.col(source).alias(name) for name, source in columns.items()))


def first_last_touch(sessions: DataFrame) -> DataFrame:
    """First and last session of each customer in one aggregate that combines before its exchange."""
    position = F.struct("session_start", "session_id")
    touches = sessions.groupBy("customer_id").agg(
        F.min_by(_packed(FIRST_TOUCH), position).alias("_first"),
        F.max_by(_packed(LAST_TOUCH), position).alias("_last"),
    )
    return touches.select("customer_id", "_first.*", "_last.*")


def first_conversion(ranked: DataFrame) -> DataFrame:
    """Rank of the first converting session per customer: 1 for a purchase on the first visit."""
    return (
        ranked.where("converted")
        .groupBy("customer_id")
        .agg(F.min("session_rank").alias("sessions_before_first_conversion"))
    )


def customer_orders(orders: DataFrame) -> DataFrame:
    """Orders per customer id: number, first and last time, and distinct delivered orders."""
    delivered = F.when(F.col("order_status") == DELIVERED, F.col("order_id"))
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("actual_order_count"),
        F.min("order_purchase_timestamp").alias("first_order_at"),
        F.max("order_purchase_timestamp").alias("last_order_at"),
        F.count_distinct(delivered).alias("delivered_orders"),
    )


def customer_profiles(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Order history and place of each person, keyed by the id that events carry.

    Orders hold a ``customer_id`` and events a ``customer_unique_id``, which may stand for several
    customer ids. Orders are aggregated per customer id first, so the bridge join meets each id
    once; then per person. City and state are those of the customer id with the latest order, the
    smallest id on a tie. An order whose customer is not in ``customers`` counts for its own id.
    An order id belongs to one customer id, so its distinct counts add up. Of several rows for one
    customer id the smallest counts.
    """
    history = customer_orders(orders).withColumnRenamed("customer_id", "_ordering_id")
    person = F.struct("customer_unique_id", "customer_city", "customer_state")
    bridged = (
        customers.groupBy("customer_id")
        .agg(F.min(person).alias("_row"))
        .select("customer_id", "_row.*")
        .join(history, F.col("customer_id") == F.col("_ordering_id"), "full")
        .withColumns(
            {
                "_id": F.coalesce("customer_id", "_ordering_id"),
                "_person": F.coalesce("customer_unique_id", "customer_id", "_ordering_id"),
            }
        )
    )
    # Latest order first: its time counts down, and an id without orders comes last.
    recency = F.struct(F.coalesce(-F.unix_micros(F.col("last_order_at").cast("timestamp")), F.lit(2**63 - 1)), "_id")
    place = F.when(F.col("customer_id").isNotNull(), F.struct("customer_city", "customer_state"))
    profiles = bridged.groupBy("_person").agg(
        F.sum("actual_order_count").alias("actual_order_count"),
        F.min("first_order_at").alias("first_order_at"),
        F.max("last_order_at").alias("last_order_at"),
        F.sum("delivered_orders").alias("delivered_orders"),
        F.min_by(place, F.when(F.col("customer_id").isNotNull(), recency)).alias("_place"),
    )
    return profiles.select(
        F.col("_person").alias("customer_id"),
        "actual_order_count",
        "first_order_at",
        "last_order_at",
        "delivered_orders",
        "_place.customer_city",
        "_place.customer_state",
    )


def journey_metrics(ranked: DataFrame) -> DataFrame:
    """One row per customer from ranked sessions: totals, rates, attribution, first conversion.

    First and last session and the first conversion come out of the same aggregate as the totals,
    on the partitioning the ranking left behind. For sessions without a customer there is one row
    with totals only.
    """
    known = F.col("customer_id").isNotNull()
    totals = ranked.groupBy("customer_id").agg(
        F.count("session_id").alias("total_sessions"),
        F.sum("total_events").alias("total_events"),
        F.sum("product_views").alias("total_product_views"),
        F.sum("add_to_cart_events").alias("total_add_to_cart_events"),
        F.sum("purchases").alias("total_purchases"),
        F.sum("page_views").alias("total_page_views"),
        F.min("session_start").alias("first_seen_at"),
        F.max("session_end").alias("last_seen_at"),
        F.sum(F.coalesce("session_duration_seconds", F.lit(0))).alias("total_session_seconds"),
        # The first session counts as a gap of 0 days.
        F.avg(F.coalesce("days_since_prev_session", F.lit(0))).alias("avg_days_between_sessions"),
        F.sum("unique_products_viewed").alias("total_unique_products_viewed"),
        total_amount(F.col("session_revenue")).alias("total_behavioral_revenue"),
        F.count_if("converted").alias("converting_sessions"),
        F.max("max_funnel_stage_reached").alias("deepest_funnel_stage_ever"),
        F.min_by(_packed(FIRST_TOUCH), "session_rank").alias("_first"),
        F.max_by(_packed(LAST_TOUCH), "session_rank").alias("_last"),
        F.min(F.when(F.col("converted"), F.col("session_rank"))).alias("_first_conversion"),
    )
    return totals.select(
        "*",
        F.datediff(F.to_date("last_seen_at"), F.to_date("first_seen_at")).alias("customer_lifetime_days"),
        (F.col("total_purchases") > 0).alias("ever_converted"),
        percent(F.col("converting_sessions"), F.col("total_sessions")).alias("session_conversion_rate_pct"),
        mean(F.col("total_session_seconds"), F.col("total_sessions"), 1).alias("avg_session_duration_sec"),
        stage_name("deepest_funnel_stage_ever").alias("deepest_funnel_stage_name"),
        *(F.when(known, F.col(f"_first.{name}")).alias(name) for name in FIRST_TOUCH),
        *(F.when(known, F.col(f"_last.{name}")).alias(name) for name in LAST_TOUCH),
        F.when(known, F.col("_first_conversion")).alias("sessions_before_first_conversion"),
    ).drop("_first", "_last", "_first_conversion")


def customer_journeys(ranked: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer with sessions: 38 columns of journey, orders and place.

    Customers without any session do not appear.
    """
    return with_profiles(journey_metrics(ranked), customer_profiles(customers, orders))


def with_profiles(metrics: DataFrame, profiles: DataFrame) -> DataFrame:
    """Journey rows completed by the order history and place of each person."""
    return metrics.join(profiles, "customer_id", "left").select(*JOURNEY_COLUMNS)


def customer_journey_sessions(ranked: DataFrame) -> DataFrame:
    """Each session with its rank and with totals of the customer's journey.

    The totals come from the ranking itself, so no join back is needed; they are NULL for sessions
    without a customer.
    """
    known = F.col("customer_id").isNotNull()
    return ranked.select(
        "session_id",
        "customer_id",
        "session_rank",
        "session_start",
        "session_end",
        "session_duration_seconds",
        "total_events",
        "product_views",
        "add_to_cart_events",
        "purchases",
        "converted",
        "funnel_stage_name",
        "session_revenue",
        "is_first_session",
        "is_last_session",
        "days_since_prev_session",
        F.when(known, F.col("_journey_sessions")).alias("customer_total_sessions"),
        F.when(known, F.col("_journey_purchases") > 0).alias("customer_ever_converted"),
        F.when(known, stage_name("_journey_stage")).alias("customer_deepest_stage"),
    )
