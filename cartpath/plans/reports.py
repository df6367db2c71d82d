"""The twelve reports over the event, session, funnel and journey tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartpath.functions.measures import amount, mean, percent
from cartpath.functions.stages import engagement_segment, stage_number
from cartpath.operators.funnel import step_time_averages, step_time_summary

__all__ = [
    "conversion_sessions",
    "daily_trend",
    "engagement_segments",
    "engagement_summary",
    "event_transitions",
    "events_by_type",
    "first_touch_distribution",
    "funnel_report",
    "session_summary",
    "sessions_by_stage",
    "step_time_averages",
    "step_time_summary",
]


def _share(counts: DataFrame, count: str, name: str) -> DataFrame:
    """Add each row's share in percent. The window is over groups already counted, so a few rows."""
    return counts.withColumn(name, percent(F.col(count), F.sum(count).over(Window.partitionBy())))


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("eventType").agg(F.count("*").alias("event_count")).orderBy(F.desc("event_count"))


def session_summary(sessions: DataFrame) -> DataFrame:
    n = F.count("*")
    converting = F.count_if("converted")
    return sessions.agg(
        n.alias("total_sessions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        converting.alias("converting_sessions"),
        mean(F.sum("session_duration_seconds"), F.count("session_duration_seconds"), 1).alias(
            "avg_session_duration_sec"
        ),
        mean(F.sum("total_events"), n, 1).alias("avg_events_per_session"),
        mean(F.sum("unique_products_viewed"), n, 2).alias("avg_products_viewed"),
        percent(converting, n).alias("session_conversion_rate_pct"),
    )


def sessions_by_stage(sessions: DataFrame) -> DataFrame:
    counts = sessions.groupBy("funnel_stage_name").agg(F.count("*").alias("session_count"))
    return _share(counts, "session_count", "pct_of_sessions").orderBy(
        stage_number("funnel_stage_name").desc()
    )


def event_transitions(session_events: DataFrame) -> DataFrame:
    return (
        session_events.where(F.col("prev_event_type").isNotNull())
        .groupBy("prev_event_type", F.col("event_type").alias("next_event_type"))
        .agg(F.count("*").alias("transition_count"))
        .orderBy(F.desc("transition_count"))
    )


def funnel_report(funnel_metrics: DataFrame) -> DataFrame:
    return funnel_metrics.orderBy("funnel_step")


def daily_trend(funnel_daily: DataFrame) -> DataFrame:
    return funnel_daily.select(
        "session_date", "total_sessions", "purchases", "daily_conversion_rate_pct"
    ).orderBy("session_date")


def engagement_summary(journeys: DataFrame) -> DataFrame:
    """Person-level totals. A journey table has one row per customer, so counting ids is counting
    distinct ids."""
    n, customers = F.count("*"), F.count("customer_id")
    purchasers = F.count_if("ever_converted")
    return journeys.agg(
        customers.alias("total_customers"),
        mean(F.sum("total_sessions"), n, 2).alias("avg_sessions_per_customer"),
        mean(F.sum("total_events"), n, 1).alias("avg_events_per_customer"),
        mean(F.sum("total_unique_products_viewed"), n, 2).alias("avg_products_viewed"),
        purchasers.alias("customers_who_purchased"),
        percent(purchasers, customers).alias("customer_conversion_rate_pct"),
        mean(F.sum("customer_lifetime_days"), F.count("customer_lifetime_days"), 1).alias(
            "avg_customer_lifetime_days"
        ),
    )


def conversion_sessions(journeys: DataFrame) -> DataFrame:
    """Converting customers by the session of their first conversion.

    The share runs over one row per distinct rank, and n distinct ranks need n²/2 sessions.
    """
    counts = (
        journeys.where(F.col("sessions_before_first_conversion").isNotNull())
        .groupBy("sessions_before_first_conversion")
        .agg(F.count("*").alias("customer_count"))
    )
    return _share(counts, "customer_count", "pct_of_converters").orderBy("sessions_before_first_conversion")


def first_touch_distribution(journeys: DataFrame) -> DataFrame:
    converted = F.count_if("ever_converted")
    return (
        journeys.where(F.col("first_touch_stage").isNotNull())
        .groupBy("first_touch_stage")
        .agg(
            F.count("*").alias("customer_count"),
            converted.alias("converted_customers"),
            percent(converted, F.count("*")).alias("conversion_rate_from_this_first_touch"),
        )
        .orderBy(F.desc("customer_count"))
    )


def engagement_segments(journeys: DataFrame) -> DataFrame:
    segment = engagement_segment(F.col("total_sessions"), F.col("ever_converted"))
    revenue = F.avg(amount(F.col("total_behavioral_revenue")))
    return (
        journeys.groupBy(segment.alias("engagement_segment"))
        .agg(
            F.count("*").alias("customer_count"),
            mean(F.sum("total_sessions"), F.count("total_sessions"), 2).alias("avg_sessions"),
            mean(F.sum("total_events"), F.count("total_events"), 1).alias("avg_events"),
            F.round(revenue, 2).cast("double").alias("avg_revenue"),
        )
        .orderBy(F.desc("customer_count"))
    )
