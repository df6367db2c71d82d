"""Funnel conversion, time between steps, and the daily trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.functions.measures import mean, percent, seconds_between
from cartpath.functions.stages import (
    CART_ADD,
    PAGE_VIEW,
    PRODUCT_VIEW,
    PURCHASE,
    STAGE_NAMES,
    at_least_stage,
)
from cartpath.operators.skew import HotKeys, ordered_context

# Column of the first time of each timed step, and the event type that stands for it.
STEP_TIMES = {
    "ts_page_view": PAGE_VIEW,
    "ts_product_view": PRODUCT_VIEW,
    "ts_add_to_cart": CART_ADD,
    "ts_purchase": PURCHASE,
}
STEP_GAPS = {
    "seconds_page_to_product_view": ("ts_page_view", "ts_product_view"),
    "seconds_product_view_to_add": ("ts_product_view", "ts_add_to_cart"),
    "seconds_add_to_purchase": ("ts_add_to_cart", "ts_purchase"),
    "seconds_page_view_to_purchase": ("ts_page_view", "ts_purchase"),
}
STEP_AVERAGES = {
    "avg_sec_page_to_product_view": "seconds_page_to_product_view",
    "avg_sec_product_view_to_add": "seconds_product_view_to_add",
    "avg_sec_add_to_purchase": "seconds_add_to_purchase",
    "avg_sec_full_journey": "seconds_page_view_to_purchase",
}


def _reached(stage: int) -> Column:
    return F.count_if(at_least_stage(F.col("max_funnel_stage_reached"), stage))


def _steps(counts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Turn counts in columns ``_total``, ``_1`` … ``_4`` into one row per funnel step with rates."""
    steps = ", ".join(f"{n}L, '{name}', _{n}, {f'_{n - 1}' if n > 1 else 'NULL'}" for n, name in STAGE_NAMES.items())
    unpivoted = counts.select(
        *by,
        "_total",
        F.expr(f"stack({len(STAGE_NAMES)}, {steps}) AS (funnel_step, step_name, sessions_entered, _before)"),
    )
    entered, before = F.col("sessions_entered"), F.col("_before")
    first = F.col("funnel_step") == 1
    return unpivoted.select(
        *by,
        "funnel_step",
        "step_name",
        "sessions_entered",
        percent(entered, F.col("_total")).alias("overall_conversion_rate_pct"),
        F.when(first, 100.0).otherwise(percent(entered, before)).alias("step_conversion_rate_pct"),
        F.when(first, 0.0).otherwise(percent(before - entered, before)).alias("drop_off_rate_pct"),
    )


PARTIALS = ("_total", *(f"_{n}" for n in STAGE_NAMES))


def funnel_partials(sessions: DataFrame, *by: str) -> DataFrame:
    """Sessions and those that reached each step, per session date and the given columns.

    These counts add up, so that a part of the sessions can be counted anew without the others.
    """
    return sessions.groupBy(*by, F.to_date("session_start").alias("session_date")).agg(
        F.count("*").alias("_total"), *(_reached(n).alias(f"_{n}") for n in STAGE_NAMES)
    )


def metrics_of_partials(partials: DataFrame) -> DataFrame:
    """:func:`funnel_metrics` from partial counts."""
    return _steps(partials.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in PARTIALS)), ())


def daily_of_partials(partials: DataFrame) -> DataFrame:
    """:func:`funnel_daily` from partial counts."""
    daily = partials.groupBy("session_date").agg(
        F.sum("_total").alias("total_sessions"),
        *(F.sum(f"_{n}").alias(name) for n, name in {2: "product_views", 3: "add_to_carts", 4: "purchases"}.items()),
    )
    return daily.select("*", percent(F.col("purchases"), F.col("total_sessions")).alias("daily_conversion_rate_pct"))


def funnel_metrics(sessions: DataFrame) -> DataFrame:
    """Four rows: sessions that reached each step, with overall, step and drop-off rates.

    The first step has step rate 100 and drop-off 0 by convention. A rate over no sessions is NULL.
    The step before is a column of the same one-row aggregate, so no window and no collect is
    needed.
    """
    counts = sessions.agg(F.count("*").alias("_total"), *(_reached(n).alias(f"_{n}") for n in STAGE_NAMES))
    return _steps(counts, ())


def strict_funnel(flat: DataFrame, within: int | None = None, hot: HotKeys | None = None) -> DataFrame:
    """:func:`funnel_metrics` where a step only counts after the one before it, within ``within`` seconds of the first.

    A session reaches step k if it has events of steps 1 to k in this order (by time, then event id), the
    last at most ``within`` seconds after the first. Of all such chains that end at an event the one with
    the latest first event is the shortest; where it begins is the highest beginning among the events
    of the step before, so a running maximum for each step finds it on one sort. Events without a time
    are in no chain. ``hot`` holds keys by session_id.
    """
    rows = flat.select("session_id", "event_id", "event_timestamp", "event_type")
    began = F.when(F.col("event_type") == PAGE_VIEW, F.unix_micros("event_timestamp"))
    rows = rows.withColumn("_from_1", began)
    for step, kind in enumerate((PRODUCT_VIEW, CART_ADD, PURCHASE), start=2):
        rows = ordered_context(
            rows,
            ("session_id",),
            ("event_timestamp", "event_id"),
            number="_place",
            highest={"_begun": F.col(f"_from_{step - 1}")},
            hot=hot,
            ties=True,
        ).drop("_place")
        in_time = F.col("event_timestamp").isNotNull()
        if within is not None:
            in_time = in_time & (F.unix_micros("event_timestamp") - F.col("_begun") <= within * 1_000_000)
        rows = rows.withColumn(f"_from_{step}", F.when((F.col("event_type") == kind) & in_time, F.col("_begun"))).drop("_begun")
    reached = rows.groupBy("session_id").agg(*(F.max(f"_from_{n}").isNotNull().alias(f"_{n}") for n in STAGE_NAMES))
    counts = reached.agg(F.count("*").alias("_total"), *(F.count_if(F.col(f"_{n}")).alias(f"_{n}") for n in STAGE_NAMES))
    return _steps(counts, ())


def funnel_by_category(flat: DataFrame, products: DataFrame) -> DataFrame:
    """The funnel per product category, over the sessions that touched a product of it.

    A session's depth within a category is the deepest stage of its events on such products. ``flat``
    has session_id, customer_id, product_id and funnel_stage: those of
    :func:`cartpath.operators.events.flatten_items` for whole carts, those of
    :func:`~cartpath.operators.events.flatten` for the first item of each event. ``products`` has
    product_id and product_category_name; a product that it does not know, or without category,
    counts as ``unknown``.
    """
    # One row per session and product before the join, so a hot product only joins once a session.
    touched = (
        flat.where(F.col("product_id").isNotNull())
        .groupBy("session_id", "customer_id", "product_id")
        .agg(F.max("funnel_stage").alias("_stage"))
    )
    categories = products.groupBy("product_id").agg(F.min("product_category_name").alias("product_category_name"))
    counts = (
        touched.join(categories, "product_id", "left")
        .withColumn("product_category_name", F.coalesce("product_category_name", F.lit("unknown")))
        .groupBy("product_category_name", "session_id", "customer_id")
        .agg(F.max("_stage").alias("max_funnel_stage_reached"))
        .groupBy("product_category_name")
        .agg(F.count("*").alias("_total"), *(_reached(n).alias(f"_{n}") for n in STAGE_NAMES))
    )
    return _steps(counts, ("product_category_name",))


def funnel_step_times(session_events: DataFrame) -> DataFrame:
    """First time of each step per session, and whole seconds between the steps.

    Each step's first time is taken by itself, so a gap can be negative; it is NULL unless both
    steps occurred. One aggregate with conditional minima gives all four times.
    """
    first_times = session_events.groupBy("session_id").agg(
        *(
            F.min(F.when(F.col("event_type") == event_type, F.col("event_timestamp"))).alias(name)
            for name, event_type in STEP_TIMES.items()
        )
    )
    return first_times.select(
        "*", *(seconds_between(F.col(a), F.col(b)).alias(name) for name, (a, b) in STEP_GAPS.items())
    )


def step_time_averages(step_times: DataFrame) -> DataFrame:
    """Average seconds of each gap, over the sessions that have it, and the purchases timed."""
    return step_times.agg(*_averages(), F.count("ts_purchase").alias("converting_sessions_with_timestamps"))


def step_time_summary(step_times: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """The averages with median and 90th percentile of the full journey.

    The percentiles are approximate to one in ``accuracy`` ranks; the sketches that travel to the
    last task grow with it.
    """
    journey = F.col("seconds_page_view_to_purchase")
    return step_times.agg(
        *_averages(),
        F.percentile_approx(journey, 0.5, accuracy).alias("median_sec_full_journey"),
        F.percentile_approx(journey, 0.9, accuracy).alias("p90_sec_full_journey"),
        F.count("ts_purchase").alias("converting_sessions_with_timestamps"),
    )


def step_time_sketches(step_times: DataFrame, k: int = 1024) -> DataFrame:
    """Per day of the first page view a sketch of the full journey's seconds, with the number of journeys.

    Sketches of any days merge, so a table of them answers for every range of days without the sessions.
    The rank of a quantile is off by about 2.3 / k ** 0.9 of all journeys at most, and it is exact for up to
    k of them.
    """
    journey = F.col("seconds_page_view_to_purchase")
    timed = step_times.where(journey.isNotNull())
    return timed.groupBy(F.to_date("ts_page_view").alias("session_date")).agg(
        F.count("*").alias("journeys"), F.kll_sketch_agg_bigint(journey, k).alias("sketch")
    )


def sketched_quantiles(sketches: DataFrame, by: dict[str, Column] | None = None) -> DataFrame:
    """Journeys, median and 90th percentile from daily sketches, over all of them or by some expressions of the day."""
    merged = sketches.groupBy(*(value.alias(name) for name, value in (by or {}).items())).agg(
        F.sum("journeys").alias("journeys"), F.kll_merge_agg_bigint("sketch").alias("_sketch")
    )
    quantiles = {"median_sec_full_journey": 0.5, "p90_sec_full_journey": 0.9}
    return merged.select(
        *(by or {}),
        "journeys",
        *(F.kll_sketch_get_quantile_bigint("_sketch", F.lit(rank)).alias(name) for name, rank in quantiles.items()),
    ).where("journeys > 0")


def _averages() -> list[Column]:
    return [mean(F.sum(gap), F.count(gap), 1).alias(name) for name, gap in STEP_AVERAGES.items()]


def funnel_daily(sessions: DataFrame) -> DataFrame:
    """Per session date: sessions, those that reached each later stage, and the conversion rate."""
    daily = sessions.groupBy(F.to_date("session_start").alias("session_date")).agg(
        F.count("*").alias("total_sessions"),
        _reached(2).alias("product_views"),
        _reached(3).alias("add_to_carts"),
        _reached(4).alias("purchases"),
    )
    rate = percent(F.col("purchases"), F.col("total_sessions")).alias("daily_conversion_rate_pct")
    return daily.select("*", rate).orderBy("session_date")
