"""Shape of the physical plans: exchanges, joins, scans."""

from __future__ import annotations

import re

import pytest

from cartpath.operators import funnel, journeys, orders, sessions
from cartpath.operators.events import flatten
from cartpath.plans import reports
from cartpath.sources import testtables as given


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Bronze events and silver sessions as Parquet, so that plans start at a scan."""
    base = str(tmp_path_factory.mktemp("plans"))
    given.bronze_events(spark, "/root/testdata/sf0.001").write.parquet(f"{base}/events")
    sessions.sessions(flatten(spark.read.parquet(f"{base}/events"))).write.parquet(f"{base}/sessions")
    return spark.read.parquet(f"{base}/events"), spark.read.parquet(f"{base}/sessions")


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def count(rows, operator: str) -> int:
    return len(re.findall(rf"\b{operator}\b", plan(rows)))


def test_sessions_take_one_exchange(tables):
    assert count(sessions.sessions(flatten(tables[0])), "Exchange hashpartitioning") == 1


def test_sessions_scan_only_the_fields_they_need(tables):
    text = plan(sessions.session_measures(flatten(tables[0])))
    schema = text[text.index("ReadSchema:") :]
    assert "environment" not in schema and "commerce" not in schema and "webPageDetails" not in schema
    assert "quantity" not in schema


def test_unread_distinct_count_costs_no_exchange(tables):
    stages = reports.sessions_by_stage(sessions.session_measures(flatten(tables[0])))
    assert "distinct" not in plan(stages).lower()
    assert "collect_list" not in plan(reports.sessions_by_stage(sessions.sessions(flatten(tables[0]))))


def test_trail_takes_one_exchange_and_one_sort(tables):
    trail = sessions.session_events(flatten(tables[0]))
    assert count(trail, "Exchange") == 1 and count(trail, "Sort") == 1


def test_step_times_take_one_exchange(tables):
    assert count(funnel.funnel_step_times(flatten(tables[0])), "Exchange") == 1


def test_funnel_metrics_have_no_window(tables):
    assert count(funnel.funnel_metrics(tables[1]), "Window") == 0


def test_journeys_reuse_the_exchange_of_the_ranking(tables):
    metrics = journeys.journey_metrics(journeys.ranked_sessions(tables[1]))
    assert count(metrics, "Exchange") == 1 and count(metrics, "Sort") == 1
    assert "Join" not in plan(metrics)


def test_journey_context_needs_no_join(tables):
    context = journeys.customer_journey_sessions(journeys.ranked_sessions(tables[1]))
    assert count(context, "Exchange") == 1 and "Join" not in plan(context)


def test_reports_on_customers_skip_ranking_and_profiles_they_do_not_read(spark, tables):
    folder = "/root/testdata/sf0.001"
    made = journeys.customer_journeys(
        journeys.ranked_sessions(tables[1]), given.customers(spark, folder), given.orders(spark, folder)
    )
    for report in (reports.engagement_segments, reports.engagement_summary):
        assert "Window" not in plan(report(made)) and "Join" not in plan(report(made))


def test_order_lines_are_made_distinct_without_another_exchange(spark):
    folder = "/root/testdata/sf0.001"
    tables = (getattr(given, t)(spark, folder) for t in ("customers", "orders", "order_items", "products", "order_payments"))
    lines = plan(orders.reference_orders(*tables))
    before_join = lines[: lines.index("Join")]
    assert "HashAggregate" in before_join and "Exchange" not in before_join
