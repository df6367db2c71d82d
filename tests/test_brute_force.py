"""Sessions and journeys against plain Python, on events with NULL keys, equal times and copies."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest
from sample import flat_events
from test_skew import skewed_events

from cartpath.operators import funnel, journeys, sessions, skew

NAMES = {0: "unknown", 1: "page_view", 2: "product_view", 3: "add_to_cart", 4: "purchase"}
LOWEST = dt.datetime.min


def grouped(rows, *keys):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row)
    return groups


def whole_seconds(moment):
    return int(moment.timestamp() // 1)


def python_sessions(events):
    made = {}
    for key, rows in grouped(events, "session_id", "customer_id").items():
        rows.sort(key=lambda r: (r.event_timestamp or LOWEST, r.event_id))
        times = [r.event_timestamp for r in rows if r.event_timestamp]
        buys = [r for r in rows if r.is_purchase]
        stage = max(r.funnel_stage for r in rows)
        made[key] = {
            "session_start": min(times, default=None),
            "session_end": max(times, default=None),
            "total_events": len(rows),
            "purchases": len(buys),
            "products_interacted": [r.product_id for r in rows if r.product_id],
            "unique_products_viewed": len({r.product_id for r in rows if r.product_id}),
            "session_revenue": round(sum(r.product_price or 0 for r in buys), 2) if buys else None,
            "session_duration_seconds": whole_seconds(max(times)) - whole_seconds(min(times)) if times else None,
            "funnel_stage_name": NAMES[stage],
        }
    return made


def python_journeys(made):
    by_customer = defaultdict(list)
    for (session, customer), row in made.items():
        by_customer[customer].append({"session_id": session, **row})
    journeys_made = {}
    for customer, rows in by_customer.items():
        rows.sort(key=lambda r: (r["session_start"] or LOWEST, r["session_id"] is not None, r["session_id"] or ""))
        converting = [i + 1 for i, r in enumerate(rows) if r["purchases"]]
        days = [r["session_start"] and r["session_start"].date() for r in rows]
        gaps = [(b - a).days if a and b else 0 for a, b in zip(days, days[1:], strict=False)]
        named = sum(r["session_id"] is not None for r in rows)
        journeys_made[customer] = {
            "total_sessions": named,
            "total_events": sum(r["total_events"] for r in rows),
            "avg_days_between_sessions": round(sum(gaps) / len(rows), 9),
            "total_session_seconds": sum(r["session_duration_seconds"] or 0 for r in rows),
            "converting_sessions": len(converting),
            "first_session_id": customer and rows[0]["session_id"],
            "last_touch_stage": customer and rows[-1]["funnel_stage_name"],
            "sessions_before_first_conversion": min(converting, default=None) if customer else None,
        }
    return journeys_made


@pytest.fixture(scope="module")
def events(spark):
    made = skewed_events(seed=11, n=500)
    return flat_events(spark, made + made[:40]).cache()


@pytest.mark.parametrize("limit", [None, 15])
def test_sessions_and_journeys(events, limit):
    hot_customers = limit and skew.hot_keys(events, journeys.CUSTOMER_KEYS, limit)
    spark_sessions = sessions.sessions(events)
    expected = python_sessions(events.collect())
    found = {(r.session_id, r.customer_id): r.asDict() for r in spark_sessions.collect()}
    assert found.keys() == expected.keys()
    for key, row in expected.items():
        assert {name: found[key][name] for name in row} == row

    metrics = journeys.journey_metrics(journeys.ranked_sessions(spark_sessions, hot_customers))
    expected = python_journeys(python_sessions(events.collect()))
    found = {r.customer_id: r.asDict() for r in metrics.collect()}
    assert found.keys() == expected.keys()
    for customer, row in expected.items():
        found[customer]["avg_days_between_sessions"] = round(found[customer]["avg_days_between_sessions"], 9)
        assert {name: found[customer][name] for name in row} == row


def test_funnel_counts(events):
    stages = [max(r.funnel_stage for r in rows) for rows in grouped(events.collect(), "session_id", "customer_id").values()]
    steps = funnel.funnel_metrics(sessions.session_measures(events)).orderBy("funnel_step").collect()
    assert [r.sessions_entered for r in steps] == [sum(s >= n for s in stages) for n in (1, 2, 3, 4)]
