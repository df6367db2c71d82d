"""Hot groups: the chunked way must give what the plain window and brute force give."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from sample import event, flat_events

from cartpath.operators import journeys, orders, sessions, skew

KINDS = ["page", "view", "add", "remove", "buy"]


def skewed_events(seed=3, n=600) -> list[dict]:
    """A third of the events in one session, a third without a session, many equal times."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        session = rng.choice(["hot", None, f"s{rng.randrange(60)}"])
        customer = rng.choice(["bot", None, f"c{rng.randrange(20)}"])
        time = f"{rng.randint(1, 28):02d}T{rng.randrange(3):02d}:00:{rng.randrange(4):02d}"
        other = {"timestamp": None} if rng.random() < 0.05 else {}
        items = [(f"p{rng.randrange(9)}", rng.randrange(1000) / 100)] if rng.random() < 0.8 else []
        made.append(event(f"e{i:04d}", time, rng.choice(KINDS), session, customer, items, **other))
    return made


@pytest.fixture(scope="module")
def flat(spark):
    return flat_events(spark, skewed_events()).cache()


def texts(rows):
    return sorted(map(str, rows.drop("_ingested_at").collect()))


def test_hot_keys_are_those_over_the_limit(flat):
    hot = skew.hot_keys(flat, ["session_id"], 100)
    ordinary, oversized = skew.split_hot(flat, ["session_id"], hot)
    assert {r.session_id for r in oversized.select("session_id").distinct().collect()} == {"hot", None}
    assert ordinary.where("session_id IS NULL OR session_id = 'hot'").count() == 0
    assert ordinary.count() + oversized.count() == flat.count()
    assert hot.few and hot.chunks >= 2
    assert skew.hot_keys(flat, ["session_id"], 600) is None
    assert skew.within_limit(flat, 600) and not skew.within_limit(flat, 599)


def test_trail_of_hot_sessions(flat):
    plain = sessions.session_events(flat)
    hot = skew.hot_keys(flat, sessions.TRAIL_KEYS, 50)
    chunked = sessions.session_events(flat, hot)
    assert texts(chunked) == texts(plain)
    assert chunked.dtypes == plain.dtypes


def test_trail_equals_brute_force(flat):
    chunked = sessions.session_events(flat, skew.hot_keys(flat, sessions.TRAIL_KEYS, 30)).collect()
    groups = {}
    for row in flat.collect():
        groups.setdefault(row.session_id, []).append(row)
    expected = {}
    for rows in groups.values():
        rows.sort(key=lambda r: (r.event_timestamp is not None, str(r.event_timestamp), r.event_id))
        for i, row in enumerate(rows):
            expected[row.event_id] = (i + 1, rows[i - 1].event_type if i else None)
    assert {r.event_id: (r.event_sequence_num, r.prev_event_type) for r in chunked} == expected


def test_many_hot_keys_are_joined_without_broadcast(flat, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", 1)
    hot = skew.hot_keys(flat, sessions.TRAIL_KEYS, 50)
    assert not hot.few
    assert texts(sessions.session_events(flat, hot)) == texts(sessions.session_events(flat))


@pytest.mark.parametrize("limit", [10_000, 20])
def test_products_of_sessions_as_rows(flat, limit):
    """The list of every session, of whatever size, and the same as rows."""
    listed = {(r.session_id, r.customer_id): r.products_interacted for r in sessions.sessions(flat).collect()}
    hot = skew.hot_keys(flat, sessions.SESSION_KEYS, limit)
    assert (hot is None) == (limit == 10_000)
    rows = sessions.session_products(flat, hot)
    assert dict(rows.dtypes)["position"] == "bigint"
    as_rows = {}
    for row in rows.orderBy("position").collect():
        as_rows.setdefault((row.session_id, row.customer_id), []).append(row.product_id)
        assert row.position == len(as_rows[row.session_id, row.customer_id])
    assert {key: as_rows.get(key, []) for key in listed} == listed


def test_null_in_either_key_is_not_mixed_up(spark):
    """A digest skips NULL, so the hot session (x, NULL) has the digest of (NULL, x)."""
    made = [event(f"e{i}", f"01T10:00:{i:02d}", "view", "x", None, [("p", 1.0)]) for i in range(9)]
    rows = flat_events(spark, [*made, event("other", "01T10:00:00", "view", None, "x", [("q", 1.0)])])
    hot = skew.hot_keys(rows, sessions.SESSION_KEYS, 5)
    assert texts(sessions.session_products(rows, hot)) == texts(sessions.session_products(rows))
    assert all(r.products_interacted for r in sessions.sessions(rows).collect())


def test_journeys_of_hot_customers(spark, flat):
    made = sessions.session_measures(flat)
    plain = journeys.ranked_sessions(made)
    # Bounds from events find a superset of the hot customers; the result is the same.
    split = journeys.ranked_sessions(made, skew.hot_keys(flat, journeys.CUSTOMER_KEYS, 25))
    assert split.dtypes == plain.dtypes
    assert texts(split) == texts(plain)
    assert texts(journeys.journey_metrics(split)) == texts(journeys.journey_metrics(plain))
    assert texts(journeys.customer_journey_sessions(split)) == texts(journeys.customer_journey_sessions(plain))


def test_copies_of_one_event_are_cut_into_chunks(spark):
    made = [event("copy", "01T10:00:00", "view")] * 80 + [event(f"e{i}", f"01T09:00:{i:02d}", "page") for i in range(9)]
    rows = flat_events(spark, made)
    hot = skew.hot_keys(rows, sessions.TRAIL_KEYS, 10)
    trail = sessions.session_events(rows, hot)
    assert texts(trail) == texts(sessions.session_events(rows))
    tied = skew.ordered_context(
        rows.select("session_id", "event_id"), ["session_id"], ["event_id"], number="n", hot=hot, ties=True
    )
    assert sorted(r.n for r in tied.collect()) == list(range(1, 90))


def test_size_from_the_session_table(flat):
    made = sessions.session_measures(flat)
    by_rows = skew.hot_keys(flat, sessions.TRAIL_KEYS, 50)
    by_sessions = skew.hot_keys(made, sessions.TRAIL_KEYS, 50, F.sum("total_events"))
    assert set(by_rows.frame.collect()) == set(by_sessions.frame.collect())


def test_order_with_many_lines_is_one_event(spark):
    lines = spark.createDataFrame(
        [("big", "c", f"p{i % 40:02d}", "x", float(i), "card") for i in range(95)] + [("small", "d", "p", "x", 2.0, None)],
        "order_id string, customer_unique_id string, product_id string, product_category_name string,"
        " price double, payment_type string",
    )
    whole = {r.order_id: r for r in orders.order_purchases(lines).collect()}
    assert {k: (r.part, len(r["items"]), r.order_total) for k, r in whole.items()} == {"big": (0, 95, 4465.0), "small": (0, 1, 2.0)}
    assert orders.purchase_actions(orders.order_purchases(lines)).count() == 2
    for hot in (None, skew.hot_keys(lines, orders.ORDER_KEYS, 30)):
        rows = orders.purchase_items(lines, hot).orderBy("order_id", "position").collect()
        assert [(r.order_id, r.position) for r in rows] == [("big", i + 1) for i in range(95)] + [("small", 1)]
        assert [r["item"] for r in rows if r.order_id == "big"] == whole["big"]["items"]
