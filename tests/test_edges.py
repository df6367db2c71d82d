"""Edge rows, one test per stated rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from sample import as_dicts, event, flat_events

from cartpath.operators import funnel, journeys, orders, sessions
from cartpath.operators.events import cart_total, flatten, to_envelope, with_lineage, without_product
from cartpath.plans import reports


def test_absent_parts_give_nulls(spark):
    flat = as_dicts(
        flat_events(
            spark,
            [
                event("empty", "01T10:00:00", "view", identityMap={"customerId": []}),
                event("other", "01T10:00:01", "view", identityMap={"email": [{"id": "x", "primary": True}]}),
                event("nomap", "01T10:00:02", "view", identityMap=None),
                event("badtime", "01T10:00:03", "view", timestamp="yesterday"),
                event("noitems", "01T10:00:04", "view", productListItems=None, web=None),
                event("strange", "01T10:00:05", "some.other.type"),
            ],
        ),
        "event_id",
    )
    assert [flat[i]["customer_id"] for i in ("empty", "other", "nomap")] == [None, None, None]
    assert flat["badtime"]["event_timestamp"] is None
    assert flat["noitems"]["product_id"] is None and flat["noitems"]["session_id"] is None
    assert flat["strange"]["funnel_stage"] == 0


def test_session_shared_by_two_customers(spark):
    flat = flat_events(
        spark,
        [
            event("1", "01T10:00:00", "page", customer="a"),
            event("2", "01T10:00:05", "buy", customer="b", items=[("p", 5.0)]),
            event("3", "01T10:00:09", "view", customer="a", items=[("q", 1.0)]),
        ],
    )
    assert {(r.customer_id, r.total_events) for r in sessions.sessions(flat).collect()} == {("a", 2), ("b", 1)}
    trail = as_dicts(sessions.session_events(flat), "event_id")
    assert [trail[i]["event_sequence_num"] for i in "123"] == [1, 2, 3]
    assert trail["3"]["prev_event_type"] == "commerce.purchases"
    assert trail["3"]["seconds_since_prev_event"] == 4


def test_ties_follow_the_event_id(spark):
    flat = flat_events(
        spark,
        [
            event("b", "01T10:00:00", "view", items=[("second", 1.0)]),
            event("a", "01T10:00:00", "view", items=[("first", 1.0)]),
        ],
    )
    trail = as_dicts(sessions.session_events(flat), "event_id")
    assert (trail["a"]["event_sequence_num"], trail["b"]["event_sequence_num"]) == (1, 2)
    assert sessions.sessions(flat).first().products_interacted == ["first", "second"]


def test_revenue_is_the_first_item_of_purchases(spark):
    flat = flat_events(
        spark,
        [
            event("1", "01T10:00:00", "buy", "multi", items=[("p", 5.0), ("q", 7.0)]),
            event("2", "01T10:00:01", "buy", "multi", items=[("p", 0.1)]),
            event("3", "01T10:00:00", "buy", "unpriced"),
            event("4", "01T10:00:00", "view", "looking", items=[("p", 5.0)]),
        ],
    )
    revenue = {r.session_id: r.session_revenue for r in sessions.sessions(flat).collect()}
    assert revenue == {"multi": 5.1, "unpriced": 0.0, "looking": None}


def test_removal_only_session_is_an_add_to_cart_session(spark):
    made = sessions.sessions(flat_events(spark, [event("1", "01T10:00:00", "remove", items=[("p", 0.0)])])).first()
    assert (made.funnel_stage_name, made.converted, made.unique_products_viewed) == ("add_to_cart", False, 1)


def test_measures_without_list_equal_those_with_it(spark):
    flat = flat_events(
        spark,
        [event(str(i), f"01T10:00:{i:02d}", k, f"s{i % 3}", items=[(f"p{i % 4}", 1.5)]) for i, k in enumerate(["view", "add", "buy", "remove"] * 5)]
        + [event("null", "01T10:00:00", "page", None, None)],
    )
    listed = sessions.sessions(flat).drop(sessions.PRODUCT_LIST)
    assert sorted(map(str, listed.collect())) == sorted(map(str, sessions.session_measures(flat).collect()))


def test_purchase_only_session_counts_for_every_step(spark):
    metrics = funnel.funnel_metrics(sessions.sessions(flat_events(spark, [event("1", "01T10:00:00", "buy")])))
    assert [r.sessions_entered for r in metrics.orderBy("funnel_step").collect()] == [1, 1, 1, 1]


def test_funnel_without_sessions_has_null_rates(spark):
    none = sessions.sessions(flat_events(spark, [event("1", "01T10:00:00", "buy")])).where("false")
    rows = funnel.funnel_metrics(none).orderBy("funnel_step").collect()
    assert [r.sessions_entered for r in rows] == [0, 0, 0, 0]
    assert [r.overall_conversion_rate_pct for r in rows] == [None] * 4
    assert [r.step_conversion_rate_pct for r in rows] == [100.0, None, None, None]
    assert [r.drop_off_rate_pct for r in rows] == [0.0, None, None, None]


def test_zero_previous_step(spark):
    only_page = sessions.sessions(flat_events(spark, [event("1", "01T10:00:00", "page")]))
    rows = funnel.funnel_metrics(only_page).orderBy("funnel_step").collect()
    assert [r.step_conversion_rate_pct for r in rows] == [100.0, 0.0, None, None]


def test_step_times_may_be_negative_or_missing(spark):
    flat = flat_events(
        spark,
        [
            event("1", "01T10:00:10", "page"),
            event("2", "01T10:00:04.900", "view"),
            event("3", "01T10:00:20", "view"),
            event("4", "01T10:00:30", "remove"),
            event("5", "01T10:00:00", "remove", "only-removal"),
        ],
    )
    times = as_dicts(funnel.funnel_step_times(flat), "session_id")
    assert times["s1"]["seconds_page_to_product_view"] == -6
    assert times["s1"]["ts_add_to_cart"] is None and times["s1"]["seconds_product_view_to_add"] is None
    assert times["only-removal"]["ts_page_view"] is None
    summary = funnel.step_time_summary(funnel.funnel_step_times(flat)).first()
    assert (summary.avg_sec_page_to_product_view, summary.avg_sec_full_journey) == (-6.0, None)
    assert summary.converting_sessions_with_timestamps == 0


def test_funnel_by_category(spark):
    flat = flat_events(
        spark,
        [
            event("1", "01T10:00:00", "view", items=[("p", 1.0)]),
            event("2", "01T10:00:01", "buy", items=[("q", 1.0)]),
            event("3", "01T10:00:02", "add", "s2", items=[("p", 1.0)]),
        ],
    )
    products = spark.createDataFrame([("p", "x"), ("q", "y")], "product_id string, product_category_name string")
    entered = {
        (r.product_category_name, r.step_name): r.sessions_entered
        for r in funnel.funnel_by_category(flat, products).collect()
    }
    assert entered["x", "product_view"] == 2 and entered["x", "add_to_cart"] == 1 and entered["x", "purchase"] == 0
    assert entered["y", "purchase"] == 1


def _three_visits(spark, customer="c1"):
    return flat_events(
        spark,
        [
            event("1", "01T23:00:00", "page", "a", customer),
            event("2", "02T01:00:00", "buy", "b", customer, items=[("p", 3.0)]),
            event("3", "05T01:00:00", "view", "c", customer, items=[("p", 3.0)]),
        ],
    )


def _orders(spark, rows):
    return spark.createDataFrame(
        [(o, c, s, dt.datetime(2018, 1, day)) for o, c, s, day in rows],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp",
    )


def _customers(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id string, customer_unique_id string, customer_city string, customer_state string"
    )


def test_journey_of_three_visits(spark):
    ranked = journeys.ranked_sessions(sessions.sessions(_three_visits(spark)))
    by_session = as_dicts(ranked, "session_id")
    assert [by_session[s]["days_since_prev_session"] for s in "abc"] == [None, 1, 3]
    assert [by_session[s]["is_last_session"] for s in "abc"] == [False, False, True]
    journey = journeys.customer_journeys(ranked, _customers(spark, []), _orders(spark, [])).first()
    assert journey.total_sessions == 3
    assert abs(journey.avg_days_between_sessions - 4 / 3) < 1e-12
    assert journey.sessions_before_first_conversion == 2
    assert (journey.first_session_id, journey.last_session_id) == ("a", "c")
    assert (journey.first_touch_stage, journey.last_touch_stage) == ("page_view", "product_view")
    assert (journey.customer_lifetime_days, journey.session_conversion_rate_pct) == (4, 33.33)
    assert journey.last_session_revenue is None and journey.total_behavioral_revenue == 3.0
    assert journey.total_unique_products_viewed == 2
    assert journey.actual_order_count is None and journey.customer_city is None
    touches = journeys.first_last_touch(sessions.sessions(_three_visits(spark))).first().asDict()
    assert touches == {k: v for k, v in journey.asDict().items() if k in touches}


def test_no_customer_gives_one_journey_with_totals_only(spark):
    flat = _three_visits(spark, None)
    ranked = journeys.ranked_sessions(sessions.sessions(flat))
    journey = journeys.customer_journeys(
        ranked, _customers(spark, [("x", "x", "c", "s")]), _orders(spark, [("o", "x", "delivered", 1)])
    ).collect()
    assert len(journey) == 1 and journey[0].customer_id is None
    assert (journey[0].total_sessions, journey[0].total_purchases) == (3, 1)
    assert journey[0].first_session_id is None and journey[0].sessions_before_first_conversion is None
    contexts = journeys.customer_journey_sessions(ranked).collect()
    assert {(r.customer_total_sessions, r.customer_ever_converted, r.customer_deepest_stage) for r in contexts} == {
        (None, None, None)
    }
    assert sorted(r.session_rank for r in contexts) == [1, 2, 3]
    assert reports.first_touch_distribution(journeys.journey_metrics(ranked)).count() == 0


def test_two_customer_ids_of_one_person(spark):
    customers = _customers(
        spark,
        [
            ("old", "c1", "Old Town", "OT"),
            ("new", "c1", "New Town", "NT"),
            ("tie", "c1", "Tie Town", "TT"),
            ("idle", "c1", "Idle Town", "IT"),
            ("alone", "c2", "Lone Town", "LT"),
        ],
    )
    placed = _orders(
        spark,
        [
            ("o1", "old", "delivered", 1),
            ("o2", "new", "delivered", 5),
            ("o3", "new", "shipped", 3),
            ("o4", "tie", "canceled", 5),
            ("o5", "unlisted", "delivered", 7),
        ],
    )
    profiles = as_dicts(journeys.customer_profiles(customers, placed), "customer_id")
    assert profiles["c1"]["actual_order_count"] == 4 and profiles["c1"]["delivered_orders"] == 2
    assert profiles["c1"]["first_order_at"].day == 1 and profiles["c1"]["last_order_at"].day == 5
    assert profiles["c1"]["customer_city"] == "New Town"
    assert profiles["c2"]["customer_city"] == "Lone Town" and profiles["c2"]["actual_order_count"] is None
    assert profiles["unlisted"]["actual_order_count"] == 1 and profiles["unlisted"]["customer_city"] is None
    ranked = journeys.ranked_sessions(sessions.sessions(_three_visits(spark)))
    assert journeys.customer_journeys(ranked, customers, placed).count() == 1


def test_repeated_rows_do_not_multiply(spark):
    customers = _customers(spark, [("k", "c1", "A", "S")] * 3 + [("k", "c1", "B", "S")])
    placed = _orders(spark, [("o1", "k", "delivered", 1)])
    profile = journeys.customer_profiles(customers, placed).collect()
    assert [(r.customer_id, r.actual_order_count, r.customer_city) for r in profile] == [("c1", 1, "A")]
    items = spark.createDataFrame([("o1", "p", 2.5)] * 4, "order_id string, product_id string, price double")
    products = spark.createDataFrame([("p", "x")] * 2, "product_id string, product_category_name string")
    payments = spark.createDataFrame([("o1", "card")] * 3, "order_id string, payment_type string")
    doubled = placed.union(placed)
    assert orders.reference_orders(customers, doubled, items, products, payments).count() == 1


def _order_tables(spark):
    customers = _customers(spark, [("k1", "c1", "", "")])
    placed = _orders(spark, [("o1", "k1", "delivered", 1), ("o2", "k1", "delivered", 2)])
    items = spark.createDataFrame(
        [("o1", "p", 2.5), ("o1", "p", 2.5), ("o1", "q", 1.0), ("o2", "q", 1.0), ("o2", "gone", 9.0)],
        "order_id string, product_id string, price double",
    )
    products = spark.createDataFrame([("p", "x"), ("q", "y")], "product_id string, product_category_name string")
    payments = spark.createDataFrame(
        [("o1", "voucher"), ("o1", "boleto"), ("o1", "boleto")], "order_id string, payment_type string"
    )
    return customers, placed, items, products, payments


def test_order_lines_per_payment_type(spark):
    rows = orders.reference_orders(*_order_tables(spark))
    found = sorted(((r.order_id, r.product_id, r.payment_type) for r in rows.collect()), key=str)
    assert found == [
        ("o1", "p", "boleto"),
        ("o1", "p", "voucher"),
        ("o1", "q", "boleto"),
        ("o1", "q", "voucher"),
        ("o2", "q", None),
    ]
    first = orders.reference_orders(*_order_tables(spark), limit=2)
    assert [(r.order_id, r.product_id) for r in first.collect()] == [("o1", "p"), ("o1", "p")]


def test_purchase_bodies(spark):
    bodies = as_dicts(orders.order_purchases(orders.reference_orders(*_order_tables(spark))), "order_id")
    assert [i.SKU for i in bodies["o1"]["items"]] == ["p", "p", "q", "q"]
    assert (bodies["o1"]["order_total"], bodies["o1"]["payment_type"]) == (7.0, "boleto")
    assert (bodies["o2"]["order_total"], bodies["o2"]["payment_type"]) == (1.0, "credit_card")
    assert bodies["o2"]["customer_id"] == "c1"


def test_purchase_events_carry_the_whole_cart(spark):
    bodies = orders.order_purchases(orders.reference_orders(*_order_tables(spark)))
    made = to_envelope(orders.purchase_actions(bodies))
    o1 = made.where("commerce.order.purchaseID = 'o1'").select(
        "*", cart_total(F.col("productListItems")).alias("cart"), F.size("productListItems").alias("n")
    ).first()
    assert (o1.cart, o1.n, o1.commerce.order.priceTotal) == (7.0, 4, 7.0)
    assert o1.commerce.order.payments[0].paymentType == "boleto" and o1.commerce.purchases.value == 1
    assert o1.environment.operatingSystem == "Windows" and o1.web.webPageDetails is None
    flat = flatten(with_lineage(made, F.lit("orders")))
    assert {r.product_id: r.session_revenue for r in sessions.session_measures(flat).join(
        flat.select("session_id", "product_id"), "session_id").collect()} == {"p": 2.5, "q": 1.0}


def test_cart_expressions(spark):
    cart = spark.sql("SELECT array(named_struct('SKU','a','priceTotal',1.5D), named_struct('SKU','b','priceTotal',2.0D)) AS items")
    row = cart.select(
        cart_total(F.col("items")).alias("total"), without_product(F.col("items"), F.lit("a")).alias("rest")
    ).first()
    assert row.total == 3.5 and [i.SKU for i in row.rest] == ["b"]


def test_unknown_segment_and_shares(spark):
    rows = spark.createDataFrame(
        [("a", 1, True, 1.0), ("b", 2, False, None), ("c", None, None, None)],
        "customer_id string, total_sessions bigint, ever_converted boolean, total_behavioral_revenue double",
    ).withColumn("total_events", F.lit(1))
    made = {r.engagement_segment: r.avg_revenue for r in reports.engagement_segments(rows).collect()}
    assert made == {"single_session_converted": 1.0, "multi_session_not_converted": None, "unknown": None}
