"""The events of an order's session, one by one, and what is carried with them."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from cartpath.functions.stages import CART_ADD, CART_REMOVAL, PAGE_VIEW, PRODUCT_VIEW, PURCHASE
from cartpath.operators.orders import EVENT_GAP, REMOVAL_PERCENT, order_sessions

BODY = """order_id string, customer_id string, part int, order_total double, payment_type string,
    items array<struct<SKU: string, name: string, priceTotal: double, quantity: int>>"""


def line(sku, price, name="n"):
    return (sku, name, price, 1)


def drawn(purpose, order):
    text = purpose if order is None else f"{purpose}-{order}"
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def expected(order, customer, payment, items):
    """(kind, items, total) of each event of an order, in their order."""
    if items is None:
        return []
    steps = [(PAGE_VIEW, []), *((PRODUCT_VIEW, [i]) for i in items), *((CART_ADD, [i]) for i in items)]
    left = items
    if len(items) > 1 and drawn("removal", order) % 100 < REMOVAL_PERCENT:
        out = items[drawn("product", order) % len(items)]
        same = [i for i in items if (i and i[0]) == (out and out[0])]
        left = [i for i in items if i not in same]
        steps.append((CART_REMOVAL, same[:1]))
    total = float(sum(i[2] for i in left if i and i[2] is not None))
    return [(kind, held, total) for kind, held in [*steps, (PURCHASE, left)]]


def test_every_event_of_odd_orders(spark):
    carts = {
        "plain": [line("a", 1.5), line("b", 2.25)],
        "copies": [line("a", 1.0), line("a", 1.0), line("b", None), line(None, 3.0)],
        "none": [],
        "one": [line("a", 0.1)],
        "gaps": [None, line("a", 2.0), line(None, None, None)],
    }
    orders = [(f"{name}-{k}", "c", None if k % 2 else "card", items) for name, items in carts.items() for k in range(40)]
    orders += [("absent", "c", "card", None), (None, None, None, carts["plain"]), ("twice", "c", "x", carts["plain"]), ("twice", "c", "x", carts["plain"])]
    bodies = spark.createDataFrame([(o, c, 0, 9.0, p, items) for o, c, p, items in orders], BODY)
    started = F.lit("2024-01-31").cast("timestamp")
    made = order_sessions(bodies, started).withColumn("_gap", F.unix_micros("event_time") - F.unix_micros(started))
    rows = [
        (r.order_id, r.customer_id, r.payment_type, r.event_id, r._gap, r.event_type, [i and tuple(i) for i in r["items"]], r.order_total)
        for r in made.collect()
    ]
    wanted = []
    for o, c, p, items in orders:
        for step, (kind, held, total) in enumerate(expected(o, c, p, items)):
            text = f"event-{step}" if o is None else f"{o}-event-{step}"
            event_id = hashlib.sha256(text.encode()).hexdigest()
            gap = round(step * EVENT_GAP * 1_000_000)
            wanted.append((None if kind == PAGE_VIEW else o, c, p, event_id, gap, kind, held, total))
    assert sorted(map(repr, rows)) == sorted(map(repr, wanted))
    assert any(kind == CART_REMOVAL for *_, kind, _, _ in wanted)


def test_events_are_exploded_from_numbers(spark):
    """The cart and its total are made once an order, before its events."""
    bodies = spark.createDataFrame([("1", "c", 0, 1.0, "x", [line("a", 1.0)])], BODY)
    plan = order_sessions(bodies)._jdf.queryExecution().optimizedPlan().toString()
    events, orders = re.split(r"\n.*Generate ", plan, maxsplit=1)
    assert "sequence(0, _last" in orders.split("\n")[0]
    assert "aggregate(" not in events and "lambda" not in events and "aggregate(" in orders
