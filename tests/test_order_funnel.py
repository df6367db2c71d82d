"""The funnel over whole carts: what is exchanged for it, and odd events."""

from __future__ import annotations

import re

import pytest

from cartpath.functions.stages import CART_ADD, PURCHASE
from cartpath.operators.events import flatten_items
from cartpath.plans.queries import queries
from cartpath.sources.schemas import EVENT_DDL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def broadcast_limit(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield lambda limit: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(rows) -> list[str]:
    """The keys of every hash exchange, without the numbers of the columns."""
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\), ", plan)]


@pytest.mark.parametrize(("limit", "by_session"), [(-1, 1), ("10m", 0)])
def test_sessions_of_orders_are_exchanged_before_their_items(spark, broadcast_limit, limit, by_session):
    """Bodies are dealt out by session once; only a join with large products moves what was made of them."""
    broadcast_limit(limit)
    keys = exchanges(queries()["order_funnel_by_category"](spark, FOLDER))
    assert sum(k.startswith("sha2(") and "session" in k for k in keys) == 1
    assert sum("session_id" in k for k in keys) == by_session


def test_items_carry_only_flat_columns(spark):
    events = spark.createDataFrame([("1",)], "_id string").selectExpr(f"from_json(_id, '{EVENT_DDL}') AS e").select("e.*")
    plan = flatten_items(events)._jdf.queryExecution().executedPlan().toString()
    carried = re.sub(r"#\d+L?", "", re.search(r"Generate posexplode\(.*\), (\[[^\]]*\]), false", plan)[1])
    assert carried == "[event_id, session_id, customer_id, funnel_stage]"


def test_items_of_odd_events(spark):
    item = "named_struct('SKU', {}, 'name', 'n', 'priceTotal', CAST({} AS DOUBLE), 'quantity', 1)"
    two = f"array({item.format(repr('a'), 1)}, {item.format('CAST(NULL AS STRING)', 'NULL')}, NULL)"
    one = f"array({item.format(repr('b'), 2)})"
    empty = f"slice({one}, 1, 0)"
    customer = "map('customerId', array(named_struct('id', 'c', 'primary', true)))"
    nobody = "map('customerId', slice(array(named_struct('id', 'c', 'primary', true)), 1, 0))"
    web = "named_struct('webSession', named_struct('ID', 's'))"
    no_web = f"CASE WHEN _id = '' THEN {web} END"
    rows = {
        "1": (f"'{PURCHASE}'", customer, web, two),
        "2": (f"'{CART_ADD}'", nobody, no_web, one),
        "3": ("'other'", "map('x', array(named_struct('id', 'c', 'primary', true)))", web, one),
        "4": ("CAST(NULL AS STRING)", f"CASE WHEN _id = '' THEN {customer} END", web, one),
        "5": (f"'{CART_ADD}'", customer, web, empty),
        "6": (f"'{CART_ADD}'", customer, web, f"CASE WHEN _id = '' THEN {one} END"),
    }
    made = [
        spark.createDataFrame([(i,)], "_id string").selectExpr(
            "_id", f"{kind} AS eventType", f"{who} AS identityMap", f"{where} AS web", f"{items} AS productListItems"
        )
        for i, (kind, who, where, items) in rows.items()
    ]
    union = made[0]
    for more in (*made[1:], made[1]):  # the second one twice
        union = union.unionByName(more)
    found = flatten_items(union).select("event_id", "session_id", "customer_id", "item_no", "product_id", "product_price", "funnel_stage").collect()
    second = ("2", None, None, 0, "b", 2.0, 3)
    assert sorted(map(tuple, found), key=repr) == sorted(
        [
            ("1", "s", "c", 0, "a", 1.0, 4),
            ("1", "s", "c", 1, None, None, 4),
            ("1", "s", "c", 2, None, None, 4),
            second,
            second,
            ("3", "s", None, 0, "b", 2.0, 0),
            ("4", "s", None, 0, "b", 2.0, 0),
        ],
        key=repr,
    )
