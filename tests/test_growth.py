"""What is written and exchanged grows with the rows that need it."""

from __future__ import annotations

import glob
import re

from pyspark.sql import functions as F

from cartpath.operators import orders, skew
from cartpath.plans import late, queries
from cartpath.session import shared_folder
from cartpath.sources import testtables as given

FOLDER = "/root/testdata/sf0.001"


def test_order_carts_write_bodies_and_not_events(spark, monkeypatch):
    seen = []
    whole = queries.written
    monkeypatch.setattr(queries, "written", lambda rows, purpose: seen.append(whole(rows, purpose)) or seen[-1])
    checked = queries._order_carts(spark, FOLDER)
    assert sum(rows.count() for rows in seen) == checked.count() == given.orders(spark, FOLDER).join(
        given.order_items(spark, FOLDER), "order_id", "left_semi"
    ).count()


def test_order_carts_exchange_bodies_and_not_events(spark, monkeypatch):
    monkeypatch.setattr(queries, "EVENTS_PER_TASK", 100)
    checked = queries._order_carts(spark, FOLDER)
    tree = checked._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (\w+)\(.*, (\d+)\), (\w+), .*\n.*FileScan parquet \[(.*?)\]", tree)
    assert tree.count("Exchange") == len(exchanges) == 2
    # Both read the same columns of the bodies, so that the second is the first over again.
    assert len({re.sub(r"#\d+", "", read) for *_, read in exchanges}) == 1
    assert {(kind, origin) for kind, _, origin, _ in exchanges} == {("hashpartitioning", "REPARTITION_BY_NUM")}
    assert {int(tasks) for _, tasks, *_ in exchanges} == {-(-queries._order_events(spark, FOLDER).count() // 100)}


def test_order_carts_of_hot_sessions(spark, monkeypatch):
    plain = sorted(map(tuple, queries._order_carts(spark, FOLDER).collect()))
    found = []
    monkeypatch.setattr(queries, "HOT_GROUP_ROWS", 0)
    monkeypatch.setattr(queries, "hot_keys", lambda rows, keys: found.append(skew.hot_keys(rows, keys, 6)) or found[-1])
    assert sorted(map(tuple, queries._order_carts(spark, FOLDER).collect())) == plain
    assert found[0] is not None and found[0].frame.count() > 1 and len(plain) > found[0].frame.count()


def test_lines_are_exchanged_for_their_joins_alone(spark):
    tables = (getattr(given, t)(spark, FOLDER) for t in ("customers", "orders", "order_items", "products", "order_payments"))
    rows = orders.reference_orders(*tables)
    tree = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[order_id#\d+, product_id#\d+, price#\d+\]", tree)
    copied = given.order_items(spark, FOLDER).union(given.order_items(spark, FOLDER))
    again = orders.reference_orders(
        given.customers(spark, FOLDER), given.orders(spark, FOLDER), copied, given.products(spark, FOLDER), given.order_payments(spark, FOLDER)
    )
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows.collect()))


def test_a_large_bucket_is_shared_by_tasks(spark):
    bucketed = spark.range(10).withColumn(late.BUCKET, F.lit(0))
    assert "rebalance" in late._by_bucket(bucketed)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_event_files_are_bounded_and_compressed(spark):
    before = set(glob.glob(f"{shared_folder(spark)}/forms-*"))
    assert queries._event_files_any_form(queries.configure(spark), FOLDER).count() == given.given(spark, FOLDER, "events").count()
    (made,) = set(glob.glob(f"{shared_folder(spark)}/forms-*")) - before
    files = glob.glob(f"{made}/landing/*/part-*")
    assert files and all(name.endswith(".gz") for name in files)
