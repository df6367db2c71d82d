"""The given star-schema tables, read as the retail model.

The ``events`` table has no session and no nested parts; both are derived: a session is one user's
day, a customer is a user within three days of the month, and the product is the key in ``props``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.functions.stages import CART_ADD, CART_REMOVAL, PAGE_VIEW, PRODUCT_VIEW, PURCHASE, map_text
from cartpath.operators.events import OPERATING_SYSTEMS, item_text, to_envelope, with_lineage

# Columns used of each given table. A declared schema saves the job that reads the file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_extendedprice double",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}

# Event type of the given table and the one it stands for.
EVENT_TYPES = {
    "click": PAGE_VIEW,
    "view": PRODUCT_VIEW,
    "signup": CART_ADD,
    "error": CART_REMOVAL,
    "purchase": PURCHASE,
}
PLATFORMS = dict(enumerate(OPERATING_SYSTEMS))
DEVICES = {0: "terminal", 1: "handset", 2: "kiosk"}
# A session is one user's day, a customer one user within three days of the month.
SESSION_ID = "concat_ws('-', user_id, date_format(ts, 'yyyyMMdd'))"
CUSTOMER_ID = "CAST(user_id * 10 + (dayofmonth(ts) - 1) div 3 AS STRING)"


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = given(spark, folder, "nation")
    customer = given(spark, folder, "customer")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left").selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id",
        "CAST(c_custkey AS STRING) AS customer_unique_id",
        "c_mktsegment AS customer_city",
        "n_name AS customer_state",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS customer_id",
        "CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE o_orderstatus END AS order_status",
        "CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp",
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id",
        "CAST(l_partkey AS STRING) AS product_id",
        "l_extendedprice AS price",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id", "p_type AS product_category_name"
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    return given(spark, folder, "orders").selectExpr("CAST(o_orderkey AS STRING) AS order_id", "o_orderpriority AS payment_type")


def actions(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table as one row per action, ready for the envelope."""
    product = "CASE WHEN event_type != 'click' THEN CAST(get_json_object(props, '$.k') AS BIGINT) END AS product"
    events = given(spark, folder, "events").selectExpr("*", product)
    part = given(spark, folder, "part")
    return events.join(part, events["product"] == part["p_partkey"], "left").selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CAST(ts AS TIMESTAMP) AS event_time",
        f"{map_text(EVENT_TYPES)}[event_type] AS event_type",
        f"{SESSION_ID} AS session_id",
        f"{CUSTOMER_ID} AS customer_id",
        f"{map_text(PLATFORMS)}[CAST(user_id % 3 AS INT)] AS platform",
        f"{map_text(DEVICES)}[CAST(event_id % 3 AS INT)] AS device",
        "CASE WHEN event_type = 'click' THEN 'homepage' END AS page_name",
        "CASE WHEN event_type = 'click' THEN '/' END AS page_url",
        "CASE WHEN event_type = 'click' THEN 'direct' END AS referrer_url",
        f"CASE WHEN event_type != 'click' THEN array({item_text('product', 'p_brand', 'value')}) END AS items",
        "CAST(event_id AS STRING) AS order_id",
        "value AS order_total",
        "CAST(NULL AS STRING) AS payment_type",
    )


def bronze_events(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table as nested events with lineage."""
    return with_lineage(to_envelope(actions(spark, folder)), F.lit("events.parquet"))


def event_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Session and customer of every event, without its other parts."""
    return given(spark, folder, "events").selectExpr(f"{SESSION_ID} AS session_id", f"{CUSTOMER_ID} AS customer_id")
