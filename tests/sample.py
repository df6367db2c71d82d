"""Hand-written nested events."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.functions.stages import CART_ADD, CART_REMOVAL, PAGE_VIEW, PRODUCT_VIEW, PURCHASE
from cartpath.operators.events import flatten, with_lineage
from cartpath.sources.topics import decode_events

KINDS = {"page": PAGE_VIEW, "view": PRODUCT_VIEW, "add": CART_ADD, "remove": CART_REMOVAL, "buy": PURCHASE}


def event(id, time, kind, session="s1", customer="c1", items=(), **other) -> dict:
    """An event; ``time`` is the part after ``2024-01-``, items are (sku, price)."""
    made = {
        "_id": id,
        "timestamp": f"2024-01-{time}+00:00",
        "eventType": KINDS.get(kind, kind),
        "identityMap": {"customerId": [{"id": customer, "primary": True}]},
        "web": {"webSession": {"ID": session}},
        "productListItems": [{"SKU": s, "name": "n", "priceTotal": p, "quantity": 1} for s, p in items],
    }
    made.update(other)
    return made


def flat_events(spark: SparkSession, events: list[dict]) -> DataFrame:
    messages = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    return flatten(with_lineage(decode_events(messages), F.lit("sample")))


def as_dicts(rows: DataFrame, key: str) -> dict:
    """Rows by the value of a column."""
    return {row[key]: row.asDict() for row in rows.collect()}
