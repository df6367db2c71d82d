"""Nested commerce events: building the envelope, and flattening it to one row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.functions.measures import amount
from cartpath.functions.stages import (
    CART_ADD,
    CART_REMOVAL,
    PAGE_VIEW,
    PRODUCT_VIEW,
    PURCHASE,
    flag_text,
    map_text,
    stage_text,
)

# Fixed values of the envelope.
OPERATING_SYSTEMS = {"web": "Windows", "mobile_ios": "iOS", "mobile_android": "Android"}
CURRENCY = "BRL"
DEFAULT_PAYMENT = "credit_card"
IDENTITY = "customerId"


def item_text(sku: str, name: str, price: str) -> str:
    """SQL text for one product line as the envelope holds it."""
    return (
        f"named_struct('SKU', CAST({sku} AS STRING), 'name', CAST({name} AS STRING),"
        f" 'priceTotal', CAST({price} AS DOUBLE), 'quantity', 1)"
    )


def payment_text(payment: str) -> str:
    """SQL text for a payment type; a missing or empty one counts as a card payment."""
    return f"coalesce(nullif({payment}, ''), '{DEFAULT_PAYMENT}')"


def cart_total(items: Column) -> Column:
    """Sum of the prices, as exact as :func:`cartpath.functions.measures.total_amount`; a line without a price adds nothing."""
    money = "decimal(38,6)"
    total = F.aggregate(
        items,
        F.lit(0).cast(money),
        lambda total, line: (total + F.coalesce(amount(line["priceTotal"]), F.lit(0))).cast(money),
    )
    return total.cast("double")


def without_product(items: Column, sku: Column) -> Column:
    """The cart after a product was taken out, with all its lines. A NULL product takes out those without one."""
    return F.filter(items, lambda line: ~line["SKU"].eqNullSafe(sku))


def to_envelope(actions: DataFrame) -> DataFrame:
    """Nested events from one row per action.

    ``actions`` has event_id, event_time (timestamp), event_type, session_id, customer_id,
    platform, device, page_name, page_url, referrer_url, items (array of :func:`item_text`),
    order_id, order_total and payment_type. Page views carry the page, product events their items,
    purchases the order as well; a removed item has no name and the price 0.
    """
    page, bought, removal = (f"event_type = '{kind}'" for kind in (PAGE_VIEW, PURCHASE, CART_REMOVAL))

    def counter(event_type: str) -> str:
        return f"CASE WHEN event_type = '{event_type}' THEN named_struct('value', 1) END"

    return actions.selectExpr(
        "event_id AS _id",
        """concat(date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+00:00') AS timestamp""",
        "event_type AS eventType",
        f"map('{IDENTITY}', array(named_struct('id', customer_id, 'primary', true))) AS identityMap",
        f"""named_struct(
            'type', CASE WHEN platform = 'web' THEN 'browser' ELSE 'application' END,
            'operatingSystem', {map_text(OPERATING_SYSTEMS)}[platform],
            'deviceCategory', device) AS environment""",
        f"""named_struct(
            'webSession', named_struct('ID', session_id),
            'webPageDetails', CASE WHEN {page} THEN named_struct('name', page_name, 'URL', page_url) END,
            'webReferrer', CASE WHEN {page} THEN named_struct('URL', referrer_url, 'type', 'external') END
        ) AS web""",
        f"""CASE WHEN {removal} THEN transform(items, line -> {item_text('line.SKU', "''", '0.0')})
            WHEN NOT {page} THEN items END AS productListItems""",
        f"""CASE WHEN NOT {page} THEN named_struct(
            'productViews', {counter(PRODUCT_VIEW)},
            'productListAdds', {counter(CART_ADD)},
            'productListRemovals', {counter(CART_REMOVAL)},
            'purchases', {counter(PURCHASE)},
            'order', CASE WHEN {bought} THEN named_struct(
                'purchaseID', order_id,
                'priceTotal', CAST(order_total AS DOUBLE),
                'currencyCode', '{CURRENCY}',
                'payments', array(named_struct('paymentType', {payment_text('payment_type')}))) END
        ) END AS commerce""",
    )


def with_lineage(rows: DataFrame, source: Column) -> DataFrame:
    """Add the load time and the source of each row."""
    return rows.withColumns({"_ingested_at": F.current_timestamp(), "_source_file": source})


def flatten(events: DataFrame) -> DataFrame:
    """One flat row per nested event: 17 columns, with those of its first product.

    Absent parts (no customer identity, an empty array, a malformed time) give NULL, so that one
    bad event never fails a job.
    """
    first_item = "get(productListItems, 0)"
    return events.selectExpr(
        "_id AS event_id",
        "try_to_timestamp(timestamp) AS event_timestamp",
        "eventType AS event_type",
        "web.webSession.ID AS session_id",
        f"get(identityMap['{IDENTITY}'], 0).id AS customer_id",
        f"{flag_text(PRODUCT_VIEW)} AS is_product_view",
        f"{flag_text(CART_ADD)} AS is_add_to_cart",
        f"{flag_text(PURCHASE)} AS is_purchase",
        f"{flag_text(CART_REMOVAL)} AS is_remove_from_cart",
        f"{flag_text(PAGE_VIEW)} AS is_page_view",
        f"{first_item}.SKU AS product_id",
        f"CAST({first_item}.priceTotal AS DOUBLE) AS product_price",
        f"{first_item}.name AS product_name",
        "web.webPageDetails.URL AS page_url",
        "_ingested_at",
        "_source_file",
        f"{stage_text()} AS funnel_stage",
    )


def flatten_items(events: DataFrame) -> DataFrame:
    """One row per event and item: event, session and customer, place of the item (from 0), product, price and stage.

    Events without items have no row. Where :func:`flatten` lets the first item stand for its event,
    here a purchase counts for everything it bought.
    """
    # Taken out before the items are exploded: else every item carries the nested parts, and hides that its session has not moved.
    rows = events.selectExpr(
        "_id AS event_id",
        "web.webSession.ID AS session_id",
        f"get(identityMap['{IDENTITY}'], 0).id AS customer_id",
        f"{stage_text()} AS funnel_stage",
        "productListItems",
    )
    items = "arrays_zip(productListItems.SKU, productListItems.priceTotal)"
    rows = rows.selectExpr("event_id", "session_id", "customer_id", "funnel_stage", f"posexplode({items}) AS (item_no, item)")
    return rows.selectExpr(
        "event_id",
        "session_id",
        "customer_id",
        "item_no",
        "item.SKU AS product_id",
        "CAST(item.priceTotal AS DOUBLE) AS product_price",
        "funnel_stage",
    )
