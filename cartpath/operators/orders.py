"""Order lines joined to their dimensions, and purchase events made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpath.functions.measures import total_amount
from cartpath.functions.stages import CART_ADD, CART_REMOVAL, PAGE_VIEW, PRODUCT_VIEW, PURCHASE
from cartpath.operators.events import cart_total, item_text, payment_text, without_product
from cartpath.operators.skew import HotKeys, ordered_context

ORDER_KEYS = ("order_id",)


def reference_orders(
    customers: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    order_payments: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Distinct order lines with customer, category and payment types.

    An order paid in two ways gives each of its lines twice; one without payment has a NULL type.
    ``limit`` gives the first so many rows by customer, order, product, category, price and payment.

    Since the result is distinct, every input but the lines is made distinct first: copies then combine
    before their exchange, and none multiply in a join. The joins on order id come last, so that they
    and the final distinct share one partitioning.
    """

    def distinct(table: DataFrame, *columns: str) -> DataFrame:
        return table.select(*columns).distinct()

    ordered_by = distinct(customers, "customer_id", "customer_unique_id").join(
        distinct(orders, "order_id", "customer_id"), "customer_id"
    )
    # Lines are most of the rows, and few are copies: these go in the last distinct, without an exchange of their own.
    lines = order_items.select("order_id", "product_id", "price").join(
        distinct(products, "product_id", "product_category_name"), "product_id"
    )
    paid_by = distinct(order_payments, "order_id", "payment_type")
    rows = (
        ordered_by.join(lines, "order_id")
        .join(paid_by, "order_id", "left")
        .select("customer_unique_id", "order_id", "product_id", "product_category_name", "price", "payment_type")
        .distinct()
    )
    return rows if limit is None else rows.orderBy(*rows.columns).limit(limit)


def _described(lines: DataFrame) -> DataFrame:
    item = F.expr(item_text("product_id", "product_category_name", "price")).alias("item")
    return lines.select("order_id", "customer_unique_id", "payment_type", "price", item)


def order_purchases(lines: DataFrame) -> DataFrame:
    """The body of a purchase event per order: items, cart total and payment type.

    The payment type is the smallest of the order, or the default. Items are sorted by product and
    price. An order is one event and therefore one row (``part`` is always 0), whatever its size;
    :func:`purchase_items` gives the items of orders that do not fit into one.
    """
    items = F.sort_array(F.collect_list(F.struct("item.SKU", "item.priceTotal", "item")))["item"].alias("items")
    bodies = _described(lines).groupBy("order_id").agg(
        F.lit(0).alias("part"),
        items,
        F.min("customer_unique_id").alias("customer_id"),
        total_amount(F.col("price")).alias("order_total"),
        F.expr(payment_text("min(payment_type)")).alias("payment_type"),
    )
    return bodies.select("order_id", "customer_id", "part", "items", "order_total", "payment_type")


def purchase_items(lines: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The items of every order as rows: order, position from 1 in the cart, and the item.

    ``hot`` holds keys by :data:`ORDER_KEYS`, found on ``lines`` themselves. Orders of any size are
    safe here, and a line that is there twice has two positions.
    """
    sorted_by = {"_sku": F.col("item.SKU"), "_price": F.col("item.priceTotal")}
    placed = ordered_context(
        _described(lines).withColumns(sorted_by),
        ORDER_KEYS,
        ("_sku", "_price", "payment_type"),
        number="position",
        hot=hot,
        ties=True,
    )
    return placed.select("order_id", "position", "item")


def purchase_actions(
    bodies: DataFrame, event_time: Column | None = None, platform: str = "web", device: str = "desktop"
) -> DataFrame:
    """Purchase bodies as actions for :func:`cartpath.operators.events.to_envelope`.

    Event and session ids are digests of the order, so that a task that runs again makes the same
    events, which random ids would not.
    """
    event_time = F.current_timestamp() if event_time is None else event_time
    absent = "CAST(NULL AS STRING)"
    return bodies.withColumn("event_time", event_time).selectExpr(
        "sha2(concat_ws('-', order_id, part), 256) AS event_id",
        "event_time",
        f"'{PURCHASE}' AS event_type",
        "sha2(concat_ws('-', 'session', order_id), 256) AS session_id",
        "customer_id",
        f"'{platform}' AS platform",
        f"'{device}' AS device",
        f"{absent} AS page_name",
        f"{absent} AS page_url",
        f"{absent} AS referrer_url",
        "items",
        "order_id",
        "order_total",
        "payment_type",
    )


# How often a session takes a product out again, in percent, and the seconds between its events.
REMOVAL_PERCENT = 15
EVENT_GAP = 0.05


def order_sessions(
    bodies: DataFrame,
    started: Column | None = None,
    platform: str = "web",
    device: str = "desktop",
    tasks: int | None = None,
) -> DataFrame:
    """The events of the session that led to each order, as actions for :func:`cartpath.operators.events.to_envelope`.

    A session views the page, views each item, adds each item, may take one product out of a cart of
    several items, and buys what is left. Which sessions do and which product it is follows from a
    digest of the order, so the events are the same in every run. ``bodies`` are :func:`order_purchases`.
    With ``tasks`` the bodies are dealt out by session before their events, which are many times their
    size, are made: what then goes by session needs no exchange.
    """
    started = F.current_timestamp() if started is None else started
    session_id = F.sha2(F.concat_ws("-", F.lit("session"), "order_id").cast("binary"), 256)
    bodies = bodies if tasks is None else bodies.repartition(tasks, session_id)

    def drawn(purpose: str) -> Column:
        digits = F.substring(F.md5(F.concat_ws("-", F.lit(purpose), "order_id").cast("binary")), 1, 8)
        return F.conv(digits, 16, 10).cast("bigint")

    size = F.size("items")
    takes_out = (size > 1) & (drawn("removal") % 100 < REMOVAL_PERCENT)
    lines = bodies.select(
        "order_id",
        "customer_id",
        "payment_type",
        "items",
        session_id.alias("session_id"),
        size.alias("_size"),
        F.when(takes_out, F.get("items", (drawn("product") % F.greatest(size, F.lit(1))).cast("int"))["SKU"]).alias("_sku"),
        takes_out.alias("_takes_out"),
    )
    left = F.when(F.col("_takes_out"), without_product(F.col("items"), F.col("_sku"))).otherwise(F.col("items"))
    lines = lines.withColumns(
        {
            "_left": left,
            "_out": F.expr("CASE WHEN _takes_out THEN slice(filter(items, i -> i.SKU <=> _sku), 1, 1) END"),
            "_last": F.expr("2 * _size + CASE WHEN _takes_out THEN 2 ELSE 1 END"),
        }
    ).drop("_sku", "_takes_out")
    # What holds for the whole order is made before its events, and only their numbers are exploded: no event carries the cart.
    lines = lines.withColumn("order_total", cart_total(F.col("_left")))
    steps = lines.withColumn("_step", F.explode(F.expr("CASE WHEN items IS NOT NULL THEN sequence(0, _last) END")))
    kind = f"""CASE WHEN _step = 0 THEN '{PAGE_VIEW}'
        WHEN _step <= _size THEN '{PRODUCT_VIEW}'
        WHEN _step <= 2 * _size THEN '{CART_ADD}'
        WHEN _step < _last THEN '{CART_REMOVAL}'
        ELSE '{PURCHASE}' END"""
    its_items = """CASE WHEN _step = 0 THEN slice(items, 1, 0)
        WHEN _step <= 2 * _size THEN array(get(items, CASE WHEN _step <= _size THEN _step - 1 ELSE _step - _size - 1 END))
        WHEN _step < _last THEN _out
        ELSE _left END"""
    actions = steps.select(
        "order_id",
        "session_id",
        "customer_id",
        "payment_type",
        "order_total",
        "_step",
        F.expr(kind).alias("event_type"),
        F.expr(its_items).alias("items"),
        started.alias("_started"),
    )
    absent, page = "CAST(NULL AS STRING)", f"event_type = '{PAGE_VIEW}'"
    gap = f"make_interval(0, 0, 0, 0, 0, 0, CAST(_step * {EVENT_GAP} AS DECIMAL(18, 6)))"
    return actions.selectExpr(
        "sha2(concat_ws('-', order_id, 'event', _step), 256) AS event_id",
        f"_started + {gap} AS event_time",
        "event_type",
        "session_id",
        "customer_id",
        f"'{platform}' AS platform",
        f"'{device}' AS device",
        f"CASE WHEN {page} THEN 'homepage' END AS page_name",
        f"CASE WHEN {page} THEN '/' END AS page_url",
        f"CASE WHEN {page} THEN 'direct' END AS referrer_url",
        f"CASE WHEN {page} THEN {absent} ELSE order_id END AS order_id",
        "items",
        "order_total",
        "payment_type",
    )
