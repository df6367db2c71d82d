"""The cart between adds, removals and purchase.

An added item is in the cart of the next purchase of its session, unless its product is taken out in
between: a removal takes out every item of its product, and a purchase leaves an empty cart. So no event
has to be replayed one after the other. With the number of purchases before each event, an add and the
purchase it may be part of meet in one stretch of the session, and it is in the cart if its place is
after the last removal of its product in that stretch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartpath.functions.measures import amount
from cartpath.functions.stages import CART_ADD, CART_REMOVAL, PURCHASE
from cartpath.operators.events import cart_total
from cartpath.operators.skew import HotKeys, hot_keys, ordered_context, split_hot

CART_KEYS = ("session_id",)
STRETCH = ("session_id", "_stretch")


def cart_moves(events: DataFrame) -> DataFrame:
    """One row per item that nested events add to or take out of a cart, and one per purchase.

    The items of a purchase are not read: what it bought follows from the moves before it.
    """
    items = "arrays_zip(items.SKU, items.name, items.priceTotal)"
    no_item = "array(named_struct('SKU', CAST(NULL AS STRING), 'name', CAST(NULL AS STRING), 'priceTotal', CAST(NULL AS DOUBLE)))"
    moves = events.where(F.col("eventType").isin(CART_ADD, CART_REMOVAL, PURCHASE))
    # The session is a column of its own before the items are rows, so that events dealt out by it stay so.
    named = moves.selectExpr(
        "web.webSession.ID AS session_id",
        "_id AS event_id",
        "try_to_timestamp(timestamp) AS event_timestamp",
        "eventType AS event_type",
        "productListItems AS items",
    )
    return named.selectExpr(
        "session_id",
        "event_id",
        "event_timestamp",
        "event_type",
        f"posexplode(CASE WHEN event_type = '{PURCHASE}' THEN {no_item} ELSE {items} END) AS (item_no, item)",
    )


def _last_removal() -> Column:
    return F.max(F.when(F.col("event_type") == CART_REMOVAL, F.col("_place")))


def _purchase() -> dict[str, Column]:
    """The purchase that ends a stretch; a stretch has one at most."""
    is_purchase = F.col("event_type") == PURCHASE
    return {f"_bought_{c}": F.max(F.when(is_purchase, F.col(c))) for c in ("event_id", "event_timestamp")}


def _is_in_cart(last_removal: str) -> Column:
    kept = F.col("_place") > F.coalesce(F.col(last_removal), F.lit(0))
    return (F.col("event_type") == CART_ADD) & F.col("_bought_event_id").isNotNull() & kept


def _surviving(placed: DataFrame, hot: HotKeys | None) -> DataFrame:
    """The adds that are still in the cart when the purchase of their stretch comes."""
    ordinary, oversized = split_hot(placed, CART_KEYS, hot)
    in_stretch = Window.partitionBy(*STRETCH)
    of_product = Window.partitionBy(*STRETCH, "_sku")
    # All windows lie within a session, so the exchange that placed the events serves them too.
    marked = ordinary.select(
        "*",
        *(value.over(in_stretch).alias(name) for name, value in _purchase().items()),
        _last_removal().over(of_product).alias("_removed"),
    )
    kept = marked.where(_is_in_cart("_removed")).drop("_removed")
    if oversized is None:
        return kept
    # Of a session that does not fit into a task, purchases and removals are summed up before they are joined.
    stretches = oversized.groupBy(*(F.col(c).alias(f"_of_{c}") for c in STRETCH)).agg(
        *(value.alias(name) for name, value in _purchase().items())
    ).where("_bought_event_id IS NOT NULL")
    removed = (
        oversized.where(F.col("event_type") == CART_REMOVAL)
        .groupBy(*(F.col(c).alias(f"_from_{c}") for c in (*STRETCH, "_sku")))
        .agg(_last_removal().alias("_removed"))
    )

    def same(prefix: str, *names: str) -> Column:
        together = F.lit(True)
        for name in names:
            together = together & F.col(name).eqNullSafe(F.col(f"{prefix}{name}"))
        return together

    adds = oversized.where(F.col("event_type") == CART_ADD)
    joined = adds.join(stretches, same("_of_", *STRETCH)).join(removed, same("_from_", *STRETCH, "_sku"), "left")
    return kept.unionByName(joined.where(_is_in_cart("_removed")).select(kept.columns))


def session_carts(events: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """What each purchase of each session bought, one row per item, from nested events.

    Columns: session_id, purchase_id (its event), purchased_at, position (from 1, in the order of the adds),
    product_id, product_name, price, and cart_total. Events are ordered by time, then event id, and the
    items of one event by their place in it. Items of a NULL product are one product. A purchase with an
    empty cart has no row; without a price an item adds nothing to the total, and a cart without any
    price has the total 0. ``hot`` holds keys by :data:`CART_KEYS`; sessions and carts of any size are
    safe with it.
    """
    moves = cart_moves(events).select(
        "session_id",
        "event_id",
        "event_timestamp",
        "event_type",
        "item_no",
        F.col("item.SKU").alias("_sku"),
        F.col("item.name").alias("_name"),
        F.col("item.priceTotal").alias("_price"),
    )
    placed = ordered_context(
        moves,
        CART_KEYS,
        ("event_timestamp", "event_id", "item_no"),
        number="_place",
        running={"_stretch": F.when(F.col("event_type") == PURCHASE, 1).otherwise(0)},
        hot=hot,
        ties=True,
    )
    kept = _surviving(placed, hot)
    many = None if hot is None else hot_keys(kept, STRETCH, hot.limit)
    carts = ordered_context(
        kept,
        STRETCH,
        ("_place",),
        number="position",
        totals={"_total": F.sum(amount(F.col("_price")))},
        hot=many,
    )
    return carts.select(
        "session_id",
        F.col("_bought_event_id").alias("purchase_id"),
        F.col("_bought_event_timestamp").alias("purchased_at"),
        "position",
        F.col("_sku").alias("product_id"),
        F.col("_name").alias("product_name"),
        F.col("_price").alias("price"),
        F.coalesce(F.col("_total").cast("double"), F.lit(0.0)).alias("cart_total"),
    )


def checked_purchases(events: DataFrame, carts: DataFrame) -> DataFrame:
    """Every purchase with the items and total it states, and those of the cart that led to it.

    ``carts`` are the :func:`session_carts` of the same events; a purchase has to fit into a row, as its
    event does. The stated total is that of the order, or of the items where the order has none.
    """
    keys = ("session_id", "purchase_id")
    found = carts.where("purchase_id IS NOT NULL").groupBy(*keys).agg(
        F.count("*").alias("cart_items"),
        F.max("cart_total").alias("cart_total"),
        F.sort_array(F.collect_list(F.coalesce("product_id", F.lit("")))).alias("_cart"),
    )
    line = lambda item: F.struct(F.coalesce(item["SKU"], F.lit("")).alias("SKU"), item["priceTotal"].alias("priceTotal"))
    purchases = events.where(F.col("eventType") == PURCHASE).select(
        F.col("web.webSession.ID").alias("session_id"),
        F.col("_id").alias("purchase_id"),
        F.transform("productListItems", line).alias("_lines"),
        F.col("commerce.order.priceTotal").alias("_total"),
    )
    stated = purchases.select(
        *keys,
        F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint").alias("stated_items"),
        F.coalesce("_total", cart_total(F.col("_lines"))).alias("stated_total"),
        F.sort_array("_lines.SKU").alias("_stated"),
        F.lit(True).alias("_is_stated"),
    )
    # A join that takes NULL sessions for equal would exchange both sides; a union keeps the partitioning by session that they share.
    same = Window.partitionBy(*keys)
    joined = stated.unionByName(found, allowMissingColumns=True).select(
        *stated.columns,
        *(F.first(c, ignorenulls=True).over(same).alias(c) for c in ("cart_items", "cart_total", "_cart")),
    )
    nothing = F.array().cast("array<string>")
    return joined.where("_is_stated").select(
        *keys,
        "stated_items",
        "stated_total",
        F.coalesce("cart_items", F.lit(0)).cast("bigint").alias("cart_items"),
        F.coalesce("cart_total", F.lit(0.0)).alias("cart_total"),
        (F.coalesce("_stated", nothing) == F.coalesce("_cart", nothing)).alias("agrees"),
    )
