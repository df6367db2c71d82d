"""Event types, funnel stages and segments as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The event types of the stream, the funnel stage each stands for, and the stage names.
PAGE_VIEW = "web.webpagedetails.pageViews"
PRODUCT_VIEW = "commerce.productViews"
CART_ADD = "commerce.productListAdds"
CART_REMOVAL = "commerce.productListRemovals"
PURCHASE = "commerce.purchases"

STAGE_OF_EVENT = {PAGE_VIEW: 1, PRODUCT_VIEW: 2, CART_ADD: 3, CART_REMOVAL: 3, PURCHASE: 4}
STAGE_NAMES = {1: "page_view", 2: "product_view", 3: "add_to_cart", 4: "purchase"}
UNKNOWN = "unknown"


def map_text(entries: dict) -> str:
    """A literal map as SQL text."""
    return f"map({', '.join(repr(x) for x in chain.from_iterable(entries.items()))})"


def flag_text(event_type: str, column: str = "eventType") -> str:
    """SQL text for 1 where the event is of a type, else 0."""
    return f"CASE WHEN {column} = '{event_type}' THEN 1 ELSE 0 END"


def stage_text(column: str = "eventType") -> str:
    """SQL text for the funnel stage of an event type; 0 for a type outside the funnel."""
    return f"coalesce({map_text(STAGE_OF_EVENT)}[{column}], 0)"


def stage_name(stage: str) -> Column:
    """Name of the stage in a column, ``unknown`` if it is none of the four."""
    return F.expr(f"coalesce({map_text(STAGE_NAMES)}[{stage}], '{UNKNOWN}')")


def stage_number(name: str) -> Column:
    """Inverse of :func:`stage_name`, 0 for ``unknown``; the sort key of the stage report."""
    return F.expr(f"coalesce({map_text({v: k for k, v in STAGE_NAMES.items()})}[{name}], 0)")


def at_least_stage(deepest: Column, stage: int) -> Column:
    """Whether a session reached a stage: its deepest stage is that stage or a later one.

    No order is implied: a session of one purchase counts for all four stages.
    """
    return deepest >= stage


def engagement_segment(sessions: Column, converted: Column) -> Column:
    """One of four segments by number of sessions and conversion, else ``unknown``."""
    single, several, unconverted = sessions == 1, sessions > 1, ~converted
    return (
        F.when(single & unconverted, "single_session_bounced")
        .when(single & converted, "single_session_converted")
        .when(several & unconverted, "multi_session_not_converted")
        .when(several & converted, "multi_session_converted")
        .otherwise(UNKNOWN)
    )
