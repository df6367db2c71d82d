"""Schemas of the event stream and of the retail files."""

from __future__ import annotations

# Field names and types of one nested event.
_COUNTER = "struct<value:int>"
EVENT_FIELDS = {
    "_id": "string",
    "timestamp": "string",
    "eventType": "string",
    "identityMap": "map<string, array<struct<id:string, primary:boolean>>>",
    "environment": "struct<type:string, operatingSystem:string, deviceCategory:string>",
    "web": (
        "struct<webSession:struct<ID:string>,"
        " webPageDetails:struct<name:string, URL:string>,"
        " webReferrer:struct<URL:string, type:string>>"
    ),
    "productListItems": "array<struct<SKU:string, name:string, priceTotal:double, quantity:int>>",
    "commerce": (
        f"struct<productViews:{_COUNTER}, productListAdds:{_COUNTER},"
        f" productListRemovals:{_COUNTER}, purchases:{_COUNTER},"
        " order:struct<purchaseID:string, priceTotal:double, currencyCode:string,"
        " payments:array<struct<paymentType:string>>>>"
    ),
}

CORRUPT = "_corrupt_record"


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())


EVENT_DDL = ddl(EVENT_FIELDS)

# The retail tables, each loaded from <prefix><table>_dataset.csv, but for one file
# whose name differs.
RETAIL_TABLES = (
    "customers",
    "orders",
    "order_items",
    "order_payments",
    "order_reviews",
    "products",
    "sellers",
    "geolocation",
)
TRANSLATION_FILE = "product_category_name_translation.csv"
TRANSLATION_TABLE = "product_category_translation"


def retail_files(prefix: str = "") -> dict[str, str]:
    """File name to table name for the nine retail files."""
    files = {f"{prefix}{table}_dataset.csv": table for table in RETAIL_TABLES}
    files[TRANSLATION_FILE] = TRANSLATION_TABLE
    return files
