"""The nine marketplace tables: declared columns, types, keys and CSV layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()
_TS = T.TimestampNTZType()
_MONEY, _SIZE, _DEGREES = T.DecimalType(12, 2), T.DecimalType(10, 2), T.DecimalType(10, 7)


def _struct(*columns: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], c[2] if len(c) > 2 else True) for c in columns])


@dataclass(frozen=True)
class TableSpec:
    """One table: its schema, primary key, and how its CSV file differs from it.

    ``header_names`` maps a table column to the (misspelt) CSV header it comes
    from; every other column is called the same in both.
    """

    name: str
    filename: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    header_names: tuple[tuple[str, str], ...] = ()
    # Free text with line breaks: such a file cannot be split, so only the table
    # that needs it pays; store it as many files.
    multiline: bool = False

    @property
    def headers(self) -> list[str]:
        renamed = dict(self.header_names)
        return [renamed.get(name, name) for name in self.schema.names]

    @property
    def timestamps(self) -> list[str]:
        return [f.name for f in self.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]


CUSTOMERS = TableSpec(
    "customers",
    "customers.csv",
    _struct(
        ("customer_id", _S, False),
        ("customer_unique_id", _S, False),
        ("customer_zip_code_prefix", _I),
        ("customer_city", _S),
        ("customer_state", _S),
    ),
    ("customer_id",),
)

PRODUCTS = TableSpec(
    "products",
    "products.csv",
    _struct(
        ("product_id", _S, False),
        ("product_category_name", _S),
        ("product_name_length", _I),
        ("product_description_length", _I),
        ("product_photos_qty", _I),
        ("product_weight_g", _MONEY),
        ("product_length_cm", _SIZE),
        ("product_height_cm", _SIZE),
        ("product_width_cm", _SIZE),
    ),
    ("product_id",),
    (
        ("product_name_length", "product_name_lenght"),
        ("product_description_length", "product_description_lenght"),
    ),
)

SELLERS = TableSpec(
    "sellers",
    "sellers.csv",
    _struct(
        ("seller_id", _S, False),
        ("seller_zip_code_prefix", _I),
        ("seller_city", _S),
        ("seller_state", _S),
    ),
    ("seller_id",),
)

TRANSLATION = TableSpec(
    "product_category_translation",
    "product_category_translation.csv",
    _struct(("product_category_name", _S, False), ("product_category_name_english", _S)),
    ("product_category_name",),
)

GEOLOCATION = TableSpec(
    "geolocation",
    "geolocation.csv",
    _struct(
        ("geolocation_zip_code_prefix", _I),
        ("geolocation_lat", _DEGREES),
        ("geolocation_lng", _DEGREES),
        ("geolocation_city", _S),
        ("geolocation_state", _S),
    ),
)

ORDERS = TableSpec(
    "orders",
    "orders.csv",
    _struct(
        ("order_id", _S, False),
        ("customer_id", _S, False),
        ("order_status", _S, False),
        ("order_purchase_timestamp", _TS, False),
        ("order_approved_at", _TS),
        ("order_delivered_carrier_date", _TS),
        ("order_delivered_customer_date", _TS),
        ("order_estimated_delivery_date", _TS),
    ),
    ("order_id",),
)

ORDER_ITEMS = TableSpec(
    "order_items",
    "order_items.csv",
    _struct(
        ("order_id", _S, False),
        ("order_item_id", _I, False),
        ("product_id", _S, False),
        ("seller_id", _S, False),
        ("shipping_limit_date", _TS),
        ("price", _MONEY),
        ("freight_value", _MONEY),
    ),
    ("order_id", "order_item_id"),
)

PAYMENTS = TableSpec(
    "payments",
    "payments.csv",
    _struct(
        ("order_id", _S, False),
        ("payment_sequential", _I, False),
        ("payment_type", _S),
        ("payment_installments", _I),
        ("payment_value", _MONEY),
    ),
    ("order_id", "payment_sequential"),
)

REVIEWS = TableSpec(
    "reviews",
    "reviews.csv",
    _struct(
        ("review_id", _S, False),
        ("order_id", _S, False),
        ("review_score", T.ShortType()),
        ("review_comment_title", _S),
        ("review_comment_message", _S),
        ("review_creation_date", _TS),
        ("review_answer_timestamp", _TS),
    ),
    ("review_id", "order_id"),
    multiline=True,
)

# Parents come before the tables that refer to them.
TABLES = (CUSTOMERS, PRODUCTS, SELLERS, TRANSLATION, GEOLOCATION, ORDERS, ORDER_ITEMS, PAYMENTS, REVIEWS)

# (child, column, parent, parent column)
REFERENCES = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("reviews", "order_id", "orders", "order_id"),
)
