"""The data-validation suite over the marketplace tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import DEFAULT_RULES, StatusRules, days_between, is_eligible
from ..operators.joins import assemble_row
from ..operators.quality import (
    conditional_counts,
    distinct_counts,
    duplicate_key_summary,
    null_counts,
    orphan_counts,
    quality_profile,
)

# Fixed list: primary keys, checked one by one.
KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id", "order_id"],
}


def key_cardinality(tables: Mapping[str, DataFrame], approximate: bool = False) -> DataFrame:
    return distinct_counts(
        {
            "distinct_orders": (tables["orders"], "order_id"),
            "distinct_customers": (tables["customers"], "customer_id"),
            "distinct_unique_customers": (tables["customers"], "customer_unique_id"),
            "distinct_products": (tables["products"], "product_id"),
            "distinct_sellers": (tables["sellers"], "seller_id"),
        },
        approximate,
    )


def key_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    return duplicate_key_summary({name: (tables[name], keys) for name, keys in KEYS.items()})


def relationship_nulls(tables: Mapping[str, DataFrame]) -> DataFrame:
    items = tables["order_items"]
    return null_counts(
        {
            "orders_customer_id_nulls": (tables["orders"], "customer_id"),
            "items_order_id_nulls": (items, "order_id"),
            "items_product_id_nulls": (items, "product_id"),
            "items_seller_id_nulls": (items, "seller_id"),
            "payments_order_id_nulls": (tables["payments"], "order_id"),
            "reviews_order_id_nulls": (tables["reviews"], "order_id"),
        }
    )


def relationship_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    orders = tables["orders"]
    return orphan_counts(
        {
            "orders_without_customer": (orders, tables["customers"], "customer_id"),
            "items_without_order": (tables["order_items"], orders, "order_id"),
            "items_without_product": (tables["order_items"], tables["products"], "product_id"),
            "payments_without_order": (tables["payments"], orders, "order_id"),
            "reviews_without_order": (tables["reviews"], orders, "order_id"),
        }
    )


def quality_counters(
    products: DataFrame,
    payments: DataFrame,
    orders: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
    undefined_type: str = "not_defined",
) -> DataFrame:
    undelivered = (F.col("order_status") == rules.delivered) & F.col("order_delivered_customer_date").isNull()
    return conditional_counts(
        {
            "products_missing_category": (products, F.col("product_category_name").isNull()),
            "zero_installment_payments": (payments, F.col("payment_installments") == 0),
            "undefined_payment_methods": (payments, F.col("payment_type") == undefined_type),
            "delivered_missing_timestamp": (orders, undelivered),
        }
    )


def dataset_profile(datasets: Mapping[str, DataFrame]) -> DataFrame:
    keys = {
        "orders": ["order_id"],
        "items": ["order_id", "order_item_id"],
        "reviews": ["review_id", "order_id"],
        "customers": ["customer_unique_id"],
    }
    return quality_profile({name: (datasets[name], key) for name, key in keys.items()})


def anomaly_counts(orders_ds: DataFrame, items_ds: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """Extremes and impossible values; order figures over eligible orders."""
    prices = items_ds.agg(
        F.min("price").cast("double").alias("minimum_item_price"),
        F.max("price").cast("double").alias("maximum_item_price"),
        F.count_if(F.col("price") < 0).alias("negative_item_prices"),
        F.count_if(F.col("freight_value") < 0).alias("negative_freight_values"),
    )
    took = days_between("purchase_timestamp", "delivered_customer_at")
    times = orders_ds.filter(is_eligible(rules)).agg(
        F.count_if(took < 0).alias("negative_delivery_durations"),
        F.min("purchase_timestamp").alias("purchase_date_min"),
        F.max("purchase_timestamp").alias("purchase_date_max"),
    )
    return assemble_row(prices, times)


# --- request validation ---------------------------------------------------

# Bounds of the scoring inputs: (column, lower, upper); None leaves a side open.
_BOUNDED = (
    ("purchase_month", 1, 12),
    ("purchase_day_of_week", 1, 7),
    ("purchase_hour", 0, 23),
    ("customer_zip_region", 0, 99),
    ("item_value", 0, None),
    ("freight_value", 0, None),
    ("item_count", 1, None),
    ("unique_products", 1, None),
    ("seller_count", 1, None),
    ("total_product_weight_g", 0, None),
    ("average_product_length_cm", 0, None),
    ("average_product_height_cm", 0, None),
    ("average_product_width_cm", 0, None),
    ("payment_value", 0, None),
    ("payment_installments", 0, None),
)


def delivery_request_rules(state_length: int | None = 2) -> dict[str, Column]:
    """One rule per scoring feature. ``state_length`` None accepts any non-empty
    state name."""
    rules: dict[str, Column] = {}
    for name, low, high in _BOUNDED:
        value = F.col(name)
        rules[name] = value >= low if high is None else value.between(low, high)
    rules["estimated_delivery_window_days"] = F.col("estimated_delivery_window_days") > 0
    for name in ("customer_state", "dominant_seller_state"):
        length = F.length(name)
        rules[name] = length >= 1 if state_length is None else length == state_length
    rules["dominant_product_category"] = F.length("dominant_product_category") >= 1
    rules["same_customer_seller_state"] = F.col("same_customer_seller_state").isin("yes", "no")
    rules["payment_type"] = F.length("payment_type") >= 1
    return rules


def segment_request_rules() -> dict[str, Column]:
    return {name: F.col(name) >= 0 for name in ("recency", "frequency", "monetary")}
