"""The analytical datasets, each at one stated grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    DEFAULT_RULES,
    StatusRules,
    calendar_columns,
    category_label,
    days_between,
    delivery_status,
    duration_columns,
    is_delivered,
    is_eligible,
)
from ..operators.joins import date_spine, join_at_grain, lookup_join, star_join
from .customers import customers_dataset
from .validation import quality_counters

ORDER_COLUMNS = {
    "order_purchase_timestamp": "purchase_timestamp",
    "order_approved_at": "approved_at",
    "order_delivered_carrier_date": "delivered_carrier_at",
    "order_delivered_customer_date": "delivered_customer_at",
    "order_estimated_delivery_date": "estimated_delivery_at",
}


def orders_dataset(orders: DataFrame, customers: DataFrame, payments: DataFrame, items: DataFrame) -> DataFrame:
    """Order grain; payments and freight are summed per order first. Timestamps
    the source lacks are left out."""
    located = lookup_join(orders, customers, "customer_id")
    paid = join_at_grain(
        located,
        payments,
        "order_id",
        {"order_value": F.sum("payment_value"), "maximum_installments": F.max("payment_installments")},
        how="left",
    )
    charged = join_at_grain(paid, items, "order_id", {"freight_value": F.sum("freight_value")}, how="left", fill=0)
    times = [F.col(old).alias(new) for old, new in ORDER_COLUMNS.items() if old in orders.columns]
    return charged.select(
        "order_id",
        "customer_unique_id",
        "order_status",
        *times,
        "order_value",
        "maximum_installments",
        "freight_value",
        "customer_city",
        "customer_state",
    )


def orders_features(dataset: DataFrame) -> DataFrame:
    """Calendar and duration columns, all known when the order is complete."""
    return dataset.withColumns(calendar_columns("purchase_timestamp")).withColumns(
        duration_columns("purchase_timestamp", "delivered_customer_at", "estimated_delivery_at")
    )


def items_dataset(items: DataFrame, orders: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Item grain with category and order status."""
    star = star_join(
        items,
        orders.select("order_id", "order_status"),
        products.select("product_id", "product_category_name"),
        translation,
    )
    return star.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        "product_category_name",
        category_label().alias("category_english"),
        "order_status",
    )


def reviews_dataset(reviews: DataFrame, orders: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """Review grain with the order's punctuality; no item join."""
    delay = days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    outcome = orders.select(
        "order_id",
        delivery_status(rules).alias("delivery_status"),
        F.when(is_delivered(rules), delay).alias("delivery_delay_days"),
    )
    joined = lookup_join(reviews, outcome, "order_id")
    return joined.select(
        "review_id",
        "order_id",
        "review_score",
        "review_creation_date",
        "review_answer_timestamp",
        "delivery_status",
        "delivery_delay_days",
    )


def daily_series(
    orders: DataFrame,
    payments: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Orders and revenue per calendar day, zero on days without orders, cut to
    the modelling window when one is given."""
    valued = join_at_grain(
        orders.filter(is_eligible(rules)), payments, "order_id", {"order_value": F.sum("payment_value")}, how="left", fill=0
    )
    observed = valued.groupBy(F.col("order_purchase_timestamp").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("daily_orders"), F.sum("order_value").alias("daily_revenue")
    )
    full = date_spine(observed, "date", ["daily_orders", "daily_revenue"])
    if start:
        full = full.filter(F.col("date") >= F.lit(start).cast("date"))
    if end:
        full = full.filter(F.col("date") <= F.lit(end).cast("date"))
    return full


def load_datasets(tables: dict[str, DataFrame], rules: StatusRules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The four analytical datasets and the quality counters, all lazy."""
    t = tables
    orders = orders_dataset(t["orders"], t["customers"], t["payments"], t["order_items"])
    return {
        "orders": orders_features(orders),
        "items": items_dataset(t["order_items"], t["orders"], t["products"], t["product_category_translation"]),
        "reviews": reviews_dataset(t["reviews"], t["orders"], rules),
        "customers": customers_dataset(t["orders"], t["customers"], t["payments"], rules),
        "quality": quality_counters(t["products"], t["payments"], t["orders"], rules),
    }
