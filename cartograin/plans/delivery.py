"""Delivery duration and punctuality of delivered orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    DEFAULT_RULES,
    StatusRules,
    count_where,
    days_between,
    equal_width_bucket,
    is_delivered,
    is_late,
    mean,
    mean_where,
    money,
    month_start,
    percent,
    punctuality,
)
from ..operators.joins import join_at_grain, lookup_join

PURCHASED, DELIVERED, PROMISED = (
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def _late_rate() -> Column:
    return percent(count_where(is_late()), F.count(F.lit(1)))


def _average_days() -> Column:
    return mean(days_between(PURCHASED, DELIVERED))


def delivery_summary(orders: DataFrame, customers: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    known = lookup_join(orders.filter(is_delivered(rules)), customers.select("customer_id"), "customer_id", "left_semi")
    delay = days_between(PROMISED, DELIVERED)
    return known.agg(
        F.round(_average_days(), 2).alias("average_delivery_days"),
        F.round(mean(days_between(PURCHASED, PROMISED)), 2).alias("average_estimated_days"),
        count_where(punctuality(delay) == "early").alias("early_deliveries"),
        count_where(punctuality(delay) == "on_time").alias("on_time_deliveries"),
        count_where(punctuality(delay) == "late").alias("late_deliveries"),
        F.round(_late_rate(), 2).alias("late_delivery_rate_pct"),
        F.round(mean_where(delay, delay > 0), 2).alias("average_late_delay_days"),
    )


def delivery_by_state(orders: DataFrame, customers: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """Delivered orders are summed per customer before the state is looked up."""
    days = days_between(PURCHASED, DELIVERED)
    per_id = (
        orders.filter(is_delivered(rules))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(days).alias("days"), count_where(is_late()).alias("late"))
    )
    located = per_id.join(customers.select("customer_id", "customer_state"), "customer_id")
    rate = F.round(percent(F.sum("late"), F.sum("n")), 2)
    return (
        located.groupBy("customer_state")
        .agg(
            F.sum("n").alias("delivered_orders"),
            F.round(F.sum("days") / F.sum("n"), 2).alias("average_delivery_days"),
            rate.alias("late_delivery_rate_pct"),
        )
        .orderBy(F.desc("late_delivery_rate_pct"), "customer_state")
    )


def delivery_by_month(orders: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    return (
        orders.filter(is_delivered(rules))
        .groupBy(month_start(PURCHASED).alias("purchase_month"))
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            F.round(_average_days(), 2).alias("average_delivery_days"),
            F.round(_late_rate(), 2).alias("late_delivery_rate_pct"),
        )
        .orderBy("purchase_month")
    )


def monthly_delivery(orders: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """Unrounded figures of the service."""
    return (
        orders.filter(is_delivered(rules))
        .groupBy(month_start(PURCHASED).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            _average_days().alias("average_delivery_days"),
            _late_rate().alias("late_delivery_rate"),
        )
        .orderBy("month")
    )


def freight_buckets(
    orders: DataFrame,
    items: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
    low: float = 0,
    high: float = 200,
    buckets: int = 5,
) -> DataFrame:
    delivered = orders.filter(is_delivered(rules))
    charged = join_at_grain(delivered, items, "order_id", {"freight_value": F.sum("freight_value")})
    return (
        charged.groupBy(equal_width_bucket("freight_value", low, high, buckets).alias("freight_bucket"))
        .agg(
            money(F.min("freight_value")).alias("minimum_freight"),
            money(F.max("freight_value")).alias("maximum_freight"),
            F.count(F.lit(1)).alias("orders"),
            F.round(_average_days(), 2).alias("average_delivery_days"),
        )
        .orderBy("freight_bucket")
    )
