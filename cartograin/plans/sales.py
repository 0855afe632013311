"""Order, revenue and executive figures. Revenue is one payment total per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    DEFAULT_RULES,
    StatusRules,
    count_where,
    day_name,
    days_between,
    is_delivered,
    is_eligible,
    is_late,
    iso_weekday,
    mean,
    money,
    month_start,
    percent,
    ratio,
)
from ..operators.joins import assemble_row, join_at_grain, shift_self_join
from ..operators.ranking import exact_quantiles, share_of_total, top_k
from ..session import checkpointed


def paid_orders(orders: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES, how: str = "inner") -> DataFrame:
    """Eligible orders with ``order_value``, the sum of their payments."""
    eligible = orders.filter(is_eligible(rules))
    return join_at_grain(eligible, payments, "order_id", {"order_value": F.sum("payment_value")}, how)


def orders_per_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders per person: counted per customer id first, so a customer with a
    large share of all orders reaches the join as one row."""
    per_id = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_id.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.sum("n").alias("orders"))
    )


def business_overview(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
) -> DataFrame:
    weighted = F.sum(F.col("payment_installments") * F.col("payment_value"))
    eligible = orders.filter(is_eligible(rules))
    valued = join_at_grain(
        eligible.select("order_id"),
        payments,
        "order_id",
        {"order_value": F.sum("payment_value"), "installments": ratio(weighted, F.sum("payment_value"))},
    )
    valued = checkpointed(valued.select("order_value", "installments"))  # averaged and ranked
    people = orders_per_person(eligible, customers).agg(
        F.coalesce(F.sum("orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.count(F.lit(1)).alias("unique_customers"),
    )
    revenue = valued.agg(
        money(F.sum("order_value")).alias("total_revenue"),
        F.round(mean("order_value"), 2).alias("average_order_value"),
        F.round(F.avg("installments"), 2).alias("average_payment_installments"),
    )
    median = exact_quantiles(valued, "order_value", {"median": 0.5}).select(
        F.round("median", 2).alias("median_order_value")
    )
    return assemble_row(
        people,
        products.agg(F.count(F.lit(1)).alias("total_products")),
        sellers.agg(F.count(F.lit(1)).alias("total_sellers")),
        revenue,
        median,
    )


def status_mix(orders: DataFrame) -> DataFrame:
    counted = orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count"))
    shared = share_of_total(counted, "order_count", "share", bounded=True)
    return shared.select("order_status", "order_count", F.round("share", 2).alias("percentage_of_orders")).orderBy(
        F.desc("order_count"), "order_status"
    )


def monthly_totals(paid: DataFrame) -> DataFrame:
    return paid.groupBy(month_start("order_purchase_timestamp").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_value").alias("revenue"),
        mean("order_value").alias("average_order_value"),
    )


def monthly_sales_growth(
    orders: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES, min_orders: int = 100
) -> DataFrame:
    """Growth against the calendar month and year before, only where both months
    have ``min_orders`` orders; a missing month gives NULL."""
    monthly = monthly_totals(paid_orders(orders, payments, rules))
    compared = shift_self_join(monthly, "month", {"_month_ago": 1, "_year_ago": 12}, ["orders", "revenue"])

    def growth(suffix: str):
        enough = (F.col("orders") >= min_orders) & (F.col(f"orders{suffix}") >= min_orders)
        change = percent(F.col("revenue") - F.col(f"revenue{suffix}"), F.col(f"revenue{suffix}"))
        return F.when(enough, F.round(change, 2))

    return compared.select(
        "month",
        "orders",
        money(F.col("revenue")).alias("revenue"),
        F.round("average_order_value", 2).alias("average_order_value"),
        growth("_month_ago").alias("mom_revenue_growth_pct"),
        growth("_year_ago").alias("yoy_revenue_growth_pct"),
    ).orderBy("month")


def top_months(orders: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES, k: int = 10) -> DataFrame:
    monthly = monthly_totals(paid_orders(orders, payments, rules))
    best = top_k(monthly, [F.col("revenue").desc_nulls_first(), "month"], k)
    return best.select("month", money(F.col("revenue")).alias("revenue"), "orders")


def weekday_sales(orders: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    ts = "order_purchase_timestamp"
    return (
        paid_orders(orders, payments, rules)
        .groupBy(iso_weekday(ts).alias("iso_day_of_week"), day_name(ts).alias("day_name"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            money(F.sum("order_value")).alias("revenue"),
            F.round(mean("order_value"), 2).alias("average_order_value"),
        )
        .orderBy("iso_day_of_week")
    )


def _repeat_rate(people: DataFrame, name: str) -> DataFrame:
    everyone, repeat = F.count(F.lit(1)), count_where(F.col("orders") > 1)
    return people.agg(everyone.alias("unique_customers"), percent(repeat, everyone).alias(name))


def _late_rate(orders: DataFrame, rules: StatusRules) -> DataFrame:
    delivered = orders.filter(is_delivered(rules))
    return delivered.agg(
        mean(days_between("order_purchase_timestamp", "order_delivered_customer_date")).alias("days"),
        percent(count_where(is_late()), F.count(F.lit(1))).alias("late_rate"),
    )


def executive_kpis(
    orders: DataFrame, payments: DataFrame, customers: DataFrame, reviews: DataFrame, rules: StatusRules = DEFAULT_RULES
) -> DataFrame:
    """Each figure at its own grain, then placed in one row."""
    eligible = orders.filter(is_eligible(rules))
    paid = paid_orders(orders, payments, rules).agg(
        F.sum("order_value").alias("revenue"), mean("order_value").alias("average")
    )
    row = assemble_row(
        paid,
        eligible.agg(F.count(F.lit(1)).alias("orders")),
        _repeat_rate(orders_per_person(eligible, customers), "repeat_rate"),
        reviews.agg(mean("review_score").alias("score")),
        _late_rate(orders, rules),
    )
    return row.select(
        money(F.col("revenue")).alias("revenue"),
        "orders",
        "unique_customers",
        F.round("average", 2).alias("average_order_value"),
        F.round("repeat_rate", 2).alias("repeat_customer_rate_pct"),
        F.round("score", 3).alias("average_review_score"),
        F.round("late_rate", 2).alias("late_delivery_rate_pct"),
    )


def overview(orders: DataFrame, payments: DataFrame, customers: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """The unrounded headline figures of the service."""
    eligible = orders.filter(is_eligible(rules))
    paid = paid_orders(orders, payments, rules).agg(
        F.sum("order_value").alias("revenue"), mean("order_value").alias("average")
    )
    row = assemble_row(
        eligible.agg(F.count(F.lit(1)).alias("total_eligible_orders")),
        paid,
        _repeat_rate(orders_per_person(eligible, customers), "repeat_customer_rate"),
        _late_rate(orders, rules),
    )
    return row.select(
        "total_eligible_orders",
        F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce("average", F.lit(0.0)).alias("average_order_value"),
        "unique_customers",
        "repeat_customer_rate",
        F.col("days").alias("average_delivery_duration_days"),
        F.col("late_rate").alias("late_delivery_rate"),
    )


def monthly_sales(orders: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """Keeps orders without payment, unlike the growth report."""
    monthly = monthly_totals(paid_orders(orders, payments, rules, how="left"))
    return monthly.select(
        "month",
        "orders",
        F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
        F.coalesce("average_order_value", F.lit(0.0)).alias("average_order_value"),
    ).orderBy("month")
