"""Customer value, retention and location."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    DEFAULT_RULES,
    StatusRules,
    count_where,
    customer_type,
    is_eligible,
    mean,
    money,
    percent,
)
from ..operators.joins import assemble_row, latest, with_scalar
from ..operators.ranking import exact_quantiles, share_of_total, top_k
from ..session import checkpointed
from .sales import orders_per_person, paid_orders


def customer_activity(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
    paid_only: bool = True,
    location: bool = False,
) -> DataFrame:
    """One row per person with eligible orders: count, spend, first and last
    purchase, and optionally the location of the latest order.

    Orders are reduced per customer id before customers are joined, so neither
    step moves a heavy customer's orders into one task.
    """
    valued = paid_orders(orders, payments, rules, how="inner" if paid_only else "left")
    ts = "order_purchase_timestamp"
    per_id = valued.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.coalesce("order_value", F.lit(0))).alias("total_spend"),
        F.min(ts).alias("first_purchase"),
        F.max(ts).alias("last_purchase"),
        latest(ts, "order_id").alias("_last"),
    )
    columns = ["customer_id", "customer_unique_id"]
    if location:
        columns += ["customer_state", "customer_city"]
    joined = per_id.join(customers.select(*columns), "customer_id")
    merged = [
        F.sum("orders").alias("orders"),
        F.sum("total_spend").alias("total_spend"),
        F.min("first_purchase").alias("first_purchase"),
        F.max("last_purchase").alias("last_purchase"),
    ]
    if location:
        where = F.min(F.struct("_last", "customer_state", "customer_city"))
        merged += [where["customer_state"].alias("customer_state"), where["customer_city"].alias("customer_city")]
    return joined.groupBy("customer_unique_id").agg(*merged)


def repeat_rate(orders: DataFrame, customers: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    people = orders_per_person(orders.filter(is_eligible(rules)), customers)
    everyone, repeat = F.count(F.lit(1)), count_where(F.col("orders") > 1)
    return people.agg(
        everyone.alias("unique_customers"),
        F.round(mean("orders"), 3).alias("average_orders_per_customer"),
        count_where(F.col("orders") == 1).alias("one_time_customers"),
        repeat.alias("repeat_customers"),
        F.round(percent(repeat, everyone), 2).alias("repeat_customer_rate_pct"),
    )


def top_customers(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES, k: int = 20
) -> DataFrame:
    activity = customer_activity(orders, customers, payments, rules)
    best = top_k(activity, [F.col("total_spend").desc_nulls_first(), "customer_unique_id"], k)
    return best.select(
        "customer_unique_id", "orders", money(F.col("total_spend")).alias("total_spend"), F.col("last_purchase").alias("last_order_at")
    )


def customer_spend_stats(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES
) -> DataFrame:
    # Averaged and ranked, so written once.
    activity = checkpointed(customer_activity(orders, customers, payments, rules).select("total_spend"))
    average = activity.agg(F.round(mean("total_spend"), 2).alias("average_customer_spend"))
    middle = exact_quantiles(activity, "total_spend", {"median": 0.5})
    return assemble_row(average, middle.select(F.round("median", 2).alias("median_customer_spend")))


def _by_place(orders: DataFrame, customers: DataFrame, rules: StatusRules, place: list[str]) -> DataFrame:
    per_id = orders.filter(is_eligible(rules)).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    located = per_id.join(customers, "customer_id")
    return located.groupBy(*place).agg(
        F.countDistinct("customer_unique_id").alias("unique_customers"), F.sum("n").alias("orders")
    )


def customers_by_state(orders: DataFrame, customers: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    return _by_place(orders, customers, rules, ["customer_state"]).orderBy(F.desc("orders"), "customer_state")


def customers_by_city(orders: DataFrame, customers: DataFrame, rules: StatusRules = DEFAULT_RULES, k: int = 25) -> DataFrame:
    places = _by_place(orders, customers, rules, ["customer_city", "customer_state"])
    return top_k(places, [F.desc("orders"), "customer_city", "customer_state"], k)


def rfm_averages(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES
) -> DataFrame:
    """Snapshot: the day after the last purchase of *any* status."""
    snapshot = orders.agg(F.date_add(F.max("order_purchase_timestamp").cast("date"), 1).alias("snapshot"))
    activity = with_scalar(customer_activity(orders, customers, payments, rules), snapshot)
    recency = F.datediff("snapshot", F.col("last_purchase").cast("date"))
    return activity.agg(
        F.round(mean(recency), 2).alias("average_recency_days"),
        F.round(mean("orders"), 3).alias("average_frequency"),
        F.round(mean("total_spend"), 2).alias("average_monetary_value"),
    )


def customer_type_mix(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES
) -> DataFrame:
    activity = customer_activity(orders, customers, payments, rules, paid_only=False)
    mix = activity.groupBy(customer_type("orders").alias("customer_type")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_spend").alias("revenue")
    )
    shared = share_of_total(mix, "customers", "customer_share", bounded=True)
    shared = share_of_total(shared, "revenue", "revenue_share", bounded=True)
    return shared.withColumn("revenue", F.col("revenue").cast("double")).orderBy(F.desc("customers"))


def customers_dataset(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES
) -> DataFrame:
    """One row per person; unpaid orders count with value 0."""
    activity = customer_activity(orders, customers, payments, rules, paid_only=False, location=True)
    return activity.select(
        "customer_unique_id",
        "first_purchase",
        "last_purchase",
        F.col("orders").alias("order_count"),
        "total_spend",
        "customer_state",
        "customer_city",
    )


def rfm_dataset(
    orders: DataFrame, customers: DataFrame, payments: DataFrame, rules: StatusRules = DEFAULT_RULES
) -> DataFrame:
    """Recency, frequency and monetary value per person. Snapshot: the day after
    the last *eligible* purchase."""
    eligible = orders.filter(is_eligible(rules))
    reference = eligible.agg(F.date_add(F.max("order_purchase_timestamp").cast("date"), 1).alias("reference_date"))
    activity = customer_activity(orders, customers, payments, rules, paid_only=False, location=True)
    return with_scalar(activity, reference).select(
        "customer_unique_id",
        "first_purchase",
        "last_purchase",
        F.datediff("reference_date", F.col("last_purchase").cast("date")).alias("recency"),
        F.col("orders").cast("int").alias("frequency"),
        F.col("total_spend").alias("monetary"),
        "customer_state",
        "customer_city",
        "reference_date",
    )
