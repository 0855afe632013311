"""Exploratory tables over the analytical datasets.

Here "delivered" means an eligible order with a delivery time, whatever its
final status; the SQL reports use the stricter definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    DEFAULT_RULES,
    DELAY_LABELS_CHART,
    StatusRules,
    customer_type,
    day_name,
    delay_band,
    delay_band_order,
    is_eligible,
    mean,
    month_start,
    ratio,
)
from ..operators.joins import assemble_row, lookup_join, with_scalar
from ..operators.ranking import exact_quantiles, head_tail, top_k
from ..operators.statistics import hexbin, pearson, spearman, value_counts
from ..operators.timeseries import rolling_mean
from ..session import checkpointed
from .products import order_scores
from .validation import anomaly_counts


def eligible(dataset: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    return dataset.filter(is_eligible(rules))


def delivered(orders_ds: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    return eligible(orders_ds, rules).filter(F.col("delivery_days").isNotNull())


def monthly_complete(orders_ds: DataFrame, rules: StatusRules = DEFAULT_RULES, min_orders: int = 100) -> DataFrame:
    monthly = eligible(orders_ds, rules).groupBy("purchase_year_month").agg(
        F.coalesce(F.sum("order_value").cast("double"), F.lit(0.0)).alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        mean("order_value").alias("average_order_value"),
    )
    return monthly.filter(F.col("orders") >= min_orders).orderBy("purchase_year_month")


def best_month(orders_ds: DataFrame, rules: StatusRules = DEFAULT_RULES, min_orders: int = 100) -> DataFrame:
    complete = monthly_complete(orders_ds, rules, min_orders)
    return top_k(complete, [F.desc("revenue"), "purchase_year_month"], 1).select(
        "purchase_year_month", "revenue", "orders"
    )


def category_totals(items_ds: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    return eligible(items_ds, rules).groupBy("category_english").agg(
        F.sum("price").cast("double").alias("item_revenue"), F.count(F.lit(1)).alias("items_sold")
    )


def top_category_revenue(items_ds: DataFrame, rules: StatusRules = DEFAULT_RULES, k: int = 15) -> DataFrame:
    totals = category_totals(items_ds, rules).select("category_english", "item_revenue")
    return top_k(totals, [F.desc("item_revenue"), "category_english"], k)


def top_category_items(items_ds: DataFrame, rules: StatusRules = DEFAULT_RULES, k: int = 15) -> DataFrame:
    totals = category_totals(items_ds, rules).select("category_english", "items_sold")
    return top_k(totals, [F.desc("items_sold"), "category_english"], k)


def top_category(items_ds: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    return top_category_revenue(items_ds, rules, 1)


def top_state_customers(customers_ds: DataFrame, k: int = 15) -> DataFrame:
    states = value_counts(customers_ds, "customer_state", "customer_state", "customers")
    return top_k(states, [F.desc("customers"), "customer_state"], k)


def top_state_revenue(customers_ds: DataFrame, k: int = 15) -> DataFrame:
    states = customers_ds.groupBy("customer_state").agg(F.sum("total_spend").cast("double").alias("revenue"))
    return top_k(states, [F.desc("revenue"), "customer_state"], k)


def repeat_mix(customers_ds: DataFrame) -> DataFrame:
    return value_counts(customers_ds, customer_type("order_count"), "customer_type", "customers").orderBy(
        F.desc("customers"), "customer_type"
    )


def order_frequency(customers_ds: DataFrame) -> DataFrame:
    return value_counts(customers_ds, "order_count", "order_count", "customers").orderBy("order_count")


def delivery_rates(
    orders_ds: DataFrame, by: str, rules: StatusRules = DEFAULT_RULES, min_orders: int = 100
) -> DataFrame:
    """Late share and mean duration per group with enough orders."""
    grouped = delivered(orders_ds, rules).groupBy(by).agg(
        F.avg(F.col("is_late_delivery").cast("int")).alias("late_rate"),
        mean("delivery_days").alias("delivery_days"),
        F.count(F.lit(1)).alias("orders"),
    )
    return grouped.filter(F.col("orders") >= min_orders)


def review_score_counts(reviews_ds: DataFrame) -> DataFrame:
    return value_counts(reviews_ds, "review_score", "review_score", "reviews").orderBy("review_score")


def review_by_status(reviews_ds: DataFrame) -> DataFrame:
    known = reviews_ds.filter(F.col("delivery_status").isNotNull())
    return known.groupBy("delivery_status").agg(
        mean("review_score").alias("mean"), F.count("review_score").alias("count")
    )


def review_by_delay(reviews_ds: DataFrame) -> DataFrame:
    known = reviews_ds.dropna(subset=["delivery_delay_days", "review_score"])
    banded = known.groupBy(
        delay_band_order("delivery_delay_days").alias("_order"),
        delay_band("delivery_delay_days", DELAY_LABELS_CHART).alias("delay_band"),
    ).agg(mean("review_score").alias("average_review"))
    return banded.orderBy("_order").drop("_order")


def freight_against_days(orders_ds: DataFrame, rules: StatusRules = DEFAULT_RULES, gridsize: int = 45) -> DataFrame:
    return hexbin(delivered(orders_ds, rules), "freight_value", "delivery_days", gridsize)


def value_against_freight(orders_ds: DataFrame, rules: StatusRules = DEFAULT_RULES, gridsize: int = 45) -> DataFrame:
    return hexbin(eligible(orders_ds, rules), "order_value", "freight_value", gridsize)


def value_by_installments(orders_ds: DataFrame, rules: StatusRules = DEFAULT_RULES, min_orders: int = 20) -> DataFrame:
    known = eligible(orders_ds, rules).dropna(subset=["maximum_installments", "order_value"])
    grouped = known.groupBy("maximum_installments").agg(
        mean("order_value").alias("average_order_value"), F.count(F.lit(1)).alias("orders")
    )
    return grouped.filter(F.col("orders") >= min_orders).orderBy("maximum_installments")


def category_review_extremes(
    items_ds: DataFrame,
    reviews_ds: DataFrame,
    rules: StatusRules = DEFAULT_RULES,
    k: int = 8,
    min_items: int = 100,
) -> DataFrame:
    """The lowest and the highest rated categories."""
    # Few items share order and category: grouped by them first, a task would hold nearly all its rows.
    listed = eligible(items_ds, rules).select("order_id", "category_english")
    scored = lookup_join(listed, order_scores(reviews_ds), "order_id")
    grouped = scored.groupBy("category_english").agg(
        F.round(ratio(F.sum("order_score"), F.count(F.lit(1))), 6).alias("average_review"),
        F.count(F.lit(1)).alias("reviewed_items"),
    )
    kept = grouped.filter(F.col("reviewed_items") >= min_items)
    ends = head_tail(
        kept,
        [F.asc("average_review"), F.asc("category_english")],
        [F.desc("average_review"), F.desc("category_english")],
        k,
    )
    return ends.orderBy("average_review", "category_english")


def late_against_ontime(reviews_ds: DataFrame) -> DataFrame:
    """Mean, median and number of scores on either side of the promise."""
    known = reviews_ds.select("delivery_delay_days", "review_score").dropna()
    side = F.when(F.col("delivery_delay_days") > 0, "late").otherwise("ontime")
    sided = checkpointed(known.select(side.alias("side"), "review_score"))  # averaged and ranked
    basics = sided.groupBy("side").agg(mean("review_score").alias("mean"), F.count(F.lit(1)).alias("n"))
    middles = exact_quantiles(sided, "review_score", {"median": 0.5}, by=["side"])
    return basics.join(middles, "side")


def state_duration(orders_ds: DataFrame, states: Sequence[str], rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    chosen = delivered(orders_ds, rules).filter(F.col("customer_state").isin(*states))
    chosen = checkpointed(chosen.select("customer_state", "delivery_days"))  # averaged and ranked
    basics = chosen.groupBy("customer_state").agg(mean("delivery_days").alias("mean"), F.count(F.lit(1)).alias("count"))
    middles = exact_quantiles(chosen, "delivery_days", {"median": 0.5}, by=["customer_state"])
    return basics.join(middles, "customer_state")


def pearson_table(orders_ds: DataFrame, reviews_ds: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    return assemble_row(
        pearson(reviews_ds, "delivery_delay_days", "review_score", "delay_review_pearson"),
        pearson(delivered(orders_ds, rules), "freight_value", "delivery_days", "freight_delivery_pearson"),
        pearson(eligible(orders_ds, rules), "order_value", "freight_value", "order_freight_pearson"),
    )


def spearman_table(orders_ds: DataFrame, reviews_ds: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    return assemble_row(
        spearman(reviews_ds, "delivery_delay_days", "review_score", "delay_review_spearman"),
        spearman(delivered(orders_ds, rules), "freight_value", "delivery_days", "freight_delivery_spearman"),
        spearman(eligible(orders_ds, rules), "order_value", "maximum_installments", "order_installments_spearman"),
    )


METRIC_COLUMNS = (
    "order_status",
    "order_value",
    "maximum_installments",
    "freight_value",
    "customer_state",
    "purchase_timestamp",
    "purchase_year_month",
    "delivered_customer_at",
    "delivery_days",
    "delivery_delay_days",
    "is_late_delivery",
)


def eda_metrics(
    datasets: dict[str, DataFrame], states: Sequence[str], rules: StatusRules = DEFAULT_RULES, min_orders: int = 100
) -> DataFrame:
    """All named figures as (metric, value) text rows, one per metric."""
    # Each dataset is read many times below: its columns are written once.
    orders_ds = checkpointed(datasets["orders"].select(*METRIC_COLUMNS))
    reviews_ds = checkpointed(datasets["reviews"].select("review_score", "delivery_delay_days"))
    customers_ds = datasets["customers"]
    orders = eligible(orders_ds, rules)
    shipped = delivered(orders_ds, rules).filter(F.col("delivery_delay_days").isNotNull())
    # An aggregate, so that one row remains when no month is complete.
    leader = F.min(F.struct((-F.col("revenue")).alias("r"), "purchase_year_month", "revenue", "orders"))
    best = monthly_complete(orders_ds, rules, min_orders).agg(leader.alias("_m")).select(
        F.date_format("_m.purchase_year_month", "yyyy-MM").alias("strongest_complete_month"),
        F.col("_m.revenue").alias("strongest_month_revenue"),
        F.col("_m.orders").alias("strongest_month_orders"),
    )
    known = reviews_ds.dropna(subset=["delivery_delay_days", "review_score"])
    sides = late_against_ontime(reviews_ds)
    split = sides.agg(
        *[
            F.max(F.when(F.col("side") == side, F.col(measure))).alias(f"{side}_review_{measure}")
            for side in ("late", "ontime")
            for measure in ("mean", "median", "n")
        ]
    )
    durations = shipped.agg(
        *[
            mean(F.when(F.col("customer_state") == state, F.col("delivery_days"))).alias(f"{state.lower()}_delivery_mean_days")
            for state in states
        ]
    )
    row = assemble_row(
        orders.agg(
            F.count(F.lit(1)).alias("eligible_orders"),
            F.sum("order_value").cast("double").alias("revenue"),
            mean("order_value").alias("average_order_value"),
        ),
        customers_ds.agg(
            F.count(F.lit(1)).alias("unique_customers"),
            (F.avg((F.col("order_count") > 1).cast("int")) * 100).alias("repeat_customer_rate_pct"),
        ),
        best,
        shipped.agg(
            mean("delivery_days").alias("average_delivery_days"),
            (F.avg(F.col("is_late_delivery").cast("int")) * 100).alias("late_delivery_rate_pct"),
            F.count("freight_value").alias("freight_delivery_n"),
        ),
        reviews_ds.agg(mean("review_score").alias("average_review_score")),
        split,
        known.agg(F.count(F.lit(1)).alias("delay_review_n")),
        pearson_table(orders_ds, reviews_ds, rules),
        spearman_table(orders_ds, reviews_ds, rules),
        anomaly_counts(orders_ds, datasets["items"], rules),
        durations,
        datasets["quality"],
    )
    text = []
    for name, kind in row.dtypes:
        value = F.round(name, 6).cast("decimal(38,6)") if kind == "double" else F.col(name)
        text.append(F.struct(F.lit(name).alias("metric"), value.cast("string").alias("value")))
    return row.select(F.explode(F.array(*text)).alias("m")).select("m.metric", "m.value")


# --- daily series ---------------------------------------------------------


def weekday_means(daily: DataFrame) -> DataFrame:
    return daily.groupBy(day_name("date").alias("weekday")).agg(
        mean("daily_orders").alias("orders"), mean("daily_revenue").alias("revenue")
    ).orderBy(F.desc("orders"), "weekday")


def month_sums(daily: DataFrame) -> DataFrame:
    return daily.groupBy(month_start("date").alias("month")).agg(
        F.sum("daily_orders").alias("daily_orders"), F.sum("daily_revenue").cast("double").alias("daily_revenue")
    ).orderBy("month")


def rolling_means(daily: DataFrame, widths: Sequence[int] = (7, 30)) -> DataFrame:
    out = daily.withColumn("daily_revenue", F.col("daily_revenue").cast("double"))
    for column in ("daily_orders", "daily_revenue"):
        for width in widths:
            out = rolling_mean(out, [], "date", column, width, f"{column}_mean_{width}")
    return out


def spikes(daily: DataFrame, deviations: float = 3.0) -> DataFrame:
    """Days above mean + k sample deviations, counted per measure."""
    measures = ("daily_orders", "daily_revenue")
    value = {c: F.col(c).cast("double") for c in measures}
    limits = daily.agg(*[(F.avg(value[c]) + deviations * F.stddev_samp(value[c])).alias(f"_limit_{c}") for c in measures])
    return with_scalar(daily, limits).agg(*[F.count_if(value[c] > F.col(f"_limit_{c}")).alias(c) for c in measures])


def weekday_residuals(residuals: DataFrame) -> DataFrame:
    return residuals.groupBy("weekday").agg(
        F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"), F.count("residual").alias("count")
    )


def largest_residuals(residuals: DataFrame, k: int = 10) -> DataFrame:
    return top_k(residuals, [F.desc(F.abs("residual")), "date"], k)
