"""Review scores and payment behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import (
    DEFAULT_RULES,
    StatusRules,
    days_between,
    delay_band,
    delivery_status,
    installment_band,
    is_delivered,
    mean,
    money,
    ratio,
)
from ..operators.joins import lookup_join
from ..operators.ranking import share_of_total


def review_summary(reviews: DataFrame) -> DataFrame:
    return reviews.agg(
        F.round(mean("review_score"), 3).alias("average_review_score"), F.count(F.lit(1)).alias("reviews")
    )


def review_distribution(reviews: DataFrame) -> DataFrame:
    counted = reviews.groupBy("review_score").agg(F.count(F.lit(1)).alias("reviews"))
    shared = share_of_total(counted, "reviews", "share", bounded=True)
    return shared.select("review_score", "reviews", F.round("share", 2).alias("review_percentage")).orderBy("review_score")


def order_review_sums(reviews: DataFrame) -> DataFrame:
    """Reviews per order as mergeable sums."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("scored"),
    )


def _delivered_reviews(reviews: DataFrame, orders: DataFrame, rules: StatusRules) -> DataFrame:
    return lookup_join(orders.filter(is_delivered(rules)), order_review_sums(reviews), "order_id")


def _review_measures() -> list:
    return [
        F.sum("reviews").alias("reviews"),
        F.round(ratio(F.sum("score_sum"), F.sum("scored")), 3).alias("average_review_score"),
    ]


def review_by_status(reviews: DataFrame, orders: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    known = _delivered_reviews(reviews, orders, rules)
    return known.groupBy(delivery_status(rules).alias("delivery_status")).agg(*_review_measures()).orderBy("delivery_status")


def review_by_delay_band(reviews: DataFrame, orders: DataFrame, rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """Ordered by the shortest delay in each band, which is not reported."""
    delay = days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    known = _delivered_reviews(reviews, orders, rules).withColumn("delay", delay)
    banded = known.groupBy(delay_band("delay").alias("delay_band")).agg(*_review_measures(), F.min("delay").alias("_least"))
    return banded.orderBy("_least").drop("_least")


def payment_types(payments: DataFrame) -> DataFrame:
    """Distinct orders are counted on (type, order) groups, which also carry the
    sums, so the table is shuffled once."""
    pairs = payments.groupBy("payment_type", "order_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("payment_value").alias("value"), F.count("payment_value").alias("valued")
    )
    grouped = pairs.groupBy("payment_type").agg(
        F.sum("n").alias("payment_records"),
        F.count("order_id").alias("orders"),
        F.sum("value").alias("revenue"),
        F.round(ratio(F.sum("value"), F.sum("valued")), 2).alias("average_payment_value"),
    )
    return grouped.withColumn("revenue", money(F.col("revenue"))).orderBy(F.desc("revenue"), "payment_type")


def installment_mix(payments: DataFrame) -> DataFrame:
    counted = payments.groupBy("payment_installments").agg(
        F.count(F.lit(1)).alias("payment_records"), F.round(mean("payment_value"), 2).alias("average_payment_value")
    )
    shared = share_of_total(counted, "payment_records", "share")
    return shared.select(
        "payment_installments",
        "payment_records",
        F.round("share", 2).alias("payment_percentage"),
        "average_payment_value",
    ).orderBy("payment_installments")


def installment_bands(payments: DataFrame) -> DataFrame:
    banded = payments.groupBy(installment_band("payment_installments").alias("installment_band")).agg(
        F.count(F.lit(1)).alias("payment_records"),
        F.round(mean("payment_value"), 2).alias("average_payment_value"),
        money(F.sum("payment_value")).alias("revenue"),
        F.min("payment_installments").alias("_least"),
    )
    return banded.orderBy(F.col("_least").asc_nulls_last()).drop("_least")


def installment_correlation(payments: DataFrame, payment_type: str = "credit_card") -> DataFrame:
    chosen = payments.filter(F.col("payment_type") == payment_type)
    value, installments = F.col("payment_value").cast("double"), F.col("payment_installments").cast("double")
    return chosen.agg(
        F.round(mean("payment_installments"), 2).alias("average_installments"),
        F.round(F.corr(value, installments), 3).alias("payment_value_installment_correlation"),
    )


