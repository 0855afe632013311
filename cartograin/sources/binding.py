"""The driver's star-schema tables in the roles of the marketplace tables.

Column mapping only: every role is a projection (the delivery date is one
aggregate join) over the given Parquet files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import StatusRules
from ..session import tune

# Order statuses of the driver tables in the two special roles.
RULES = StatusRules(excluded=("P",), delivered="F")
DELIVERY_PROMISE = "interval 365 days"


@dataclass
class Roles:
    spark: SparkSession
    folder: str

    def __post_init__(self) -> None:
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def customers(self) -> DataFrame:
        """Two customer ids per person, so people and ids differ."""
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self.table("customer")
            .join(nation, "c_nationkey")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.expr("c_custkey div 2").alias("customer_unique_id"),
                F.expr("cast((c_custkey * 7) % 100000 as int)").alias("customer_zip_code_prefix"),
                F.col("c_mktsegment").alias("customer_city"),
                F.col("n_name").alias("customer_state"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_size") < 50, F.col("p_type")).alias("product_category_name"),
            (F.col("p_size") * 10).cast("decimal(12,2)").alias("product_weight_g"),
            F.col("p_size").cast("decimal(10,2)").alias("product_length_cm"),
            F.when(F.col("p_size") % 7 != 0, F.col("p_size") * 2).cast("decimal(10,2)").alias("product_height_cm"),
            (F.col("p_size") * 3).cast("decimal(10,2)").alias("product_width_cm"),
        )

    @cached_property
    def translation(self) -> DataFrame:
        """Covers only part of the categories; the rest fall back."""
        named = self.table("part").filter(F.col("p_type") < "P")
        return (
            named.select(F.col("p_type").alias("product_category_name"))
            .distinct()
            .withColumn("product_category_name_english", F.lower("product_category_name"))
        )

    @cached_property
    def sellers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return (
            self.table("supplier")
            .join(nation, "s_nationkey")
            .select(F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_state"))
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("geolocation_zip_code_prefix"),
            F.col("n_name").alias("geolocation_state"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        """Without delivery columns: one scan, no join."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
        )

    @cached_property
    def shipped_orders(self) -> DataFrame:
        """Orders with delivered and promised timestamps: delivered is the first
        ship date not before the purchase."""
        orders = self.orders
        # One row per order and date: bounded by the calendar even for a hot order.
        dates = (
            self.table("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"), "l_shipdate")
            .agg(F.count(F.lit(1)).alias("_n"))
        )
        later = F.when(F.col("l_shipdate") >= F.col("order_purchase_timestamp"), F.col("l_shipdate"))
        return (
            orders.join(dates, "order_id", "left")
            .groupBy(*orders.columns)
            .agg(F.min(later).alias("order_delivered_customer_date"))
            .withColumn("order_estimated_delivery_date", F.expr(f"order_purchase_timestamp + {DELIVERY_PROMISE}"))
        )

    @cached_property
    def order_items(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            price.alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(18,4)").alias("freight_value"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        value = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"),
            F.col("l_linenumber").alias("payment_installments"),
            value.cast("decimal(18,4)").alias("payment_value"),
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
            F.col("l_orderkey").alias("order_id"),
            (F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("review_score"),
            F.col("l_shipdate").alias("review_creation_date"),
            F.expr("l_shipdate + interval 2 days").alias("review_answer_timestamp"),
        )

    @cached_property
    def event_series(self) -> DataFrame:
        """Daily event counts, one series per event type."""
        return (
            self.table("events")
            .groupBy(F.col("event_type").alias("series"), F.col("ts").cast("date").alias("date"))
            .agg(F.count(F.lit(1)).cast("double").alias("value"))
        )


def bind(spark: SparkSession, folder: str) -> Roles:
    return Roles(tune(spark), folder)
