from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartograin.functions.expressions import StatusRules
from cartograin.operators import joins
from cartograin.plans import customers, sales

RULES = StatusRules()


@pytest.fixture
def shop(spark):
    ts = datetime
    orders = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", ts(2020, 1, 5)),
            ("o2", "c2", "shipped", ts(2020, 1, 9)),
            ("o3", "c3", "delivered", ts(2020, 1, 9)),
            ("o4", "c1", "canceled", ts(2020, 3, 1)),
        ],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz",
    )
    people = spark.createDataFrame(
        [("c1", "u1", "SP", "a"), ("c2", "u1", "RJ", "b"), ("c3", "u2", "MG", "c")],
        "customer_id string, customer_unique_id string, customer_state string, customer_city string",
    )
    payments = spark.createDataFrame(
        [("o1", "card", 1, 10.0), ("o1", "slip", 2, 20.0), ("o1", "card", 1, 5.0), ("o3", "slip", 3, 7.5), ("o4", "card", 1, 99.0)],
        "order_id string, payment_type string, payment_installments int, payment_value double",
    ).withColumn("payment_value", F.col("payment_value").cast("decimal(12,2)"))
    return orders, people, payments


def test_each_payment_counts_once_and_unpaid_orders_follow_the_join_type(shop):
    orders, _, payments = shop
    inner = sales.paid_orders(orders, payments, RULES)
    assert [(r.order_id, float(r.order_value)) for r in inner.orderBy("order_id").collect()] == [("o1", 35.0), ("o3", 7.5)]
    left = sales.monthly_sales(orders, payments, RULES)
    assert rows(left) == [(date(2020, 1, 1), 3, 42.5, 21.25)]
    growth = sales.monthly_sales_growth(orders, payments, RULES, min_orders=1)
    assert growth.select("orders").first()[0] == 2


def test_growth_needs_the_month_before_and_enough_orders(spark):
    months = [date(2020, 1, 1), date(2020, 2, 1), date(2020, 4, 1)]
    sizes = [100, 99, 100]
    data = [(f"{m}-{i}", "c", "delivered", datetime(m.year, m.month, 2)) for m, n in zip(months, sizes) for i in range(n)]
    orders = spark.createDataFrame(data, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz")
    payments = orders.select("order_id", F.lit(2).cast("decimal(12,2)").alias("payment_value"))
    result = sales.monthly_sales_growth(orders, payments, RULES)
    assert [r.mom_revenue_growth_pct for r in result.collect()] == [None, None, None]
    relaxed = sales.monthly_sales_growth(orders, payments, RULES, min_orders=99)
    assert [r.mom_revenue_growth_pct for r in relaxed.collect()] == [None, -1.0, None]


def test_snapshot_dates_differ_with_a_late_cancelled_order(shop):
    orders, people, payments = shop
    all_orders = customers.rfm_averages(orders, people, payments, RULES).first()
    eligible = customers.rfm_dataset(orders, people, payments, RULES)
    assert eligible.select("reference_date").distinct().collect()[0][0] == date(2020, 1, 10)
    assert all_orders.average_recency_days > 50


def test_latest_location_breaks_ties_by_order_id(shop):
    orders, people, payments = shop
    found = {r.customer_unique_id: r for r in customers.customers_dataset(orders, people, payments, RULES).collect()}
    assert (found["u1"].customer_state, found["u1"].order_count, float(found["u1"].total_spend)) == ("RJ", 2, 35.0)
    same = orders.withColumn("order_purchase_timestamp", F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz"))
    tied = {r.customer_unique_id: r for r in customers.customers_dataset(same, people, payments, RULES).collect()}
    assert tied["u1"].customer_state == "SP"


def test_dominant_value_takes_the_first_name_on_a_tie(spark):
    detail = spark.createDataFrame(
        [(1, "b"), (1, "a"), (2, "z"), (2, "z"), (2, "a"), (3, None)], "order_id int, category string"
    )
    assert rows(joins.dominant_value(detail, "order_id", "category"), "order_id") == [(1, "a"), (2, "z"), (3, None)]
    weighted = detail.withColumn("w", F.when(F.col("category") == "b", 9).otherwise(1))
    assert rows(joins.dominant_value(weighted, "order_id", "category", F.col("w")), "order_id")[0] == (1, "b")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spreading_a_hot_key_changes_no_row(spark, spread, how):
    left = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 500).alias("k"),
        (F.col("id") % 5).alias("v"),
    )
    right = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    heavy = joins.hot_keys(left, ["k"]).collect()
    assert len(heavy) >= 1 and max(r["_pieces"] for r in heavy) >= 2
    plain = joins.lookup_join(left, right, "k", how)
    spread_out = joins.spread_join(left, right, "k", left, how)
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread_out.collect()))
    assert plain.columns == spread_out.columns


def test_hot_key_lands_in_several_tasks(spark, spread):
    left = spark.range(0, 4000, numPartitions=8).select(F.lit(1).cast("bigint").alias("k"), F.lit("copy").alias("v"))
    right = spark.createDataFrame([(1, "x")], "k bigint, w string")
    joined = joins.spread_join(left, right, "k", left)
    tasks = joined.select(F.spark_partition_id().alias("p")).distinct().count()
    assert joined.count() == 4000 and tasks > 1


def test_small_right_side_is_broadcast(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    right = spark.range(10).withColumnRenamed("id", "k")
    plan = joins.lookup_join(left, right, "k")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "BroadcastHashJoin" in plan and "_bucket" not in plan


def test_date_spine_fills_gaps_per_series(spark):
    data = [("a", date(2020, 1, 1), 5), ("a", date(2020, 1, 4), 6), ("b", date(2020, 1, 2), 1)]
    df = spark.createDataFrame(data, "s string, d date, v int")
    found = rows(joins.date_spine(df, "d", ["v"], ["s"]), "s", "d")
    assert [r[2] for r in found] == [5, 0, 0, 6, 1] and len(found) == 5


def test_orphans_and_shifted_months(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert sorted(map(str, rows(joins.orphans(child, parent, "k")))) == ["(2,)", "(None,)"]
    monthly = spark.createDataFrame([(date(2020, 1, 1), 10), (date(2020, 3, 1), 30)], "month date, n int")
    assert rows(joins.shift_self_join(monthly, "month", {"_ago": 1}, ["n"]), "month") == [(date(2020, 1, 1), 10, None), (date(2020, 3, 1), 30, None)]
