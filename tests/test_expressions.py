from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from cartograin.functions import expressions as X


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def test_delay_edges(spark):
    df = column(spark, [-1.5, -1.0, 0.0, 0.01, 3.0, 7.0, 7.01, None], "double")
    found = rows(df.select("i", X.delay_band("v"), X.delay_band_order("v"), X.punctuality("v")), "i")
    assert [r[2] for r in found] == [0, 0, 0, 1, 1, 2, 3, None]
    assert found[3][1] == "1_to_3_days_late" and found[7][1] is None
    assert [r[3] for r in found] == ["early", "on_time", "on_time", "late", "late", "late", "late", None]


def test_other_bands_and_labels(spark):
    df = column(spark, [0, 1, 2, 6, 12, 13, None], "int")
    assert [r[1] for r in rows(df.select("i", X.installment_band("v")), "i")] == ["1", "1", "2-3", "4-6", "7-12", "13+", "13+"]
    freight = column(spark, [-1.0, 0.0, 199.99, 200.0], "double")
    assert [r[1] for r in rows(freight.select("i", X.equal_width_bucket("v", 0, 200, 5)), "i")] == [0, 1, 5, 6]
    p = column(spark, [0.55, 0.275, 0.27], "double")
    assert [r[1] for r in rows(p.select("i", X.risk_label("v", 0.55)), "i")] == ["HIGH", "MEDIUM", "LOW"]
    zips = column(spark, [1300, 99999, None], "int")
    assert [r[1] for r in rows(zips.select("i", X.zip_region("v")), "i")] == [1, 99, None]


def test_category_falls_back(spark):
    df = spark.createDataFrame([("e", "n"), (None, "n"), (None, None)], "e string, n string")
    assert [r[0] for r in df.select(X.category_label("e", "n")).collect()] == ["e", "n", "unknown"]


def test_durations_and_delivery_status(spark):
    rules = X.StatusRules()
    data = [
        ("delivered", datetime(2020, 1, 2, 12), datetime(2020, 1, 2)),
        ("delivered", datetime(2020, 1, 2), datetime(2020, 1, 2)),
        ("delivered", None, datetime(2020, 1, 2)),
        ("shipped", datetime(2020, 1, 3), datetime(2020, 1, 2)),
    ]
    df = spark.createDataFrame(
        data, "order_status string, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
    )
    days = X.days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    found = df.select(X.delivery_status(rules), days).collect()
    assert [r[0] for r in found] == ["late", "on_time_or_early", None, None]
    assert [r[1] for r in found] == [0.5, 0.0, None, 1.0]


def test_ratios_avoid_division_by_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(X.percent(F.col("a"), F.col("b"))).collect()] == [None, 25.0]
