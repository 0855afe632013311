import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartograin.operators import quality
from cartograin.operators.quality import DataQualityError
from cartograin.plans import late_delivery, validation


def test_constraint_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (9, "b")], "k int, s string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(quality.null_counts({"s": (df, "s")})) == [(1,)]
    assert rows(quality.orphan_counts({"lost": (df, parent, "k")})) == [(1,)]
    assert rows(quality.range_check(df, "k", 1, 5)) == [(4, 1, 0)]
    profile = quality.quality_profile({"d": (df, ["k"])}).first()
    assert (profile.rows, profile.columns, profile.duplicate_rows, profile.duplicate_business_keys) == (4, 2, 1, 1)
    assert (profile.missing_cells, profile.categorical_cardinality) == (1, 2)


def test_assertions_raise_only_on_broken_data(spark):
    good = spark.createDataFrame([(1, 0), (2, 1)], "k int, y int")
    quality.assert_grain(good, ["k"])
    quality.assert_domain(good, {"y": F.col("y").isin(0, 1)})
    with pytest.raises(DataQualityError):
        quality.assert_grain(good.union(good), ["k"])
    with pytest.raises(DataQualityError):
        quality.assert_domain(good.withColumn("y", F.lit(None).cast("int")), {"y": F.col("y").isin(0, 1)})
    with pytest.raises(DataQualityError, match=r"a \(1 rows\), c \(2 rows\)"):
        quality.assert_domain(good, {"a": F.col("k") > 1, "b": F.col("y") >= 0, "c": F.lit(None).cast("boolean")})
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-01-05')) AS d")
    quality.assert_continuous_days(days, "d")
    with pytest.raises(DataQualityError):
        quality.assert_continuous_days(days.filter("d <> date'2020-01-03'"), "d")


def test_reconcile_compares_independent_totals(spark):
    a = spark.createDataFrame([(10.0,), (5.0,)], "v double")
    assert quality.reconcile(a, a, "v") == 0
    with pytest.raises(DataQualityError):
        quality.reconcile(a, a.filter("v > 6"), "v")


def test_feature_audit(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, 4)], "a int, review_score int")
    assert rows(quality.audit_features(df, ["a"], {"a": "orders"}, ["review_score"])) == [("a", "orders", 3, 1, 1, True)]
    for features, source in ((["a", "review_score"], {"a": "", "review_score": ""}), (["a"], {}), (["z"], {"z": ""})):
        with pytest.raises(DataQualityError):
            quality.audit_features(df, features, source, ["review_score"])
    assert set(late_delivery.FEATURES) == set(late_delivery.SOURCE) and len(late_delivery.FEATURES) == 21


def test_requests_are_split_with_reasons(spark):
    from test_late_delivery import request_row

    good, bad = request_row(), request_row(purchase_month=13, payment_type="")
    df = spark.createDataFrame([good, bad])
    valid, rejected = quality.split_valid(df, validation.delivery_request_rules(), late_delivery.FEATURES)
    assert valid.count() == 1 and sorted(rejected.first().reasons) == ["payment_type", "purchase_month"]
    with pytest.raises(DataQualityError):
        quality.split_valid(df.withColumn("review_score", F.lit(1)), validation.delivery_request_rules(), late_delivery.FEATURES)


def test_describe_matches_pandas(spark):
    values = [1.0, 2.0, 2.0, 3.0, 50.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    import pandas as pd

    series, found = pd.Series(values), quality.describe_stats(df, ["v"]).first()
    assert (found["count"], found["p25"], found["p50"], found["p75"]) == (5, 2.0, 2.0, 3.0)
    assert found["skewness"] == pytest.approx(series.skew()) and found["std"] == pytest.approx(series.std())


def test_grain_and_rules_are_checked_in_one_job(spark):
    good = spark.createDataFrame([(1, 0), (2, 1), (None, 1)], "k int, y int")
    rules = {"y is 0 or 1": F.col("y").isin(0, 1), "y is small": F.col("y") < 5}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("gates", "")
    assert quality.assert_rows(good, ["k"], rules) is good
    jobs = len(tracker.getJobIdsForGroup("gates"))
    spark.sparkContext.setJobGroup("fold", "")
    good.groupBy("k").count().agg(F.max("count")).first()
    assert jobs == len(tracker.getJobIdsForGroup("fold"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert quality.assert_rows(good.limit(0), ["k"], rules).isEmpty()
    with pytest.raises(DataQualityError, match="more than one row per k"):
        quality.assert_rows(good.union(good), ["k"], rules)
    broken = spark.createDataFrame([(1, 7), (2, None), (3, 1)], "k int, y int")
    with pytest.raises(DataQualityError, match=r"y is 0 or 1 \(2 rows\), y is small \(2 rows\)"):
        quality.assert_rows(broken, ["k"], rules)
