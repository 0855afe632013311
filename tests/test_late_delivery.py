from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartograin import registry
from cartograin.functions.expressions import StatusRules
from cartograin.operators.quality import DataQualityError
from cartograin.plans import late_delivery as K


def request_row(**changes):
    row = dict(
        purchase_month=6, purchase_day_of_week=3, purchase_hour=14, customer_zip_region=1, item_value=150.0, freight_value=20.0,
        item_count=1, unique_products=1, seller_count=1, total_product_weight_g=1200.0, average_product_length_cm=30.0,
        average_product_height_cm=15.0, average_product_width_cm=20.0, payment_value=170.0, payment_installments=2,
        estimated_delivery_window_days=20.0, customer_state="SP", dominant_product_category="bed_bath_table",
        dominant_seller_state="SP", same_customer_seller_state="yes", payment_type="credit_card",
    )
    return row | changes


@pytest.fixture(scope="module")
def dataset(spark):
    generator = np.random.default_rng(0)
    data = []
    for i in range(400):
        window = float(generator.integers(5, 40))
        state = str(generator.choice(["SP", "RJ", "MG"]))
        late = int(generator.random() < (0.7 if window < 15 else 0.15))
        row = request_row(estimated_delivery_window_days=window, customer_state=state, item_value=float(i % 50))
        row |= {"order_id": f"o{i:04d}", "purchase_timestamp": datetime(2020, 1, 1) + timedelta(hours=i), "is_late_delivery": late}
        row["payment_type"] = "card" if i % 3 else "slip"
        data.append(row)
    return spark.createDataFrame(data).cache()


SMALL = K.CandidateSettings(trees=5, tree_depth=4, boosting_rounds=3, boosting_depth=3)


def test_training_chooses_and_scores(dataset, tmp_path):
    trained = K.train(dataset, SMALL)
    assert trained.name in ("LogisticRegression", "RandomForestClassifier", "GBTClassifier")
    assert trained.comparison.count() == 8 and 0.05 <= trained.threshold <= 0.80
    scored = K.predict_late_delivery(trained.model, dataset.select(*K.FEATURES), trained.threshold)
    assert scored.filter(~F.col("late_delivery_probability").between(0, 1)).count() == 0
    assert {r[0] for r in scored.select("risk_label").distinct().collect()} <= {"HIGH", "MEDIUM", "LOW"}
    assert trained.importance.count() == 21
    K.save(trained, str(tmp_path))
    stored = K.predict_stored(str(tmp_path), dataset.select(*K.FEATURES))
    kept = ["late_delivery_probability", "predicted_late_delivery", "risk_label"]
    assert rows(stored.select(*kept), *kept) == rows(scored.select(*kept), *kept)


def test_unseen_and_missing_values_are_scored(spark, dataset):
    model = K.fit_candidates(dataset, SMALL, ("LogisticRegression",))["LogisticRegression"]
    strange = spark.createDataFrame([request_row(payment_type="barter"), request_row(payment_type="card")])
    strange = strange.unionByName(strange.limit(1).withColumns({"payment_type": F.lit(None).cast("string"), "item_value": F.lit(None).cast("double")}))
    assert K.score(model, strange).filter("late_delivery_probability between 0 and 1").count() == 3
    with pytest.raises(ValueError):
        K.predict_late_delivery(model, strange.drop("payment_type"), 0.5)


def test_logistic_solves_the_stated_problem(dataset):
    """The gradient of the penalised, class-weighted loss vanishes at the fit."""
    from pyspark.ml.functions import vector_to_array

    model = K.fit_candidates(dataset, SMALL, ("LogisticRegression",))["LogisticRegression"]
    rows_ = model.transform(dataset).select(vector_to_array("features").alias("x"), K.TARGET).toPandas()
    x, y = np.array(rows_["x"].tolist()), rows_[K.TARGET].to_numpy()
    linear = model.stages[-1]
    w, b = linear.coefficients.toArray(), linear.intercept
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    p = 1 / (1 + np.exp(-(x @ w + b)))
    gradient = w + 0.5 * (x * (weight * (p - y))[:, None]).sum(axis=0)
    assert np.abs(gradient).max() < 0.05 and abs((weight * (p - y)).sum()) < 0.05
    assert np.allclose(x[:, 15].mean(), 0, atol=1e-9) and np.allclose(x[:, 15].std(), 1)


def test_permutation_importance_finds_the_signal(dataset):
    model = K.fit_candidates(dataset, SMALL, ("LogisticRegression",))["LogisticRegression"]
    table = K.permutation_importance(model, dataset, repeats=2)
    assert table.count() == 21 and table.first().feature == "estimated_delivery_window_days"


def test_leaking_or_repeated_rows_are_refused(dataset):
    with pytest.raises(DataQualityError):
        K.checked_dataset(dataset.union(dataset.limit(1)))
    with pytest.raises(DataQualityError):
        K.checked_dataset(dataset.withColumn(K.TARGET, F.lit(2)))
    with pytest.raises(DataQualityError):
        K.checked_dataset(dataset.drop("payment_type"))


def test_dataset_grain_and_dominant_values(spark):
    tables = {
        "orders": spark.createDataFrame(
            [("o1", "c1", "delivered", datetime(2020, 5, 4, 9), datetime(2020, 5, 9), datetime(2020, 5, 8)), ("o2", "c1", "shipped", datetime(2020, 5, 4), None, datetime(2020, 5, 8))],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"),
        "customers": spark.createDataFrame([("c1", 13500, "SP")], "customer_id string, customer_zip_code_prefix int, customer_state string"),
        "order_items": spark.createDataFrame(
            [("o1", "p1", "s1", 10.0, 1.0), ("o1", "p1", "s1", 10.0, 1.0), ("o1", "p2", "s2", 5.0, 2.0), ("o1", "p3", "s2", 5.0, 2.0)],
            "order_id string, product_id string, seller_id string, price double, freight_value double"),
        "products": spark.createDataFrame(
            [("p1", "b", 100.0, 1.0, None, 3.0), ("p2", "a", 50.0, 2.0, 4.0, 3.0), ("p3", "a", None, 2.0, 4.0, 3.0)],
            "product_id string, product_category_name string, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double"),
        "sellers": spark.createDataFrame([("s1", "SP"), ("s2", "RJ")], "seller_id string, seller_state string"),
        "product_category_translation": spark.createDataFrame([("b", "beds")], "product_category_name string, product_category_name_english string"),
        "payments": spark.createDataFrame([("o1", "slip", 1, 20.0), ("o1", "card", 5, 20.0)], "order_id string, payment_type string, payment_installments int, payment_value double"),
    }
    found = K.modeling_dataset(tables, StatusRules()).collect()
    assert len(found) == 1
    r = found[0]
    assert (r.item_value, r.freight_value, r.item_count, r.unique_products, r.seller_count) == (30.0, 6.0, 4, 3, 2)
    assert (r.dominant_product_category, r.dominant_seller_state, r.payment_type) == ("a", "RJ", "card")
    assert (r.payment_value, r.payment_installments, r.total_product_weight_g, r.average_product_height_cm) == (40.0, 5, 250.0, 4.0)
    assert (r.purchase_day_of_week, r.purchase_hour, r.customer_zip_region, r.same_customer_seller_state, r.is_late_delivery) == (1, 9, 13, "no", 1)
    assert rows(K.payment_features(tables["payments"]))[0][1] == "card"


def basket_tables(spark):
    items = [("o1", "p1", "s1", 10.0, 1.0)] * 3 + [("o1", "p2", "s1", 5.0, None), ("o1", "p2", "s2", None, 2.0)]
    return (
        spark.createDataFrame(items, "order_id string, product_id string, seller_id string, price double, freight_value double"),
        spark.createDataFrame(
            [("p1", "b", 100.0, 1.0, None, 3.0), ("p2", "a", None, 4.0, 4.0, 3.0)],
            "product_id string, product_category_name string, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double"),
        spark.createDataFrame([("s1", None), ("s2", "RJ")], "seller_id string, seller_state string"),
        spark.createDataFrame([("b", "beds")], "product_category_name string, product_category_name_english string"),
    )


def test_repeated_items_weigh_by_their_number(spark):
    r = K.basket_features(*basket_tables(spark)).collect()[0]
    assert (r.item_value, r.freight_value, r.item_count, r.unique_products, r.seller_count) == (35.0, 5.0, 5, 2, 2)
    assert (r.total_product_weight_g, r.average_product_length_cm, r.average_product_height_cm, r.average_product_width_cm) == (300.0, 2.2, 4.0, 3.0)
    assert (r.dominant_product_category, r.dominant_seller_state) == ("beds", None)


def test_counted_values_are_not_shuffled(spark):
    """Five rows an item stay in the task that makes them."""
    plan = K.basket_features(*basket_tables(spark))._jdf.queryExecution().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("kind" in line for line in dealt)


def test_rows_that_multiply_keep_the_partitions_of_the_session(spark):
    """Adaptive execution may not join partitions whose rows become five each."""
    plan = K.basket_features(*basket_tables(spark))._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan


def test_the_dataset_is_derived_once(spark, dataset, monkeypatch):
    """It was derived for the ranks and again for the labels."""
    seen = spark.sparkContext.accumulator(0)
    noted = F.udf(lambda key: (seen.add(1), key)[1], "string")
    monkeypatch.setattr(registry, "modeling", lambda r: dataset.withColumn("order_id", noted("order_id")))
    assert len(registry.split_rows(None).collect()) == seen.value == 400


def test_candidates_are_fitted_side_by_side(dataset):
    """forests keep rows' nodes, and no candidate waits for another."""
    import threading

    used, plain = {}, K._estimators

    def watched(settings, n):
        chosen = plain(settings, n)
        for name, (_, estimator) in chosen.items():
            fit = estimator.fit
            estimator.fit = lambda frame, name=name, fit=fit: (used.setdefault(name, threading.get_ident()), fit(frame))[1]
        return chosen

    K._estimators = watched
    try:
        models = K.fit_candidates(dataset, SMALL)
    finally:
        K._estimators = plain
    assert list(models) == ["DummyClassifier", "LogisticRegression", "RandomForestClassifier", "GBTClassifier"]
    assert len(used) == 3 and threading.get_ident() not in used.values()
    assert plain(SMALL, 10)["RandomForestClassifier"][1].getCacheNodeIds()


def test_a_fit_keeps_the_cores_of_a_middling_table(spark):
    from cartograin.session import by_rows

    many = spark.range(0, 10, 1, 64)
    assert [by_rows(many, n, least=16).rdd.getNumPartitions() for n in (400, 25_000, 163_191, 2_000_000)] == [1, 3, 16, 40]
    assert by_rows(many, 163_191).rdd.getNumPartitions() == 4


def test_short_jobs_have_no_more_tasks_than_cores(dataset, monkeypatch):
    """each of a thousand boosting jobs had 16 tasks, whatever the cores."""
    asked, plain = [], K.by_rows
    monkeypatch.setattr(K, "by_rows", lambda df, rows, **least: (asked.append(least["least"]), plain(df, rows, **least))[1])
    K.fit_candidates(dataset, SMALL, ("GBTClassifier",))
    assert asked[-1] == dataset.sparkSession.sparkContext.defaultParallelism < 16 and len(asked) == 2
