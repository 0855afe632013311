import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartograin.operators import evaluation as E


def brute(y, p):
    """Average precision and pair-counting AUC from their definitions."""
    y, p = np.array(y), np.array(p)
    ap, recall = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = ((p >= t) & (y == 1)).sum()
        ap += (hit / y.sum() - recall) * hit / (p >= t).sum()
        recall = hit / y.sum()
    pairs = [(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]]
    return ap, np.mean(pairs)


def frame(spark, y, p):
    return spark.createDataFrame(list(zip(map(int, y), map(float, p))), "y int, p double")


def test_ranking_measures_with_ties(spark, spread):
    generator = np.random.default_rng(1)
    y, p = generator.integers(0, 2, 400), generator.integers(0, 30, 400) / 30
    found = E.classification_metrics(frame(spark, y, p), "y", "p", 0.5).first()
    ap, auc = brute(y, p)
    assert found.pr_auc == pytest.approx(ap) and found.roc_auc == pytest.approx(auc)
    assert (found.tn, found.fp, found.fn, found.tp) == tuple(int((((p >= 0.5) == b) & (y == a)).sum()) for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)))


def test_degenerate_inputs(spark):
    none = E.classification_metrics(frame(spark, [0, 0], [0.2, 0.9]), "y", "p", 0.5).first()
    assert (none.pr_auc, none.roc_auc, none.precision, none.recall, none.f1) == (0.0, None, 0.0, 0.0, 0.0)
    assert none.balanced_accuracy == 0.5
    silent = E.classification_metrics(frame(spark, [1, 0], [0.1, 0.2]), "y", "p", 0.5).first()
    assert (silent.precision, silent.recall, silent.f1) == (0.0, 0.0, 0.0)


def test_groups_equal_single_runs(spark, spread):
    df = frame(spark, [1, 0, 1, 0, 1, 1], [0.9, 0.8, 0.7, 0.3, 0.2, 0.2]).withColumn("g", F.when(F.col("p") > 0.5, "a").otherwise("b"))
    together = {r.g: r for r in E.classification_metrics(df, "y", "p", 0.5, by=["g"]).collect()}
    for g in "ab":
        alone = E.classification_metrics(df.filter(F.col("g") == g), "y", "p", 0.5).first()
        assert tuple(together[g])[1:] == tuple(alone)


def test_threshold_grid_matches_direct_counting(spark):
    grid = E.threshold_grid()
    assert len(grid) == 76
    generator = np.random.default_rng(2)
    p = np.concatenate([generator.random(200), np.array(grid[:40]), [0.0, 1.0]])
    y = generator.integers(0, 2, len(p))
    table = E.threshold_table(frame(spark, y, p), "y", "p").collect()
    for t, row in zip(grid, table):
        flagged = p >= t
        tp = (flagged & (y == 1)).sum()
        precision, recall = (tp / flagged.sum() if flagged.any() else 0), tp / y.sum()
        assert (row.precision, row.recall) == (pytest.approx(precision), pytest.approx(recall))
    best = E.best_threshold(E.threshold_table(frame(spark, y, p), "y", "p")).first()
    assert best.f2 == max(r.f2 for r in table)


def test_curves_have_their_end_points(spark):
    df = frame(spark, [1, 0, 1], [0.9, 0.5, 0.1])
    assert (None, 1.0, 0.0) in rows(E.pr_curve(df, "y", "p"))
    assert {(None, 0.0, 0.0), (0.1, 1.0, 1.0)} <= set(rows(E.roc_curve(df, "y", "p")))
    assert sum(r.n for r in E.score_histogram(df, "y", "p").collect()) == 3


def test_forecast_errors_follow_the_zero_rules(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 1.0), ("b", 0.0, 0.0), ("b", 4.0, 2.0), ("c", 0.0, 3.0)], "m string, actual double, predicted double")
    found = {r.m: r for r in E.error_metrics(df, ["m"]).collect()}
    assert found["a"].mape == 50.0 and found["a"].smape == pytest.approx((200 + 200 / 3) / 2)
    assert math.isnan(found["b"].smape) and found["b"].mae == 1.0
    assert math.isnan(found["c"].mape) and found["c"].rmse == 3.0


def test_seasonal_baseline_is_kept_for_a_small_gain(spark):
    def chosen(best):
        summary = spark.createDataFrame([("SeasonalNaive7", 100.0), ("Other", best)], "model string, mae double")
        return E.choose_model(summary).first().model

    assert chosen(99.5) == "SeasonalNaive7" and chosen(98.0) == "Other"


def test_error_groups_without_positives_have_no_recall(spark):
    df = frame(spark, [0, 0, 1], [0.9, 0.1, 0.1]).withColumn("g", F.when(F.col("y") == 1, "late").otherwise("fine"))
    found = {r.g: r for r in E.error_summary(E.with_outcome(df, "y", "p", 0.5), "g").collect()}
    assert found["fine"].recall is None and found["fine"].false_positives == 1
    assert found["late"].recall == 0.0 and found["late"].false_negative_rate == 1.0
