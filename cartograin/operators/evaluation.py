"""Classification and forecast error measures as aggregations.

Ranking measures come from one row per distinct score: scores are counted by
class and the counts accumulated from the highest score down, across partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import ratio
from ..session import checkpointed
from .ranking import running_totals, top_k
from .statistics import histogram, quantile_band


def score_table(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: ``pos`` and ``neg`` rows there, ``tp`` and ``fp`` rows
    at or above it."""
    counts = df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(counts, [F.desc("score")], {"tp": "pos", "fp": "neg"}, within=by)


def average_precision() -> Column:
    """Over a score table: sum of precision times the gain in recall."""
    gained = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return F.coalesce(ratio(gained, F.max("tp")), F.lit(0.0))


def roc_auc() -> Column:
    """Over a score table: share of (positive, negative) pairs ranked right,
    ties counting half; NULL when a class is missing."""
    right = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0))
    pairs = F.max("tp").cast("double") * F.max("fp").cast("double")
    return ratio(right, pairs)


def _zero_if_undefined(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def classification_metrics(
    df: DataFrame, label: str, score: str, threshold: float, by: Sequence[str] = ()
) -> DataFrame:
    """Ranking and threshold measures, one row per ``by`` group."""
    table = score_table(df, label, score, by)
    flagged = F.col("score") >= threshold
    sums = table.groupBy(*by).agg(
        average_precision().alias("pr_auc"),
        roc_auc().alias("roc_auc"),
        F.sum(F.when(~flagged, F.col("neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(flagged, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(~flagged, F.col("pos")).otherwise(0)).alias("fn"),
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("tp"),
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    sensitivity, specificity = ratio(tp, tp + fn), ratio(tn, tn + fp)
    balanced = F.coalesce((sensitivity + specificity) / 2, sensitivity, specificity)
    return sums.select(
        *by,
        "pr_auc",
        "roc_auc",
        _zero_if_undefined(tp, tp + fp).alias("precision"),
        _zero_if_undefined(tp, tp + fn).alias("recall"),
        _zero_if_undefined(2 * tp, 2 * tp + fp + fn).alias("f1"),
        balanced.alias("balanced_accuracy"),
        "tn",
        "fp",
        "fn",
        "tp",
    )


def threshold_grid(start: float = 0.05, stop: float = 0.801, step: float = 0.01) -> list[float]:
    """The grid as floating-point steps, which is what scores are compared with."""
    return [float(t) for t in np.arange(start, stop, step)]


def threshold_table(df: DataFrame, label: str, score: str, grid: Sequence[float] | None = None) -> DataFrame:
    """Precision, recall, F1 and F2 at every threshold.

    Each row adds to the one grid cell it falls in (a grid of fixed size), and
    the cells are summed from the top down.
    """
    grid = list(grid or threshold_grid())
    steps = F.array(*[F.lit(t) for t in grid])
    p = F.col(score).cast("double")
    # Guess the cell from the even spacing, then settle it against the edges.
    width = (grid[-1] - grid[0]) / max(len(grid) - 1, 1) or 1.0
    guess = F.greatest(F.lit(0), F.least(F.lit(len(grid) - 1), F.floor((p - grid[0]) / width).cast("int")))
    after = F.coalesce(F.get(steps, F.col("_cell") + 1) <= p, F.lit(False)).cast("int")
    before = F.coalesce(F.get(steps, F.col("_cell")) > p, F.lit(False)).cast("int")
    cells = (
        df.select(F.col(label).alias("_label"), p.alias(score), guess.alias("_cell"))
        .select("_label", (F.col("_cell") + after - before).alias("_cell"))
        .groupBy("_cell")
        .agg(F.count_if(F.col("_label") == 1).alias("pos"), F.count_if(F.col("_label") == 0).alias("neg"))
    )
    edges = df.sparkSession.createDataFrame([(i, t) for i, t in enumerate(grid)], "_cell int, _edge double")
    # One row per threshold plus the cell below the grid.
    filled = edges.join(cells, "_cell", "full").fillna(0, ["pos", "neg"])
    down = W.orderBy(F.desc("_cell"))
    counted = filled.withColumns(
        {
            "tp": F.sum("pos").over(down.rowsBetween(W.unboundedPreceding, 0)),
            "fp": F.sum("neg").over(down.rowsBetween(W.unboundedPreceding, 0)),
            "_positives": F.sum("pos").over(W.partitionBy()),
        }
    ).filter(F.col("_cell") >= 0)
    precision = _zero_if_undefined(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _zero_if_undefined(F.col("tp"), F.col("_positives"))
    scored = counted.select(F.round("_edge", 2).alias("threshold"), precision.alias("precision"), recall.alias("recall"))

    def f_beta(beta2: float) -> Column:
        p_, r = F.col("precision"), F.col("recall")
        return _zero_if_undefined((1 + beta2) * p_ * r, beta2 * p_ + r)

    return scored.withColumns({"f1": f_beta(1.0), "f2": f_beta(4.0)}).orderBy("threshold")


def best_threshold(table: DataFrame) -> DataFrame:
    """One row: the highest F2, then the highest precision."""
    return top_k(table, [F.desc("f2"), F.desc("precision"), "threshold"], 1)


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """A point per distinct score, and the end point (no threshold, 1, 0)."""
    table = score_table(df, label, score)
    positives = table.agg(F.max("tp").alias("_p"))
    points = table.crossJoin(F.broadcast(positives)).select(
        F.col("score").alias("threshold"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("_p")), F.lit(1.0)).alias("recall"),
    )
    end = positives.select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.union(end)


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """A point per distinct score, and the start point (no threshold, 0, 0)."""
    table = score_table(df, label, score)
    totals = table.agg(F.max("tp").alias("_p"), F.max("fp").alias("_n"))
    points = table.crossJoin(F.broadcast(totals)).select(
        F.col("score").alias("threshold"),
        ratio(F.col("fp"), F.col("_n")).alias("fpr"),
        ratio(F.col("tp"), F.col("_p")).alias("tpr"),
    )
    start = totals.select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.union(start)


def score_histogram(df: DataFrame, label: str, score: str, bins: int = 40) -> DataFrame:
    """Equal-width score counts, each class over its own range."""
    parts = [
        histogram(df.filter(F.col(label) == value), score, bins).withColumn(label, F.lit(value)) for value in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("rows")).orderBy(label)


# --- error analysis -------------------------------------------------------


def with_outcome(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Adds ``actual``, ``predicted`` and ``error_type``."""
    flagged = (F.col(score) >= threshold).cast("int")
    kind = (
        F.when((F.col("actual") == 0) & (F.col("predicted") == 1), "false_positive")
        .when((F.col("actual") == 1) & (F.col("predicted") == 0), "false_negative")
        .otherwise("correct")
    )
    return df.withColumns({"actual": F.col(label).cast("int"), "predicted": flagged}).withColumn("error_type", kind)


def error_summary(outcome: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Errors per group; rates are NULL for a group without positives."""
    keys = [by] if isinstance(by, str) else list(by)
    hit = (F.col("actual") == 1) & (F.col("predicted") == 1)
    grouped = outcome.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("actual").alias("late_orders"),
        F.avg("actual").alias("late_rate"),
        F.count_if(hit).alias("true_positives"),
        F.count_if(F.col("error_type") == "false_negative").alias("false_negatives"),
        F.count_if(F.col("error_type") == "false_positive").alias("false_positives"),
    )
    return grouped.withColumns(
        {
            "recall": ratio(F.col("true_positives"), F.col("late_orders")),
            "false_negative_rate": ratio(F.col("false_negatives"), F.col("late_orders")),
        }
    )


ERROR_TABLES = ("state", "value_band", "category", "month", "examples")


def grouped_error_analysis(
    df: DataFrame, label: str, score: str, threshold: float, tables: Sequence[str] = ERROR_TABLES
) -> dict[str, DataFrame]:
    """Tables by state, value band, category and month, and the first mistakes,
    as far as asked for. The scored rows are read once per table, so they are
    written once if there are several."""
    outcome = with_outcome(df, label, score, threshold).select(
        "order_id",
        "purchase_timestamp",
        "purchase_month",
        "customer_state",
        "dominant_product_category",
        "item_value",
        "actual",
        "predicted",
        "error_type",
    )
    if len(tables) > 1 or "value_band" in tables:
        outcome = checkpointed(outcome)
    band = ["value_band", "value_band_lower", "value_band_upper"]
    mistakes = outcome.filter(F.col("error_type") != "correct").select(
        "order_id",
        "purchase_timestamp",
        "customer_state",
        "dominant_product_category",
        "item_value",
        "actual",
        "predicted",
        "error_type",
    )
    build = {
        "state": lambda: error_summary(outcome, "customer_state"),
        "value_band": lambda: error_summary(quantile_band(outcome, "item_value", 4, "value_band"), band),
        "category": lambda: error_summary(outcome, "dominant_product_category"),
        "month": lambda: error_summary(outcome, "purchase_month"),
        "examples": lambda: top_k(mistakes, ["purchase_timestamp", "order_id"], 100),
    }
    return {name: build[name]() for name in tables}


# --- forecast errors ------------------------------------------------------


def error_metrics(df: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAE, RMSE, MAPE over non-zero actuals (NaN when there are none) and sMAPE,
    which is NaN as soon as one pair is zero on both sides."""
    a, p = F.col(actual), F.col(predicted)
    gap, size = F.abs(a - p), F.abs(a) + F.abs(p)
    nan = F.lit(float("nan"))
    return df.groupBy(*by).agg(
        F.avg(gap).alias("mae"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.coalesce(F.avg(F.when(a != 0, F.abs((a - p) / F.when(a != 0, a)))) * 100, nan).alias("mape"),
        F.when(F.count_if(size == 0) > 0, nan).otherwise(F.avg(200 * gap / F.when(size != 0, size))).alias("smape"),
    )


def summarize_backtest(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean of each measure per model; a NaN fold is left out of the mean."""
    measures = ("mae", "rmse", "mape", "smape")
    known = {m: F.avg(F.when(~F.isnan(m), F.col(m))) for m in measures}
    return metrics.groupBy(*by).agg(*[F.coalesce(c, F.lit(float("nan"))).alias(m) for m, c in known.items()])


def choose_model(summary: DataFrame, by: Sequence[str] = (), fallback: str = "SeasonalNaive7", gain: float = 0.01) -> DataFrame:
    """The lowest mean MAE, unless it improves on the seasonal baseline by less
    than ``gain``."""
    best = summary.groupBy(*by).agg(
        F.min(F.struct("mae", "model")).alias("_best"),
        F.max(F.when(F.col("model") == fallback, F.col("mae"))).alias("_base"),
    )
    improvement = ratio(F.col("_base") - F.col("_best.mae"), F.col("_base"))
    keep = F.coalesce(improvement < gain, F.lit(False))
    return best.select(*by, F.when(keep, fallback).otherwise(F.col("_best.model")).alias("model"))


def residual_table(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    residual = F.col("actual") - F.col("predicted")
    return df.select(
        *keep, "date", "actual", "predicted", residual.alias("residual"), F.date_format("date", "EEEE").alias("weekday")
    )
