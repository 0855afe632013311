"""Window features over dense daily series.

A series is ``(series columns, date, value)`` with one row per day, so a window
partition is bounded by the calendar however many events stand behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LAGS = (1, 2, 3, 7, 14, 28)
MEAN_WINDOWS = (7, 14, 28)
STD_WINDOWS = (7, 28)
CALENDAR = ("day_of_week", "day_of_month", "month", "quarter", "week_of_year", "is_weekend", "time_index")
FEATURES = (
    *[f"lag_{k}" for k in LAGS],
    *[f"rolling_mean_{w}" for w in MEAN_WINDOWS],
    *[f"rolling_std_{w}" for w in STD_WINDOWS],
    *CALENDAR,
)


def _over(series: Sequence[str], date: str) -> W:
    return W.partitionBy(*series).orderBy(date)


def lags(df: DataFrame, series: Sequence[str], date: str, value: str, steps: Sequence[int] = LAGS) -> DataFrame:
    window = _over(series, date)
    return df.withColumns({f"lag_{k}": F.lag(value, k).over(window) for k in steps})


def rolling_previous(
    df: DataFrame,
    series: Sequence[str],
    date: str,
    value: str,
    means: Sequence[int] = MEAN_WINDOWS,
    stds: Sequence[int] = STD_WINDOWS,
) -> DataFrame:
    """Mean and sample deviation of the rows before the current one; NULL until
    the window is full."""
    columns = {}
    for prefix, function, widths in (("mean", F.avg, means), ("std", F.stddev_samp, stds)):
        for width in widths:
            window = _over(series, date).rowsBetween(-width, -1)
            full = F.count(value).over(window) == width
            columns[f"rolling_{prefix}_{width}"] = F.when(full, function(value).over(window))
    return df.withColumns(columns)


def rolling_mean(df: DataFrame, series: Sequence[str], date: str, value: str, width: int, name: str) -> DataFrame:
    """Mean of the last ``width`` rows including the current one."""
    window = _over(series, date).rowsBetween(1 - width, 0)
    full = F.count(value).over(window) == width
    return df.withColumn(name, F.when(full, F.avg(value).over(window)))


def calendar_features(date: Column, origin: Column) -> dict[str, Column]:
    """Day of week is 0 = Monday; weeks are ISO weeks."""
    weekday = F.weekday(date)
    return {
        "day_of_week": weekday,
        "day_of_month": F.dayofmonth(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "week_of_year": F.weekofyear(date),
        "is_weekend": (weekday >= 5).cast("int"),
        "time_index": F.datediff(date, origin),
    }


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(columns) if columns else None)


def make_features(df: DataFrame, series: Sequence[str], date: str = "date", value: str = "value") -> DataFrame:
    """The autoregressive training rows: features from earlier days only, the
    day's value as ``target``, days without a full history dropped."""
    origin = F.min(date).over(W.partitionBy(*series))
    featured = rolling_previous(lags(df, series, date, value), series, date, value)
    featured = featured.withColumns(calendar_features(F.col(date), origin))
    featured = featured.select(*series, date, *FEATURES, F.col(value).alias("target"))
    return drop_incomplete(featured, FEATURES)


def expanding_folds(
    df: DataFrame,
    series: Sequence[str],
    date: str = "date",
    holdout: int = 30,
    fold: int = 30,
    count: int = 3,
) -> DataFrame:
    """One row per series and fold: the training span and the validation span
    that follows it, all before the holdout days."""
    ends = df.groupBy(*series).agg(F.min(date).alias("train_start"), F.max(date).alias("_last"))
    folds = ends.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(count))))
    start = F.date_sub("_last", F.lit(holdout - 1) + (F.lit(count + 1) - F.col("fold")) * fold)
    return folds.withColumn("validation_start", start).select(
        *series,
        "fold",
        "train_start",
        F.date_sub("validation_start", 1).alias("train_end"),
        "validation_start",
        F.date_add("validation_start", fold - 1).alias("validation_end"),
    )
