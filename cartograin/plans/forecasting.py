"""Daily forecasting of many series at once.

Frames are ``(series, date, value)``, dense by day; a backtest adds the fold to the
series as key. Baselines are closed forms over one row per key; fitted models step
through the horizon with the last 28 values of every key as state. All models of all
keys are fitted in one job and forecast in another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.evaluation import choose_model, error_metrics, residual_table, summarize_backtest
from ..operators.ensembles import BOOSTED, FOREST, LINEAR, EnsembleSettings, Predictor, fit_groups
from ..operators.joins import union_all
from ..operators.ranking import exact_quantiles
from ..operators.timeseries import FEATURES, LAGS, MEAN_WINDOWS, STD_WINDOWS, calendar_features, expanding_folds, make_features
from ..session import checkpointed

SERIES = "series"
BASELINES = ("NaiveLastValue", "HistoricalMean", "SeasonalNaive7", "RollingMean7")
HORIZONS = (7, 14, 30)
HISTORY = 28
MODELS = (LINEAR, FOREST, BOOSTED)
ForecastSettings = EnsembleSettings


def to_series(daily: DataFrame, columns: Sequence[str] = ("daily_orders", "daily_revenue")) -> DataFrame:
    """Wide daily measures to (series, date, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("s"), F.col(c).cast("double").alias("v")) for c in columns])
    return daily.select("date", F.explode(pairs).alias("p")).select(F.col("p.s").alias(SERIES), "date", F.col("p.v").alias("value"))


def series_state(history: DataFrame, by: Sequence[str] = (SERIES,)) -> DataFrame:
    """One row per key: first and last day, mean, and the last 28 values in
    date order (fewer for a shorter series)."""
    last = F.max("date").over(W.partitionBy(*by))
    recent = F.when(F.datediff("_last", "date") < HISTORY, F.struct("date", "value"))
    return (
        history.withColumn("_last", last)
        .groupBy(*by)
        .agg(
            F.min("date").alias("origin"),
            F.max("date").alias("last_date"),
            F.avg("value").alias("mean"),
            F.transform(F.array_sort(F.collect_list(recent)), lambda e: e["value"]).alias("hist"),
        )
    )


def _array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _tail(values: Column, width: int) -> Column:
    return F.slice(values, -width, width)


def _array_mean(values: Column, width: int) -> Column:
    return _array_sum(_tail(values, width)) / F.lit(float(width))


def _array_std(values: Column, width: int) -> Column:
    average = _array_mean(values, width)
    squares = F.transform(_tail(values, width), lambda v: (v - average) * (v - average))
    return F.sqrt(_array_sum(squares) / F.lit(float(width - 1)))


def _exploded(state: DataFrame, predictions: Column, by: Sequence[str]) -> DataFrame:
    return state.select(*by, "last_date", F.posexplode(predictions).alias("_at", "predicted")).select(
        *by,
        (F.col("_at") + 1).alias("step"),
        F.date_add("last_date", F.col("_at") + 1).alias("date"),
        "predicted",
    )


def baseline_forecast(name: str, state: DataFrame, horizon: int, by: Sequence[str] = (SERIES,)) -> DataFrame:
    """(key, step, date, predicted) for the days after each series' end."""
    steps = F.sequence(F.lit(1), F.lit(horizon))
    zero = F.lit(0.0)
    hist = F.col("hist")
    if name == "NaiveLastValue":
        values = F.transform(steps, lambda s: F.greatest(zero, F.element_at(hist, -1)))
    elif name == "HistoricalMean":
        values = F.transform(steps, lambda s: F.greatest(zero, F.col("mean")))
    elif name == "SeasonalNaive7":
        values = F.transform(steps, lambda s: F.greatest(zero, F.element_at(_tail(hist, 7), (s - 1) % 7 + 1)))
    elif name == "RollingMean7":
        grown = F.aggregate(
            steps,
            _tail(hist, 7),
            lambda acc, s: F.concat(acc, F.array(F.greatest(zero, _array_mean(acc, 7)))),
        )
        values = F.slice(grown, 8, horizon)
    else:
        raise ValueError(f"unknown baseline: {name}")
    return _exploded(state, values, by)


def next_features(hist: list[float], day: date, origin: date) -> list[float]:
    """The training features, in the order of ``FEATURES``, of the day after ``hist``."""
    recent = np.array(hist[-HISTORY:])
    values = [recent[-k] for k in LAGS]
    values += [recent[-w:].mean() for w in MEAN_WINDOWS]
    values += [recent[-w:].std(ddof=1) for w in STD_WINDOWS]
    weekday = day.weekday()
    return [*values, weekday, day.day, day.month, (day.month + 2) // 3, day.isocalendar().week, weekday >= 5, (day - origin).days]


def fit_models(history: DataFrame, names: Sequence[str], settings: ForecastSettings = ForecastSettings(), by: Sequence[str] = (SERIES,)) -> DataFrame:
    """The named models of every key, written once: (key, model, tree, nodes)."""
    rows = make_features(history, list(by))
    return checkpointed(fit_groups(rows, list(by), "date", FEATURES, "target", names, settings))


def fit_model(name: str, history: DataFrame, settings: ForecastSettings = ForecastSettings()) -> DataFrame:
    """One model for each series in ``history``."""
    return fit_models(history, (name,), settings)


def model_forecast(fits: DataFrame, state: DataFrame, horizon: int, by: Sequence[str] = (SERIES,)) -> DataFrame:
    """(key, model, step, date, predicted): predict a day, clamp at zero, append it to
    the state, go on. Series with less than 28 days of history cannot be featured and
    are refused. A task holds the models of one key."""
    keys = list(by)

    def steps(fitted: pa.Table, ends: pa.Table) -> pa.Table:
        out = {c: [] for c in ("model", "step", "date", "predicted")}
        if fitted.num_rows and ends.num_rows:
            end = ends.to_pylist()[0]
            if len(end["hist"]) < HISTORY:
                raise ValueError(f"a series has less than {HISTORY} days")
            predict = Predictor(fitted)
            for name in predict.models:
                hist = list(end["hist"])
                for step in range(1, horizon + 1):
                    day = end["last_date"] + timedelta(step)
                    value = max(0.0, float(predict(name, np.array([next_features(hist, day, end["origin"])], float))[0]))
                    hist.append(value)
                    for column, cell in zip(out, (name, step, day, value)):
                        out[column].append(cell)
        first = {c: [ends.column(c)[0].as_py()] * len(out["step"]) if ends.num_rows else [] for c in keys}
        fields = [*(ends.schema.field(c) for c in keys), ("model", pa.string()), ("step", pa.int32()), ("date", pa.date32()), ("predicted", pa.float64())]
        return pa.table({**first, **out}, schema=pa.schema(fields))

    kinds = dict(state.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in keys), "model string, step int, date date, predicted double"])
    ends = state.select(*keys, "origin", "last_date", "hist")
    return fits.groupBy(*keys).cogroup(ends.groupBy(*keys)).applyInArrow(steps, schema)


def recursive_forecast(model: DataFrame, state: DataFrame, horizon: int) -> DataFrame:
    """``model_forecast`` of one model: (series, step, date, predicted)."""
    return model_forecast(model, state, horizon).drop("model")


def fitted_values(fits: DataFrame, history: DataFrame) -> DataFrame:
    """(series, model, date, actual, predicted) over the training rows."""
    rows = make_features(history, [SERIES]).select(SERIES, "date", "target", F.array(*[F.col(f).cast("double") for f in FEATURES]).alias("x"))

    def values(fitted: pa.Table, own: pa.Table) -> pa.Table:
        predict = Predictor(fitted)
        x = np.array(own.column("x").to_pylist(), float).reshape(own.num_rows, -1)
        plain = own.select([SERIES, "date", "target"]).rename_columns([SERIES, "date", "actual"])
        tables = [plain.append_column("model", pa.array([n] * own.num_rows)).append_column("predicted", pa.array(predict(n, x))) for n in predict.models]
        return pa.concat_tables(tables).select([SERIES, "model", "date", "actual", "predicted"])

    return fits.groupBy(SERIES).cogroup(rows.groupBy(SERIES)).applyInArrow(values, f"{SERIES} string, model string, date date, actual double, predicted double")


@dataclass
class Artifact:
    """What a forecast needs: the chosen method and the history it continues."""

    name: str
    history: DataFrame
    model: DataFrame | None = None

    def forecast(self, horizon: int) -> DataFrame:
        state = series_state(self.history)
        if self.model is None:
            return baseline_forecast(self.name, state, horizon)
        return recursive_forecast(self.model, state, horizon)

    def save(self, path: str) -> None:
        """Model (if any) and history side by side under ``path``."""
        self.history.withColumn("model_name", F.lit(self.name)).write.mode("overwrite").parquet(f"{path}/history")
        if self.model is not None:
            self.model.write.mode("overwrite").parquet(f"{path}/model")


def load_artifact(spark, path: str) -> Artifact:
    stored = spark.read.parquet(f"{path}/history")
    name = stored.select("model_name").first()["model_name"]
    model = None if name in BASELINES else spark.read.parquet(f"{path}/model")
    return Artifact(name, stored.drop("model_name"), model)


def fit_artifact(name: str, history: DataFrame, settings: ForecastSettings = ForecastSettings()) -> Artifact:
    return Artifact(name, history, None if name in BASELINES else fit_model(name, history, settings))


def walk_forward(
    series: DataFrame,
    models: Sequence[str] = MODELS,
    settings: ForecastSettings = ForecastSettings(),
    holdout: int = 30,
    fold: int = 30,
    count: int = 3,
) -> DataFrame:
    """Out-of-sample predictions of every baseline and model on each fold:
    (series, fold, model, step, date, actual, predicted)."""
    folds = expanding_folds(series, [SERIES], "date", holdout, fold, count).select(SERIES, "fold", "train_end")
    key = [SERIES, "fold"]
    history = checkpointed(series.join(folds, SERIES).filter(F.col("date") <= F.col("train_end")).select(*key, "date", "value"))
    forecasts = _forecasts(history, [*BASELINES, *models], settings, fold, key)
    actual = series.select(SERIES, "date", F.col("value").alias("actual"))
    return forecasts.join(actual, [SERIES, "date"]).select(SERIES, "fold", "model", "step", "date", "actual", "predicted")


def _forecasts(history: DataFrame, names: Sequence[str], settings: ForecastSettings, horizon: int, key: Sequence[str]) -> DataFrame:
    """(key, model, step, date, predicted) of baselines and models alike."""
    state = series_state(history, key)
    columns = [*key, "model", "step", "date", "predicted"]
    parts = [baseline_forecast(n, state, horizon, key).withColumn("model", F.lit(n)).select(*columns) for n in names if n in BASELINES]
    fitted = [n for n in names if n not in BASELINES]
    if fitted:
        parts.append(model_forecast(fit_models(history, fitted, settings, key), state, horizon, key).select(*columns))
    return union_all(*parts)


def backtest_metrics(predictions: DataFrame) -> DataFrame:
    return error_metrics(predictions, [SERIES, "model", "fold"])


def holdout_predictions(series: DataFrame, names: Sequence[str], settings: ForecastSettings = ForecastSettings(), holdout: int = 30) -> DataFrame:
    """Forecasts of the last ``holdout`` days from what lies before them:
    (series, model, step, date, actual, predicted)."""
    last = F.max("date").over(W.partitionBy(SERIES))
    marked = series.withColumn("_left", F.datediff(last, "date"))
    history = checkpointed(marked.filter(F.col("_left") >= holdout).select(*series.columns))
    actual = marked.filter(F.col("_left") < holdout).select(SERIES, "date", F.col("value").alias("actual"))
    forecast = _forecasts(history, names, settings, holdout, [SERIES])
    return forecast.join(actual, [SERIES, "date"]).select(SERIES, "model", "step", "date", "actual", "predicted")


def holdout_metrics(predictions: DataFrame, by: Sequence[str] = (SERIES,), horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Measures for each prefix of the holdout."""
    prefixes = F.explode(F.filter(F.array(*[F.lit(h) for h in horizons]), lambda h: F.col("step") <= h))
    return error_metrics(predictions.withColumn("horizon", prefixes), [*by, "horizon"])


def holdout_evaluation(
    series: DataFrame,
    name: str,
    settings: ForecastSettings = ForecastSettings(),
    holdout: int = 30,
    horizons: Sequence[int] = HORIZONS,
) -> tuple[DataFrame, DataFrame]:
    """Fit before the last ``holdout`` days; measures for each prefix, and the
    residual table."""
    compared = checkpointed(holdout_predictions(series, (name,), settings, holdout).drop("model"))
    return holdout_metrics(compared, (SERIES,), horizons), residual_table(compared, [SERIES])


def residual_quantiles(predictions: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Per series the spread of (actual - predicted) over the backtest."""
    residuals = predictions.withColumn("residual", F.col("actual") - F.col("predicted"))
    return exact_quantiles(residuals, "residual", {"lower": low, "upper": high}, by=[SERIES])


def with_interval(forecast: DataFrame, spread: DataFrame) -> DataFrame:
    """Planning interval, widening with the step; the lower bound stays >= 0."""
    widening = F.sqrt(F.lit(1.0) + F.col("step") / F.lit(7.0))
    return forecast.join(spread, SERIES).select(
        SERIES,
        "step",
        "date",
        "predicted",
        F.greatest(F.lit(0.0), F.col("predicted") + F.col("lower") * widening).alias("lower_bound"),
        (F.col("predicted") + F.col("upper") * widening).alias("upper_bound"),
    )


def generate_forecast(
    artifacts: Mapping[str, Artifact], spread: DataFrame, horizon: int = 30, horizons: Sequence[int] = HORIZONS
) -> DataFrame:
    """Forecasts with bounds for all artifacts; only supported horizons."""
    if horizon not in horizons:
        raise ValueError(f"supported horizons: {tuple(horizons)}")
    parts = None
    for artifact in artifacts.values():
        frame = artifact.forecast(horizon)
        parts = frame if parts is None else parts.unionByName(frame)
    return with_interval(parts, spread)


def wide_forecast(forecast: DataFrame) -> DataFrame:
    """One row per day with orders and revenue side by side."""
    measures = {"orders": "daily_orders", "revenue": "daily_revenue"}
    columns = []
    for short, name in measures.items():
        for source, target in (
            ("predicted", f"predicted_{short}"),
            ("lower_bound", f"{short}_lower_bound"),
            ("upper_bound", f"{short}_upper_bound"),
        ):
            columns.append(F.max(F.when(F.col(SERIES) == name, F.col(source))).alias(target))
    return forecast.groupBy("date").agg(*columns).orderBy("date")


@dataclass
class TrainedForecast:
    """Per target: the chosen model and how it was chosen."""

    selected: dict[str, str]
    artifacts: dict[str, Artifact]
    comparison: DataFrame
    holdout: DataFrame
    residuals: DataFrame
    spread: DataFrame


def train(
    series: DataFrame,
    targets: Sequence[str],
    models: Sequence[str] = MODELS,
    settings: ForecastSettings = ForecastSettings(),
) -> TrainedForecast:
    """Backtest, choose, evaluate on the holdout and refit, for each target.

    The series is written once; every fold and fit reads that."""
    series = checkpointed(series.filter(F.col(SERIES).isin(*targets)))
    predictions = checkpointed(walk_forward(series, models, settings))
    metrics = backtest_metrics(predictions)
    # One row per series.
    winners = choose_model(summarize_backtest(metrics, [SERIES, "model"]), [SERIES]).collect()
    selected = {r[SERIES]: r["model"] for r in winners}
    measured, residuals = [], []
    for name in sorted(set(selected.values())):
        own = series.filter(F.col(SERIES).isin(*[t for t, n in selected.items() if n == name]))
        one, table = holdout_evaluation(own, name, settings)
        measured.append(one)
        residuals.append(table)
    artifacts = {t: fit_artifact(selected[t], series.filter(F.col(SERIES) == t), settings) for t in targets}
    chosen = predictions.join(F.broadcast(series.sparkSession.createDataFrame(list(selected.items()), f"{SERIES} string, model string")), [SERIES, "model"])
    return TrainedForecast(selected, artifacts, metrics, union_all(*measured), union_all(*residuals), residual_quantiles(chosen))
