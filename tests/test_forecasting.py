from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from cartograin.operators import timeseries
from cartograin.plans import forecasting as M


@pytest.fixture(scope="module")
def history(spark):
    days = [date(2021, 1, 1) + timedelta(i) for i in range(150)]
    generator = np.random.default_rng(3)
    data = [(s, d, float(10 * k + i % 7 + generator.random())) for k, s in enumerate(("x", "y"), 1) for i, d in enumerate(days)]
    return spark.createDataFrame(data, "series string, date date, value double").cache()


def pandas_series(history, name="x"):
    pdf = history.filter(history.series == name).toPandas().sort_values("date")
    return pd.Series(pdf["value"].values, index=pd.to_datetime(pdf["date"]))


def pandas_features(s):
    out = pd.DataFrame({f"lag_{k}": s.shift(k) for k in (1, 2, 3, 7, 14, 28)})
    for w in (7, 14, 28):
        out[f"rolling_mean_{w}"] = s.shift(1).rolling(w).mean()
    for w in (7, 28):
        out[f"rolling_std_{w}"] = s.shift(1).rolling(w).std()
    i = s.index
    out["day_of_week"], out["day_of_month"], out["month"], out["quarter"] = i.dayofweek, i.day, i.month, i.quarter
    out["week_of_year"], out["is_weekend"] = i.isocalendar().week.astype(int), (i.dayofweek >= 5).astype(int)
    out["time_index"] = (i - i.min()).days
    return out.assign(target=s).dropna()


def test_features_match_pandas(history):
    found = timeseries.make_features(history, ["series"]).filter("series = 'x'").orderBy("date").toPandas()
    expected = pandas_features(pandas_series(history))
    assert len(found) == len(expected) == 122
    for name in (*timeseries.FEATURES, "target"):
        assert np.allclose(found[name].astype(float), expected[name].astype(float)), name


def test_folds_precede_the_holdout(history):
    folds = timeseries.expanding_folds(history, ["series"]).filter("series = 'x'").orderBy("fold").collect()
    last = date(2021, 1, 1) + timedelta(149)
    assert [(last - f.validation_end).days for f in folds] == [90, 60, 30]
    assert all((f.validation_end - f.validation_start).days == 29 and f.validation_start - f.train_end == timedelta(1) for f in folds)


def test_baselines_match_the_recursion(history):
    s = pandas_series(history)
    state = M.series_state(history)
    for name in M.BASELINES:
        work, expected = list(s), []
        for _ in range(10):
            value = {"NaiveLastValue": work[-1], "HistoricalMean": s.mean(), "SeasonalNaive7": work[-7], "RollingMean7": float(np.mean(work[-7:]))}[name]
            expected.append(max(0, value))
            work.append(expected[-1])
        found = M.baseline_forecast(name, state, 10).filter("series = 'x'").orderBy("step").toPandas()
        assert np.allclose(found["predicted"], expected), name
        assert found["date"].iloc[0] == date(2021, 5, 31)
    with pytest.raises(ValueError):
        M.baseline_forecast("Other", state, 3)


def test_negative_baselines_are_clamped(spark):
    data = [("n", date(2021, 1, 1) + timedelta(i), -5.0) for i in range(30)]
    state = M.series_state(spark.createDataFrame(data, "series string, date date, value double"))
    for name in M.BASELINES:
        assert {r.predicted for r in M.baseline_forecast(name, state, 8).collect()} == {0.0}


def test_fitted_model_steps_like_a_plain_loop(history):
    one = history.filter("series = 'x'")
    model = M.fit_model("LinearRegression", one)
    intercept, *coefficients = model.first()["value"]
    s = pandas_series(history)
    work = s.copy()
    for _ in range(12):
        day = work.index[-1] + pd.Timedelta(days=1)
        grown = pd.concat([work, pd.Series([0.0], index=[day])])
        features = pandas_features(grown).iloc[-1][list(timeseries.FEATURES)].to_numpy(float)
        work.loc[day] = max(0.0, float(features @ np.array(coefficients) + intercept))
    found = M.recursive_forecast(model, M.series_state(one), 12).orderBy("step").toPandas()
    assert np.allclose(found["predicted"], work.iloc[-12:])


def test_walk_forward_holdout_and_interval(history, tmp_path, spark):
    small = M.ForecastSettings(trees=3, tree_depth=3, boosting_rounds=2, boosting_leaves=4)
    predictions = M.walk_forward(history, ("LinearRegression",), small, holdout=14, fold=7, count=2)
    assert predictions.count() == 2 * 2 * 7 * 5
    metrics, residuals = M.holdout_evaluation(history, "SeasonalNaive7", small)
    assert metrics.count() == 6 and residuals.count() == 60
    spread = M.residual_quantiles(predictions.filter("model = 'SeasonalNaive7'"))
    artifact = M.fit_artifact("LinearRegression", history)
    artifact.save(str(tmp_path / "artifact"))
    loaded = M.load_artifact(spark, str(tmp_path / "artifact"))
    forecast = M.generate_forecast({"both": loaded}, spread, 7).collect()
    assert len(forecast) == 14 and all(0 <= r.lower_bound <= r.upper_bound for r in forecast)
    with pytest.raises(ValueError):
        M.generate_forecast({"both": loaded}, spread, 8)


def test_training_reads_the_series_once(spark, history):
    """A counter in the input sees each row once, however many folds and fits follow."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    targets = [r[0] for r in history.select("series").distinct().collect()]
    small = M.ForecastSettings(trees=3, tree_depth=3, boosting_rounds=2, boosting_leaves=4)
    trained = M.train(history.mapInPandas(counted, history.schema), targets, ("LinearRegression",), small)
    assert set(trained.selected) == set(targets) and trained.holdout.count() == 3 * len(targets)
    forecast = M.generate_forecast(trained.artifacts, trained.spread, 7)
    assert forecast.count() == 7 * len(targets)
    assert seen.value == history.count()
