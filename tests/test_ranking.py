import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartograin.operators import ranking, statistics


@pytest.fixture
def values(spark):
    generator = np.random.default_rng(5)
    frame = pd.DataFrame({"id": np.arange(2000), "g": generator.choice(["a", "b", "c"], 2000, p=[0.7, 0.2, 0.1]), "v": generator.integers(0, 60, 2000)})
    return frame, spark.createDataFrame(frame)


def test_rank_matches_a_plain_sort_across_partitions(values, spread):
    frame, df = values
    ranked = ranking.distributed_rank(df, [F.desc("v"), "id"])
    assert ranked.select(F.spark_partition_id()).distinct().count() > 1
    expected = frame.sort_values(["v", "id"], ascending=[False, True])["id"].tolist()
    assert [r.id for r in ranked.orderBy("rank").collect()] == expected
    assert [r.rank for r in ranked.orderBy("rank").collect()] == list(range(1, 2001))


def test_running_totals_continue_across_partitions_and_restart_per_group(values, spread):
    frame, df = values
    total = ranking.running_totals(df, ["v", "id"], {"upto": "v", "n": F.lit(1)}, within=["g"])
    found = total.toPandas().sort_values(["g", "v", "id"]).reset_index(drop=True)
    expected = frame.sort_values(["g", "v", "id"]).reset_index(drop=True)
    assert found["upto"].tolist() == expected.groupby("g")["v"].cumsum().tolist()
    assert found["n"].tolist() == (expected.groupby("g").cumcount() + 1).tolist()


def test_quantiles_are_exact(values, spread):
    frame, df = values
    whole = ranking.exact_quantiles(df, "v", {"a": 0.0, "b": 0.123, "c": 0.5, "d": 0.99, "e": 1.0}).first()
    assert list(whole) == pytest.approx(np.quantile(frame["v"], [0, 0.123, 0.5, 0.99, 1]).tolist())
    grouped = {r.g: r.m for r in ranking.exact_quantiles(df, "v", {"m": 0.5}, by=["g"]).collect()}
    assert grouped == frame.groupby("g")["v"].median().to_dict()
    rough = ranking.exact_quantiles(df, "v", {"m": 0.5}, approximate=True).first().m
    assert abs(rough - frame["v"].median()) <= 1


def test_quantiles_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(3.0,)], "v double")
    assert ranking.exact_quantiles(one, "v", {"m": 0.5}).first().m == 3.0
    assert ranking.exact_quantiles(one.filter("false"), "v", {"m": 0.5}).first().m is None


@pytest.mark.parametrize("n", [5, 7, 23, 101])
def test_bins_match_ranked_qcut(spark, n):
    frame = pd.DataFrame({"id": np.arange(n), "v": np.arange(n) * 7 % 4})
    expected = pd.qcut(frame["v"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    found = ranking.quantile_bin(spark.createDataFrame(frame), "v", 5, "id", "bin").orderBy("id").toPandas()
    assert found["bin"].tolist() == expected.tolist()


def test_bin_of_a_single_row(spark):
    assert ranking.quantile_bin(spark.createDataFrame([(1, 2)], "id int, v int"), "v", 5, "id", "bin").first().bin == 1


def test_temporal_split_sizes_and_order(spark, spread):
    df = spark.range(101).select(F.col("id"), (100 - F.col("id")).alias("ts"))
    split = ranking.temporal_split(df, "ts", "id").groupBy("split").agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    assert {r.split: (r.n, r.a, r.b) for r in split.collect()} == {"train": (70, 0, 69), "validation": (15, 70, 84), "test": (16, 85, 100)}


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500)
    first = rows(ranking.sample_exact(df, "id", 50), "id")
    assert len(first) == 50 and first == rows(ranking.sample_exact(df.repartition(7), "id", 50), "id")
    assert ranking.sample_exact(df, "id", 9999).count() == 500


def test_statistics_match_numpy_and_pandas(values, spread):
    frame, df = values
    other = df.withColumn("w", (F.col("v") * F.col("v") + F.col("id") % 7).cast("double"))
    pdf = other.toPandas()
    assert statistics.spearman(other, "v", "w").first()[0] == pytest.approx(pdf["v"].rank().corr(pdf["w"].rank()))
    assert statistics.pearson(other, "v", "w").first()[0] == pytest.approx(pdf["v"].corr(pdf["w"]))
    bins = statistics.histogram(other, "w", 13).toPandas()
    counts, edges = np.histogram(pdf["w"], bins=13)
    assert bins["n"].tolist() == counts.tolist() and np.allclose(bins["lower"], edges[:-1])
    cells = statistics.hexbin(other, "v", "w", gridsize=10, cap=None).toPandas()
    assert cells["n"].sum() == len(pdf) and (cells["n"] > 0).all()
    banded = statistics.quantile_band(other, "v", 4, "band").toPandas()
    assert banded["band"].tolist() == (pd.qcut(banded["v"], 4, duplicates="drop", labels=False) + 1).tolist()


def test_quantile_band_with_equal_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)] + [(None,)], "v double")
    assert sorted(map(str, rows(statistics.quantile_band(df, "v", 4, "b").select("v", "b").distinct()))) == ["(1.0, 1)", "(2.0, 1)", "(None, None)"]


def test_constant_histogram_and_top_values(spark):
    constant = spark.createDataFrame([(4.0,)] * 3, "v double")
    assert sum(r.n for r in statistics.histogram(constant, "v", 5).collect()) == 3
    df = spark.createDataFrame([("k", x) for x in "aabbcd"], "k string, v string")
    assert statistics.top_values_joined(df, "k", "v", 3, "top").first().top == "a, b, c"
