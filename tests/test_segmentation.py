import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cartograin.operators.quality import DataQualityError
from cartograin.plans import segmentation as L


@pytest.fixture(scope="module")
def rfm(spark):
    generator = np.random.default_rng(4)
    n = 240
    repeat = np.arange(n) % 4 == 0
    frame = pd.DataFrame(
        {
            "customer_unique_id": [f"u{i:04d}" for i in range(n)],
            "recency": generator.integers(1, 400, n),
            "frequency": np.where(repeat, generator.integers(5, 9, n), 1),
            "monetary": np.where(repeat, generator.random(n) * 5000 + 3000, generator.random(n) * 50 + 10),
            "customer_state": generator.choice(["SP", "RJ"], n),
        }
    )
    return spark.createDataFrame(frame).cache()


def test_scores_and_first_matching_rule(spark, rfm):
    # Ten people: two per fifth, ties by person.
    ten = [(f"p{i}", (i // 3) * 10, 1 + i, 100.0 - 10 * i) for i in range(10)]
    scored = L.rfm_scores(spark.createDataFrame(ten, "customer_unique_id string, recency int, frequency int, monetary double"))
    found = {x.customer_unique_id: (x.r_score, x.f_score, x.m_score) for x in scored.collect()}
    assert [found[f"p{i}"][0] for i in range(10)] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    assert [found[f"p{i}"][1] for i in range(10)] == [1, 2, 3, 4, 5, 5, 5, 5, 5, 5]
    assert [found[f"p{i}"][2] for i in range(10)] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    cases = {(4, 3, 4): "Champions", (3, 3, 1): "Loyal Customers", (2, 5, 5): "High Value At Risk", (5, 1, 5): "New Customers",
             (4, 2, 1): "Potential Loyalists", (4, 1, 3): "Promising", (1, 2, 1): "At Risk", (3, 1, 1): "Needs Attention",
             (2, 1, 1): "Hibernating", (4, 1, 1): "Promising"}
    df = spark.createDataFrame(list(cases), "r_score int, f_score int, m_score int")
    assert {(x.r_score, x.f_score, x.m_score): x.rfm_segment for x in L.rfm_segment(df).collect()} == cases


def test_training_finds_the_two_groups(rfm):
    trained = L.train(rfm, ks=range(2, 4), restarts=2)
    counts = {x.cluster_name: x.customer_count for x in trained.profiles.collect()}
    if trained.k == 2:
        assert counts == {"Repeat High-Value Customers": 60, "One-Time Customers": 180}
    assert sum(counts.values()) == 240
    predicted = L.predict_segment(trained.model, rfm.select("customer_unique_id", *L.RFM), trained.names)
    assert predicted.filter(F.col("cluster_name").isNull()).count() == 0
    with pytest.raises(DataQualityError):
        L.predict_segment(trained.model, rfm.drop("monetary"), trained.names)
    with pytest.raises(Exception, match="non-negative"):
        L.predict_segment(trained.model, rfm.withColumn("monetary", F.lit(-1.0)), trained.names).collect()


def test_training_is_gated_and_exported(spark, rfm, tmp_path):
    trained = L.train(rfm, ks=range(2, 4), restarts=2)
    L.export(trained, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "customers")).count() == 240
    shares = spark.read.parquet(str(tmp_path / "rule_by_cluster"))
    assert all(sum(r[1:]) == pytest.approx(1) for r in shares.collect())
    again = L.predict_segment(PipelineModel.load(str(tmp_path / "model")), rfm, trained.names)
    assert {(r.customer_unique_id, r.cluster_id) for r in again.collect()} == {(r.customer_unique_id, r.cluster_id) for r in trained.customers.collect()}
    scaled = L.minmax_profile(trained.profiles).toPandas()
    assert scaled["median_monetary"].min() == 0 and scaled["median_monetary"].max() == 1
    for bad in (rfm.unionByName(rfm.limit(1)), rfm.withColumn("recency", F.lit(-1))):
        with pytest.raises(DataQualityError):
            L.train(bad, ks=range(2, 3), restarts=1)


def test_full_silhouette_matches_its_definition(rfm):
    prepared = L.prepare(rfm)
    label = F.pmod(F.xxhash64("customer_unique_id"), F.lit(3)).cast("int")
    labelled = prepared.frame.select("customer_unique_id", "features", label.alias("c3"))
    found = L.full_silhouette(labelled, [3]).first().silhouette_score
    pdf = labelled.toPandas()
    x, c = np.array([v.toArray() for v in pdf["features"]]), pdf["c3"].to_numpy()
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    scores = []
    for i in range(len(x)):
        a = d[i, c == c[i]].sum() / ((c == c[i]).sum() - 1)
        b = min(d[i, c == k].mean() for k in range(3) if k != c[i])
        scores.append((b - a) / max(a, b))
    assert found == pytest.approx(np.mean(scores))


def test_silhouette_matches_its_definition(rfm):
    prepared = L.prepare(rfm)
    labelled = prepared.frame.select("customer_unique_id", "features", (F.xxhash64("customer_unique_id") % 3 + 2).alias("c3"))
    labelled = labelled.withColumn("c3", F.pmod(F.col("c3"), F.lit(3)).cast("int"))
    found = L.sampled_silhouette(labelled, [3]).first().silhouette_score
    pdf = labelled.toPandas()
    x, c = np.array([v.toArray() for v in pdf["features"]]), pdf["c3"].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i in range(len(x)):
        a = d[i, c == c[i]].sum() / ((c == c[i]).sum() - 1)
        b = min(d[i, c == k].mean() for k in range(3) if k != c[i])
        scores.append((b - a) / max(a, b))
    assert found == pytest.approx(np.mean(scores))
    assert np.allclose(x.mean(axis=0), 0, atol=1e-9) and np.allclose(x.std(axis=0), 1)


def test_select_k_prefers_detail_among_near_equals(spark):
    def pick(data):
        return L.select_k(spark.createDataFrame(data, "k int, silhouette_score double, minimum_cluster_share double"))

    assert pick([(2, 0.70, 0.1), (3, 0.68, 0.05), (4, 0.69, 0.01), (8, 0.71, 0.1)]) == 3
    assert pick([(7, 0.50, 0.1), (8, 0.52, 0.1), (2, 0.1, 0.1)]) == 8
    assert pick([(2, 0.4, 0.001), (3, 0.3, 0.001)]) == 2


def test_names_are_distinct(spark):
    data = [(i, float(100 - i), 0.1 * i, float(i), float(50 + 10 * i)) for i in range(6)]
    profiles = spark.createDataFrame(data, "cluster_id int, mean_monetary double, repeat_customer_rate double, median_frequency double, median_recency double")
    names = L.cluster_names(profiles)
    assert len(set(names.values())) == 6 and names[0] == "High-Value Customers" and names[5] == "Repeat Customers"


def test_pca_is_centred(rfm):
    placed, shares = L.pca_2d(L.prepare(rfm))
    means = placed.agg(F.avg("pc1"), F.avg("pc2")).first()
    assert abs(means[0]) < 1e-9 and abs(means[1]) < 1e-9 and 0 < shares[1] <= shares[0] <= 1


def test_fits_run_side_by_side_and_equal_single_ones(rfm, monkeypatch):
    """a fit is many short jobs, so the runs of all k share the cores."""
    import threading

    used, plain = set(), L.KMeans

    class Watched(plain):
        def fit(self, frame):
            used.add(threading.get_ident())
            return super().fit(frame)

    prepared = L.prepare(rfm)
    alone = [plain(k=3, seed=s, featuresCol="features", maxIter=300).fit(prepared.frame).summary.trainingCost for s in (42, 43)]
    monkeypatch.setattr(L, "KMeans", Watched)
    found = L.fit_cluster_family(prepared, [2, 3], restarts=2)
    assert list(found) == [2, 3] and len(used) > 1 and threading.get_ident() not in used
    assert found[3].summary.trainingCost == pytest.approx(min(alone))
