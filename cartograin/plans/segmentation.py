"""Customer segmentation: rule-based RFM segments and k-means clusters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import mean
from ..operators.joins import with_scalar
from ..operators.quality import DataQualityError, assert_rows
from ..operators.ranking import exact_quantiles, quantile_bin, sample_exact, share_of_total
from ..operators.statistics import crosstab_share, minmax, top_values_joined
from ..session import by_rows, checkpointed

RFM = ("recency", "frequency", "monetary")
PERSON = "customer_unique_id"

# Segment names and their rules in order of precedence.
# Each rule is (name, lowest/highest r, lowest/highest f, lowest/highest m).
SEGMENT_RULES = (
    ("Champions", (4, 5), (3, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (1, 5)),
    ("High Value At Risk", (1, 2), (1, 5), (4, 5)),
    ("New Customers", (5, 5), (1, 1), (1, 5)),
    ("Potential Loyalists", (4, 5), (2, 2), (1, 5)),
    ("Promising", (4, 5), (1, 5), (3, 5)),
    ("At Risk", (1, 2), (2, 5), (1, 5)),
    ("Needs Attention", (3, 3), (1, 5), (1, 5)),
    ("Hibernating", (1, 2), (1, 5), (1, 5)),
)
DEFAULT_SEGMENT = "Promising"


# --- rules ----------------------------------------------------------------


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """Adds r_score (recent = 5) and m_score by rank quintile, and f_score =
    frequency up to 5."""
    scored = quantile_bin(rfm, "recency", 5, PERSON, "r_score", reverse=True)
    scored = quantile_bin(scored, "monetary", 5, PERSON, "m_score")
    f = F.col("frequency")
    return scored.withColumn("f_score", F.when(f >= 1, F.least(f, F.lit(5))).otherwise(1).cast("int"))


def rfm_segment(scored: DataFrame) -> DataFrame:
    """First matching rule wins."""
    ladder = None
    for name, *bounds in SEGMENT_RULES:
        match = F.lit(True)
        for column, (low, high) in zip(("r_score", "f_score", "m_score"), bounds):
            match = match & F.col(column).between(low, high)
        ladder = F.when(match, name) if ladder is None else ladder.when(match, name)
    return scored.withColumn("rfm_segment", ladder.otherwise(DEFAULT_SEGMENT))


def segment_distribution(segmented: DataFrame) -> DataFrame:
    counts = segmented.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customers"))
    return share_of_total(counts, "customers", "customer_share", bounded=True).orderBy(F.desc("customers"), "rfm_segment")


# --- clusters -------------------------------------------------------------


def preparation(rows: int) -> list:
    """log1p of each measure, then standardised with the population deviation."""
    logs = ", ".join(f"log1p(cast({c} AS double)) AS log_{c}" for c in RFM)
    n = max(rows, 2)
    return [
        SQLTransformer(statement=f"SELECT *, {logs} FROM __THIS__"),
        VectorAssembler(inputCols=[f"log_{c}" for c in RFM], outputCol="log_rfm"),
        StandardScaler(inputCol="log_rfm", outputCol="scaled_rfm", withMean=True, withStd=True),
        ElementwiseProduct(
            scalingVec=Vectors.dense([(n / (n - 1)) ** 0.5] * len(RFM)), inputCol="scaled_rfm", outputCol="features"
        ),
    ]


@dataclass
class Prepared:
    """Fitted preparation and its cached output."""

    model: PipelineModel
    frame: DataFrame


def prepare(rfm: DataFrame) -> Prepared:
    rows = rfm.count()
    model = Pipeline(stages=preparation(rows)).fit(rfm)
    return Prepared(model, by_rows(model.transform(rfm).select(*rfm.columns, "features"), rows).persist())


def _fit_all(prepared: Prepared, wanted: Sequence[tuple[int, int]]) -> list:
    """A k-means model for each (k, seed). A fit is many short jobs, so as many
    fits as there are cores run side by side; a fit does not depend on the others.

    A fit given a stored frame decodes its rows in every iteration; given a
    projection of it, it keeps the vectors themselves.
    """
    features = prepared.frame.select("features")

    def fit(k_and_seed: tuple[int, int]):
        k, seed = k_and_seed
        return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster_id", maxIter=300).fit(features)

    prepared.frame.count()  # cached before the first fit reads it
    spark = prepared.frame.sparkSession
    with ThreadPool(max(1, min(len(wanted), spark.sparkContext.defaultParallelism))) as pool:
        return pool.map(inheritable_thread_target(spark)(fit), wanted, chunksize=1)


def fit_cluster_family(prepared: Prepared, ks: Sequence[int], restarts: int = 20, seed: int = 42) -> dict:
    """For each k the best of ``restarts`` seeded runs by within-cluster cost."""
    wanted = [(k, seed + attempt) for k in ks for attempt in range(restarts)]
    best: dict = {}
    for (k, _), model in zip(wanted, _fit_all(prepared, wanted)):
        if k not in best or model.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = model
    return best


def fit_clusters(prepared: Prepared, k: int, restarts: int = 20, seed: int = 42):
    """Best of ``restarts`` seeded runs by within-cluster cost."""
    return fit_cluster_family(prepared, [k], restarts, seed)[k]


def cluster_pipeline(prepared: Prepared, k: int, restarts: int = 20, seed: int = 42) -> PipelineModel:
    return PipelineModel([*prepared.model.stages, fit_clusters(prepared, k, restarts, seed)])


def _silhouettes(points: np.ndarray, labels: dict[int, np.ndarray]):
    """Per task: silhouette of each row of a batch against the shared sample."""

    def score(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = (batch[i : i + 256] for batch in batches for i in range(0, len(batch), 256))
        for batch in pieces:
            x = np.array(batch["x"].tolist(), dtype=float).reshape(len(batch), -1)
            gaps = np.sqrt(((x[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
            out = {}
            for k, assigned in labels.items():
                own = batch[f"c{k}"].to_numpy()
                sizes = np.bincount(assigned, minlength=k)
                sums = np.stack([gaps[:, assigned == c].sum(axis=1) for c in range(k)], axis=1)
                mine = sizes[own]
                rows = np.arange(len(batch))
                inner = sums[rows, own] / np.maximum(mine - 1, 1)
                other = np.where(sizes > 0, sums / np.maximum(sizes, 1), np.inf)
                other[rows, own] = np.inf
                outer = other.min(axis=1)
                top = np.maximum(inner, outer)
                value = np.where((mine > 1) & np.isfinite(outer) & (top > 0), (outer - inner) / np.where(top > 0, top, 1), 0.0)
                out[f"s{k}"] = value
            yield pd.DataFrame(out)

    return score


def sampled_silhouette(labelled: DataFrame, ks: Sequence[int], sample: int = 10_000, seed: int = 42) -> DataFrame:
    """Mean Euclidean silhouette for each labelling ``c<k>`` on at most
    ``sample`` people: (k, silhouette_score).

    The sample (three numbers and the labels per person) is shared with every
    task; the rows stay partitioned and each task scores its own.
    """
    chosen = sample_exact(labelled, PERSON, sample, seed)
    chosen = chosen.select(vector_to_array("features").alias("x"), *[F.col(f"c{k}").cast("int").alias(f"c{k}") for k in ks])
    held = chosen.toPandas()  # at most ``sample`` rows
    points = np.array(held["x"].tolist(), dtype=float).reshape(len(held), -1)
    labels = {k: held[f"c{k}"].to_numpy() for k in ks}
    spread = labelled.sparkSession.createDataFrame(held).repartition(labelled.sparkSession.sparkContext.defaultParallelism)
    schema = ", ".join(f"s{k} double" for k in ks)
    scored = spread.mapInPandas(_silhouettes(points, labels), schema)
    averages = scored.agg(*[F.avg(f"s{k}").alias(f"s{k}") for k in ks])
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"s{k}").alias("silhouette_score")) for k in ks])
    return averages.select(F.explode(pairs).alias("p")).select("p.k", "p.silhouette_score")


def full_silhouette(labelled: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Silhouette of squared distances for each labelling ``c<k>`` over all
    people: (k, silhouette_score). The distance of a point to a cluster follows
    from the cluster's count, sum and sum of squares, so the pass is linear."""
    measure = ClusteringEvaluator(featuresCol="features", metricName="silhouette", distanceMeasure="squaredEuclidean")
    scores = [(k, float(measure.setPredictionCol(f"c{k}").evaluate(labelled))) for k in ks]
    return labelled.sparkSession.createDataFrame(scores, "k int, silhouette_score double")


def evaluate_k(
    rfm: DataFrame, ks: Sequence[int] = range(2, 9), restarts: int = 20, seed: int = 42, sample: int | None = None
) -> tuple[DataFrame, dict[int, PipelineModel]]:
    """Cost, silhouette and smallest cluster for each k, and the models.

    The silhouette is of squared distances over all people; with ``sample`` it
    is the Euclidean one over that many people instead.
    """
    prepared = prepare(rfm)
    ks = list(ks)
    rows, models = [], {}
    labelled = prepared.frame.select(PERSON, "features")
    for k, clusters in fit_cluster_family(prepared, ks, restarts, seed).items():
        models[k] = PipelineModel([*prepared.model.stages, clusters])
        labelled = clusters.setPredictionCol(f"c{k}").transform(labelled)
        clusters.setPredictionCol("cluster_id")
        sizes = clusters.summary.clusterSizes
        rows.append((k, float(clusters.summary.trainingCost), int(min(sizes)), min(sizes) / sum(sizes)))
    costs = rfm.sparkSession.createDataFrame(
        rows, "k int, inertia double, minimum_cluster_size long, minimum_cluster_share double"
    )
    scores = full_silhouette(labelled, ks) if sample is None else sampled_silhouette(labelled, ks, sample, seed)
    result = costs.join(F.broadcast(scores), "k").select(
        "k", "inertia", "silhouette_score", "minimum_cluster_size", "minimum_cluster_share"
    )
    result = checkpointed(result.orderBy("k"))  # one row per k
    prepared.frame.unpersist()
    return result, models


def select_k(results: DataFrame, min_share: float = 0.02, margin: float = 0.03, largest: int = 6) -> int:
    """Among k whose smallest cluster is not tiny and whose silhouette is close
    to the best, the largest k up to ``largest``; else the best silhouette. The
    table has one row per k."""
    table = [row.asDict() for row in results.collect()]
    stable = [r for r in table if r["minimum_cluster_share"] >= min_share] or table
    top = max(r["silhouette_score"] for r in stable)
    near = [r for r in stable if r["silhouette_score"] >= top - margin]
    modest = [r["k"] for r in near if r["k"] <= largest]
    return max(modest) if modest else max(near, key=lambda r: r["silhouette_score"])["k"]


def cluster_profiles(clustered: DataFrame) -> DataFrame:
    """One row per cluster, without names."""
    everyone = clustered.agg(F.count(F.lit(1)).alias("_people"), F.sum(F.col("monetary")).cast("double").alias("_revenue"))
    basics = clustered.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("customer_count"),
        mean("monetary").alias("mean_monetary"),
        F.sum("monetary").cast("double").alias("total_revenue"),
        F.avg((F.col("frequency") > 1).cast("int")).alias("repeat_customer_rate"),
    )
    # The three measures are stacked, so their medians share one sort.
    stacked = F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("double").alias("v")) for m in RFM])
    long = clustered.select("cluster_id", F.explode(stacked).alias("_e")).select("cluster_id", "_e.m", "_e.v")
    middles = exact_quantiles(long, "v", {"median": 0.5}, by=["cluster_id", "m"])
    medians = middles.groupBy("cluster_id").agg(
        *[F.max(F.when(F.col("m") == m, F.col("median"))).alias(f"median_{m}") for m in RFM]
    )
    basics = basics.join(medians, "cluster_id", "left")
    states = top_values_joined(clustered, "cluster_id", "customer_state", 3, "top_customer_states")
    joined = with_scalar(basics.join(states, "cluster_id", "left"), everyone)
    return joined.select(
        "cluster_id",
        "customer_count",
        "median_recency",
        "median_frequency",
        "median_monetary",
        "mean_monetary",
        "total_revenue",
        "repeat_customer_rate",
        (F.lit(100.0) * F.col("customer_count") / F.col("_people")).alias("customer_percentage"),
        (F.lit(100.0) * F.col("total_revenue") / F.col("_revenue")).alias("revenue_share"),
        "top_customer_states",
    ).orderBy("cluster_id")


def cluster_names(profiles: DataFrame) -> dict[int, str]:
    """A distinct name per cluster, read off the profile table (one row per
    cluster)."""
    rows = sorted((r.asDict() for r in profiles.collect()), key=lambda r: r["cluster_id"])
    if len(rows) == 2:
        high, low = sorted(rows, key=lambda r: -r["repeat_customer_rate"])
        if high["repeat_customer_rate"] > 0.9 and low["repeat_customer_rate"] < 0.1:
            return {high["cluster_id"]: "Repeat High-Value Customers", low["cluster_id"]: "One-Time Customers"}
    # Names in turn, each taken by the cluster that leads on the trait.
    traits = (
        ("High-Value Customers", lambda r: -r["mean_monetary"]),
        ("Repeat Customers", lambda r: (-r["repeat_customer_rate"], -r["median_frequency"])),
        ("Recent Customers", lambda r: r["median_recency"]),
        ("Hibernating Customers", lambda r: -r["median_recency"]),
    )
    names: dict[int, str] = {}
    waiting = list(rows)
    for name, trait in traits:
        if waiting:
            leader = min(waiting, key=trait)
            names[leader["cluster_id"]] = name
            waiting.remove(leader)
    names.update({r["cluster_id"]: f"Occasional Customers {i}" for i, r in enumerate(waiting, 1)})
    return names


def with_cluster_names(df: DataFrame, names: dict[int, str]) -> DataFrame:
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return df.withColumn("cluster_name", F.element_at(lookup, F.col("cluster_id")))


def minmax_profile(profiles: DataFrame) -> DataFrame:
    columns = [f"median_{m}" for m in RFM]
    return minmax(profiles.select("cluster_id", *columns), columns)


def pca_2d(prepared: Prepared) -> tuple[DataFrame, list[float]]:
    """Two coordinates per person and the variance share of each. The features
    are centred, so the projection is too; the sign of an axis is arbitrary."""
    model = PCA(k=2, inputCol="features", outputCol="components").fit(prepared.frame)
    pair = vector_to_array("components")
    placed = model.transform(prepared.frame).select(PERSON, pair[0].alias("pc1"), pair[1].alias("pc2"))
    return placed, [float(v) for v in model.explainedVariance]


def predict_segment(model: PipelineModel, customers: DataFrame, names: dict[int, str]) -> DataFrame:
    """Cluster id and name per row; a missing column is refused at once, a
    missing or negative value fails the query."""
    missing = sorted(set(RFM) - set(customers.columns))
    if missing:
        raise DataQualityError(f"segment input lacks {missing}")
    bad = F.lit(False)
    for c in RFM:
        bad = bad | ~F.coalesce(F.col(c) >= 0, F.lit(False))
    guard = F.when(bad, F.raise_error(F.lit("RFM values must be present and non-negative")).cast("double"))
    checked = customers.withColumn("recency", F.coalesce(guard, F.col("recency").cast("double")))
    labelled = model.transform(checked).select(*customers.columns, "cluster_id")
    return with_cluster_names(labelled, names)


@dataclass
class TrainedSegments:
    k: int
    model: PipelineModel
    names: dict[int, str]
    results: DataFrame
    profiles: DataFrame
    customers: DataFrame
    crosstab: DataFrame


def rule_by_cluster(customers: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per rule segment the share of its people in each named cluster."""
    return crosstab_share(customers, "rfm_segment", "cluster_name", list(names))


def checked_rfm(rfm: DataFrame) -> DataFrame:
    """Raises on a repeated person or a missing or negative measure."""
    return assert_rows(rfm, [PERSON], {f"{c} is not negative": F.col(c) >= 0 for c in RFM})


def export(trained: TrainedSegments, path: str) -> None:
    """Model, customers with their segments, profiles, k table, rule-by-cluster
    shares and names below ``path``."""
    trained.model.write().overwrite().save(f"{path}/model")
    for name, frame in (
        ("customers", trained.customers),
        ("profiles", trained.profiles),
        ("k_selection", trained.results),
        ("rule_by_cluster", trained.crosstab),
    ):
        frame.write.mode("overwrite").parquet(f"{path}/{name}")


def train(rfm: DataFrame, ks: Sequence[int] = range(2, 9), restarts: int = 20, seed: int = 42) -> TrainedSegments:
    rfm = checked_rfm(checkpointed(rfm))
    segmented = checkpointed(rfm_segment(rfm_scores(rfm)))
    results, models = evaluate_k(segmented, ks, restarts, seed)
    k = select_k(results)
    clustered = checkpointed(models[k].transform(segmented).select(*segmented.columns, "cluster_id"))
    profiles = cluster_profiles(clustered)
    names = cluster_names(profiles)
    named = with_cluster_names(clustered, names)
    return TrainedSegments(
        k, models[k], names, results, with_cluster_names(profiles, names), named, rule_by_cluster(named, list(names.values()))
    )
