"""Late-delivery classification: features, candidates, selection, scoring."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import (
    DEFAULT_RULES,
    StatusRules,
    category_label,
    days_between,
    is_delivered,
    is_late,
    iso_weekday,
    risk_label,
    same_state_flag,
    zip_region,
)
from ..operators.evaluation import (
    average_precision,
    best_threshold,
    classification_metrics,
    grouped_error_analysis,
    score_table,
    threshold_table,
)
from ..operators.forests import DealtForest
from ..operators.joins import lookup_join
from ..operators.quality import assert_rows, audit_features, refuse_features
from ..operators.ranking import column_quantiles, distributed_rank, sample_exact, temporal_split, top_k
from ..session import by_rows, checkpointed

# Fixed lists: the feature names.
NUMERIC = (
    "purchase_month",
    "purchase_day_of_week",
    "purchase_hour",
    "customer_zip_region",
    "item_value",
    "freight_value",
    "item_count",
    "unique_products",
    "seller_count",
    "total_product_weight_g",
    "average_product_length_cm",
    "average_product_height_cm",
    "average_product_width_cm",
    "payment_value",
    "payment_installments",
    "estimated_delivery_window_days",
)
CATEGORICAL = (
    "customer_state",
    "dominant_product_category",
    "dominant_seller_state",
    "same_customer_seller_state",
    "payment_type",
)
FEATURES = NUMERIC + CATEGORICAL
TARGET, KEY, TIME = "is_late_delivery", "order_id", "purchase_timestamp"

# Fixed list: columns that are only known once the outcome is.
PROHIBITED = (
    "order_delivered_customer_date",
    "order_delivered_carrier_date",
    "delivered_customer_at",
    "delivered_carrier_at",
    "delivery_days",
    "delivery_delay_days",
    "review_score",
    "review_comment_title",
    "review_comment_message",
    "review_creation_date",
    "review_answer_timestamp",
    TARGET,
)

# The table whose columns a feature is computed from.
ORIGIN = {
    "orders": ("purchase_month", "purchase_day_of_week", "purchase_hour", "estimated_delivery_window_days"),
    "customers": ("customer_state", "customer_zip_region"),
    "order_items": ("item_value", "freight_value", "item_count", "unique_products", "seller_count"),
    "products": (
        "total_product_weight_g",
        "average_product_length_cm",
        "average_product_height_cm",
        "average_product_width_cm",
        "dominant_product_category",
    ),
    "sellers": ("dominant_seller_state",),
    "customers, sellers": ("same_customer_seller_state",),
    "payments": ("payment_type", "payment_value", "payment_installments"),
}
SOURCE = {feature: table for table, features in ORIGIN.items() for feature in features}


# --- features -------------------------------------------------------------


def basket_features(items: DataFrame, products: DataFrame, sellers: DataFrame, translation: DataFrame) -> DataFrame:
    """One row per order with items.

    Items of one order, product and seller are one row with their number before
    they are joined. The joined rows are dealt out by order, and only there each
    yields one row for the sums and one per counted value; these are combined and
    folded per order where they are. They are dealt over the session's number of
    shuffle partitions as it is: adaptive execution joins partitions by the size
    before the rows multiply, and such a partition would not fit in memory.
    """
    catalogue = lookup_join(products, translation, "product_category_name", "left").select(
        "product_id",
        category_label().alias("category"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    lines = items.groupBy("order_id", "product_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"), F.sum("freight_value").alias("freight")
    )
    detail = lookup_join(lines, catalogue, "product_id")
    detail = lookup_join(detail, sellers.select("seller_id", "seller_state"), "seller_id")
    sizes = ("length", "height", "width")
    n = F.col("n")
    measures = {
        "price": F.col("price"),
        "freight": F.col("freight"),
        "weight": n * F.col("product_weight_g"),
        **{size: n * F.col(f"product_{size}_cm").cast("double") for size in sizes},
        **{f"{size}_n": F.when(F.col(f"product_{size}_cm").isNotNull(), n) for size in sizes},
    }
    # Row kinds: 0 carries the measures, 1 to 4 carry one value to count each.
    category, state, product, seller = 1, 2, 3, 4
    counted = {category: "category", state: "seller_state", product: "product_id", seller: "seller_id"}
    partitions = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = detail.repartition(partitions, "order_id")
    shaped = dealt.select("order_id", "n", *counted.values(), *[c.alias(f"_{name}") for name, c in measures.items()])
    nothing = [F.lit(None).cast(shaped.schema[f"_{name}"].dataType) for name in measures]
    cells = [F.lit(0), F.lit(None).cast("string"), n, *[F.col(f"_{name}") for name in measures]]
    for kind, name in counted.items():
        cells += [F.lit(kind), F.col(name).cast("string"), n, *nothing]
    grouped = (
        shaped.select("order_id", F.stack(F.lit(len(counted) + 1), *cells).alias("kind", "v", "n", *measures))
        .groupBy("order_id", "kind", "v")
        .agg(*[F.sum(name).alias(name) for name in ("n", *measures)])
    )

    def of(kind: int, value):
        return F.when(F.col("kind") == kind, value)

    def dominant(kind: int):
        entry = F.struct((-F.col("n")).alias("s"), F.col("v").isNull().alias("m"), F.col("v").alias("v"))
        return F.min(of(kind, entry))["v"]

    return grouped.groupBy("order_id").agg(
        F.max("price").cast("double").alias("item_value"),
        F.max("freight").cast("double").alias("freight_value"),
        F.max(of(0, F.col("n"))).alias("item_count"),
        F.count(of(product, F.col("v"))).alias("unique_products"),
        F.count(of(seller, F.col("v"))).alias("seller_count"),
        F.max("weight").cast("double").alias("total_product_weight_g"),
        *[F.max(F.col(size) / F.col(f"{size}_n")).alias(f"average_product_{size}_cm") for size in sizes],
        dominant(category).alias("dominant_product_category"),
        dominant(state).alias("dominant_seller_state"),
    )


def payment_features(payments: DataFrame) -> DataFrame:
    """Per order: total, longest plan, and the type with the largest amount."""
    by_type = payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("value"), F.max("payment_installments").alias("plan")
    )
    largest = F.min(F.struct((-F.col("value")).alias("v"), F.col("payment_type").alias("t")))
    return by_type.groupBy("order_id").agg(
        largest["t"].alias("payment_type"),
        F.sum("value").cast("double").alias("payment_value"),
        F.max("plan").alias("payment_installments"),
    )


def modeling_dataset(tables: Mapping[str, DataFrame], rules: StatusRules = DEFAULT_RULES) -> DataFrame:
    """One row per delivered order with items: 21 features and the target.

    Items and payments of orders in another status are left out before anything
    else is done with them; which status an order has needs no delivery date.
    """
    candidates = tables["orders"].filter(F.col("order_status") == rules.delivered).select("order_id")
    items = lookup_join(tables["order_items"], candidates, "order_id", "left_semi")
    payments = lookup_join(tables["payments"], candidates, "order_id", "left_semi")
    purchased = F.col("order_purchase_timestamp")
    known = tables["orders"].filter(is_delivered(rules) & F.col("order_estimated_delivery_date").isNotNull())
    outcome = known.select(
        "order_id",
        "customer_id",
        purchased.alias(TIME),
        F.month(purchased).alias("purchase_month"),
        iso_weekday(purchased).alias("purchase_day_of_week"),
        F.hour(purchased).alias("purchase_hour"),
        days_between(purchased, "order_estimated_delivery_date").alias("estimated_delivery_window_days"),
        is_late().cast("int").alias(TARGET),
    )
    people = tables["customers"].select(
        "customer_id", "customer_state", zip_region("customer_zip_code_prefix").alias("customer_zip_region")
    )
    located = lookup_join(outcome, people, "customer_id")
    baskets = basket_features(
        items, tables["products"], tables["sellers"], tables["product_category_translation"]
    )
    joined = lookup_join(located, baskets, "order_id")
    joined = lookup_join(joined, payment_features(payments), "order_id", "left")
    flagged = joined.withColumn("same_customer_seller_state", same_state_flag("customer_state", "dominant_seller_state"))
    return flagged.select(KEY, TIME, *FEATURES, TARGET)


def checked_dataset(dataset: DataFrame) -> DataFrame:
    """Raises on a repeated order, a target outside {0, 1} or a leaking feature."""
    refuse_features(dataset, FEATURES, SOURCE, PROHIBITED)
    return assert_rows(dataset, [KEY], {"target is 0 or 1": F.col(TARGET).isin(0, 1)})


def feature_audit(dataset: DataFrame) -> DataFrame:
    return audit_features(dataset, FEATURES, SOURCE, PROHIBITED)


def split_dataset(dataset: DataFrame) -> DataFrame:
    return temporal_split(dataset, TIME, KEY)


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(TIME).alias("start"),
        F.max(TIME).alias("end"),
        F.sum(TARGET).alias("late_orders"),
        F.avg(TARGET).alias("late_prevalence"),
    )


# --- models ---------------------------------------------------------------


@dataclass(frozen=True)
class CandidateSettings:
    """Sizes of the candidate models."""

    inverse_penalty: float = 0.5
    logistic_iterations: int = 1000
    trees: int = 250
    tree_depth: int = 16
    tree_min_rows: int = 5
    boosting_rounds: int = 200
    boosting_rate: float = 0.08
    boosting_depth: int = 5
    seed: int = 42


def build_preprocessor(train: DataFrame, scale_numeric: bool) -> list:
    """Stages: median and mode imputation, one-hot encoding in which a category
    unseen in training becomes all zeros, and optional standardisation with the
    population deviation. Medians are exact, whatever the number of rows."""
    row = train.agg(
        F.count(F.lit(1)).alias("_n"), *[F.mode(c, deterministic=True).alias(c) for c in CATEGORICAL]
    ).first()
    middles = column_quantiles(train, NUMERIC, {"median": 0.5}).first()
    doubles = ", ".join(f"coalesce(cast({c} AS double), {float(middles[f'{c}_median'] or 0.0)!r}D) AS f_{c}" for c in NUMERIC)
    filled = ", ".join(f"coalesce({c}, '{_quoted(row[c])}') AS c_{c}" for c in CATEGORICAL)
    stages = [
        SQLTransformer(statement=f"SELECT *, {doubles}, {filled} FROM __THIS__"),
        StringIndexer(
            inputCols=[f"c_{c}" for c in CATEGORICAL],
            outputCols=[f"i_{c}" for c in CATEGORICAL],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"i_{c}" for c in CATEGORICAL], outputCols=[f"h_{c}" for c in CATEGORICAL], dropLast=True
        ),
        VectorAssembler(inputCols=[f"f_{c}" for c in NUMERIC], outputCol="numeric"),
    ]
    numeric = "numeric"
    if scale_numeric:
        n = max(int(row["_n"]), 2)
        stages += [
            StandardScaler(inputCol="numeric", outputCol="numeric_scaled", withMean=True, withStd=True),
            ElementwiseProduct(
                scalingVec=Vectors.dense([(n / (n - 1)) ** 0.5] * len(NUMERIC)),
                inputCol="numeric_scaled",
                outputCol="numeric_standard",
            ),
        ]
        numeric = "numeric_standard"
    stages.append(VectorAssembler(inputCols=[numeric, *[f"h_{c}" for c in CATEGORICAL]], outputCol="features"))
    return stages


def _quoted(text: str | None) -> str:
    return (text or "").replace("\\", "\\\\").replace("'", "\\'")


def dummy_prior(train: DataFrame) -> PipelineModel:
    """Every order gets the training prevalence."""
    share = float(train.agg(F.avg(TARGET)).first()[0])
    constant = f"SELECT *, array(1 - {share!r}D, {share!r}D) AS probability_array FROM __THIS__"
    return PipelineModel([SQLTransformer(statement=constant)])


# Up to so many training rows a forest is Spark's own: its histograms are few there.
FEW_ROWS = 5_000


def _estimators(settings: CandidateSettings, rows: int) -> dict[str, tuple[bool, object]]:
    shared = {"featuresCol": "features", "labelCol": TARGET, "weightCol": "_weight"}
    forest = {"numTrees": settings.trees, "maxDepth": settings.tree_depth, "minInstancesPerNode": settings.tree_min_rows, "seed": settings.seed, **shared}
    return {
        "LogisticRegression": (
            True,
            LogisticRegression(
                maxIter=settings.logistic_iterations,
                regParam=1.0 / (settings.inverse_penalty * rows),
                elasticNetParam=0.0,
                standardization=False,
                **shared,
            ),
        ),
        "RandomForestClassifier": (
            False,
            # A row keeps its node of every tree; without that, each pass sends all trees and walks them again.
            RandomForestClassifier(featureSubsetStrategy="sqrt", cacheNodeIds=True, checkpointInterval=-1, **forest)
            if rows <= FEW_ROWS
            else DealtForest(**forest),
        ),
        "GBTClassifier": (
            False,
            GBTClassifier(
                maxIter=settings.boosting_rounds,
                stepSize=settings.boosting_rate,
                maxDepth=settings.boosting_depth,
                seed=settings.seed,
                **shared,
            ),
        ),
    }


def fit_candidates(
    train: DataFrame,
    settings: CandidateSettings = CandidateSettings(),
    names: tuple[str, ...] = ("DummyClassifier", "LogisticRegression", "RandomForestClassifier", "GBTClassifier"),
) -> dict[str, PipelineModel]:
    """Fitted pipelines by name. Rows are weighted so both classes count alike,
    each preprocessing variant is fitted once and its output kept, and the
    candidates are fitted side by side."""
    models: dict[str, PipelineModel] = {}
    if "DummyClassifier" in names:
        models["DummyClassifier"] = dummy_prior(train)
    sizes = train.agg(F.count(F.lit(1)).alias("n"), F.sum(TARGET).alias("late")).first()
    rows, late = int(sizes["n"]), int(sizes["late"])
    if not 0 < late < rows:
        raise ValueError("training rows must hold both classes")
    weight = F.when(F.col(TARGET) == 1, rows / (2.0 * late)).otherwise(rows / (2.0 * (rows - late)))
    chosen = {name: choice for name, choice in _estimators(settings, rows).items() if name in names}
    prepared: dict[bool, tuple[PipelineModel, DataFrame]] = {}
    for scaled in dict.fromkeys(scaled for scaled, _ in chosen.values()):
        model = Pipeline(stages=build_preprocessor(train, scaled)).fit(train)
        frame = model.transform(train).withColumn("_weight", weight).select("features", TARGET, "_weight")
        prepared[scaled] = (model, by_rows(frame, rows, least=16).persist())

    cores = train.sparkSession.sparkContext.defaultParallelism

    def fit(name: str) -> PipelineModel:
        scaled, estimator = chosen[name]
        preprocessing, frame = prepared[scaled]
        if name != "RandomForestClassifier":
            # A thousand short jobs: tasks beyond the cores only add to each.
            frame = by_rows(frame, rows, least=min(16, cores))
        return PipelineModel([*preprocessing.stages, estimator.fit(frame)])

    if chosen:
        with ThreadPool(len(chosen)) as pool:
            models |= zip(chosen, pool.map(inheritable_thread_target(train.sparkSession)(fit), chosen, chunksize=1))
    for _, frame in prepared.values():
        frame.unpersist()
    return models


def score(model: Transformer, df: DataFrame, name: str = "late_delivery_probability") -> DataFrame:
    """``df`` with the probability of a late delivery."""
    scored = model.transform(df)
    pair = F.col("probability_array") if "probability_array" in scored.columns else vector_to_array("probability")
    return scored.select(*df.columns, pair[1].alias(name))


def compare_models(models: Mapping[str, Transformer], split: DataFrame) -> DataFrame:
    """Train and validation measures of every model at threshold 0.5, from one
    grouped pass over all scores."""
    parts = split.filter(F.col("split").isin("train", "validation"))
    scored = None
    for name, model in models.items():
        one = score(model, parts, "p").select(F.lit(name).alias("model"), "split", TARGET, "p")
        scored = one if scored is None else scored.unionByName(one)
    return classification_metrics(scored, TARGET, "p", 0.5, by=["model", "split"])


def select_model(comparison: DataFrame) -> DataFrame:
    """Best validation PR-AUC, then recall."""
    validation = comparison.filter(F.col("split") == "validation")
    return top_k(validation, [F.desc("pr_auc"), F.desc("recall"), "model"], 1)


def permutation_importance(
    model: Transformer, df: DataFrame, repeats: int = 3, sample: int | None = None, seed: int = 42
) -> DataFrame:
    """Loss of average precision when one raw feature is shuffled, on all rows
    (or on ``sample`` of them).

    Every (feature, repeat) variant is scored in one transform: a row takes the
    shuffled feature from the row at its place in a seeded order. Places come
    from range partitions, so no task numbers all rows.
    """
    chosen = df if sample is None else sample_exact(df, KEY, sample, seed)
    rows = checkpointed(chosen.select(KEY, TARGET, *FEATURES))
    numbered = distributed_rank(rows, [KEY], "_here")
    donors = None
    for repeat in range(repeats):
        shuffled = rows.select(F.xxhash64(KEY, F.lit(seed + repeat + 1)).alias("_order"), KEY, F.struct(*FEATURES).alias("_other"))
        one = distributed_rank(shuffled, ["_order", KEY], "_here").select("_here", F.lit(repeat).alias("repeat"), "_other")
        donors = one if donors is None else donors.unionByName(one)
    variants = numbered.join(donors, "_here").withColumn("feature", F.explode(F.array(*[F.lit(f) for f in FEATURES])))
    swapped = variants.select(
        KEY,
        TARGET,
        "feature",
        "repeat",
        *[F.when(F.col("feature") == f, F.col(f"_other.{f}")).otherwise(F.col(f)).alias(f) for f in FEATURES],
    )
    by = ["feature", "repeat"]
    shuffled = score_table(score(model, swapped, "p"), TARGET, "p", by).groupBy(*by).agg(average_precision().alias("ap"))
    base = score_table(score(model, rows, "p"), TARGET, "p").agg(average_precision().alias("base"))
    drop = F.col("base") - F.col("ap")
    return (
        shuffled.crossJoin(F.broadcast(base))
        .groupBy("feature")
        .agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )


def predict_late_delivery(model: Transformer, orders: DataFrame, threshold: float) -> DataFrame:
    """Probability, class and risk label for each row of a batch (or stream).
    A probability outside [0, 1] fails the query."""
    missing = sorted(set(FEATURES) - set(orders.columns))
    if missing:
        raise ValueError(f"scoring input lacks {missing}")
    p = F.col("late_delivery_probability")
    safe = F.when(p.between(0, 1), p).otherwise(F.raise_error(F.lit("probability outside [0, 1]")).cast("double"))
    scored = score(model, orders).withColumn("late_delivery_probability", safe)
    return scored.withColumns(
        {"predicted_late_delivery": (p >= threshold).cast("int"), "risk_label": risk_label(p, threshold)}
    )


@dataclass
class TrainedClassifier:
    name: str
    model: PipelineModel
    threshold: float
    comparison: DataFrame
    thresholds: DataFrame
    test_metrics: DataFrame
    errors: dict[str, DataFrame]
    importance: DataFrame


def save(trained: TrainedClassifier, path: str) -> None:
    """Model, its threshold and the evaluation tables below ``path``; what
    scoring needs is stored together."""
    spark = trained.comparison.sparkSession
    trained.model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(trained.name, trained.threshold)], "name string, threshold double").write.mode("overwrite").parquet(f"{path}/decision")
    for table, frame in (("comparison", trained.comparison), ("thresholds", trained.thresholds), ("test", trained.test_metrics), ("importance", trained.importance)):
        frame.write.mode("overwrite").parquet(f"{path}/{table}")


def predict_stored(path: str, orders: DataFrame) -> DataFrame:
    """Score a batch with the model and threshold stored at ``path``."""
    threshold = orders.sparkSession.read.parquet(f"{path}/decision").first()["threshold"]
    return predict_late_delivery(PipelineModel.load(f"{path}/model"), orders, threshold)


def train(dataset: DataFrame, settings: CandidateSettings = CandidateSettings()) -> TrainedClassifier:
    """Fit all candidates on the oldest orders, choose model and threshold on
    the next, and measure once on the newest."""
    split = checkpointed(split_dataset(checked_dataset(checkpointed(dataset))))
    models = fit_candidates(split.filter(F.col("split") == "train"), settings)
    comparison = compare_models(models, split)
    name = select_model(comparison).first()["model"]
    model = models[name]
    validation = score(model, split.filter(F.col("split") == "validation"), "p")
    thresholds = threshold_table(validation, TARGET, "p")
    threshold = float(best_threshold(thresholds).first()["threshold"])
    test = score(model, split.filter(F.col("split") == "test"), "p")
    return TrainedClassifier(
        name,
        model,
        threshold,
        comparison,
        thresholds,
        classification_metrics(test, TARGET, "p", threshold),
        grouped_error_analysis(test, TARGET, "p", threshold),
        permutation_importance(model, split.filter(F.col("split") == "validation")),
    )
