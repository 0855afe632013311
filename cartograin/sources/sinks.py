"""Reports, run metadata, segment exports and fitted models on shared storage."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXPORT_COLUMNS = (
    "customer_unique_id",
    "recency",
    "frequency",
    "monetary",
    "rfm_segment",
    "cluster_id",
    "cluster_name",
)


def write_report(df: DataFrame, path: str) -> None:
    """A metric table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_metadata(spark: SparkSession, metadata: Mapping[str, object], path: str) -> None:
    """One JSON object. Values may be scalars, lists, dicts or one-row frames
    (stored as structs), so no data passes through the driver for it."""
    row = spark.range(1).select(F.lit(1).alias("_one"))
    for name, value in metadata.items():
        if isinstance(value, DataFrame):
            packed = value.limit(1).select(F.struct(*[F.col(c) for c in value.columns]).alias(name))
            row = row.crossJoin(F.broadcast(packed))
        else:
            row = row.withColumn(name, _literal(value))
    row.drop("_one").coalesce(1).write.mode("overwrite").json(path)


def _literal(value: object):
    if isinstance(value, Mapping):
        return F.struct(*[_literal(v).alias(str(k)) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        return F.array(*[_literal(v) for v in value])
    return F.lit(value)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def export_segments(df: DataFrame, path: str) -> None:
    """One row per customer, only the published columns."""
    df.select(*EXPORT_COLUMNS).write.mode("overwrite").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
