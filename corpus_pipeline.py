"""Documents to shards: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as
Parquet and reads again for the next. All but the last keep the columns of documents; the
last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartograin.llm.common import staged, table
from cartograin.llm.decontamination import without_leaks
from cartograin.llm.minhash_dedup import without_near_copies
from cartograin.llm.mixing import mixed
from cartograin.llm.quality_rules import Limits, without_rejected
from cartograin.llm.sharding import sharded

#: A line goes on its number of documents alone, so that a source may grow without excusing it.
LIMITS = Limits(line_percent=0)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return without_rejected(docs, LIMITS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and place in it."""
    return sharded(docs)


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# Alignment, seeded permutations and the flow have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
