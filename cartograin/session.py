"""Session settings the operators rely on, and the one way to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings for skewed and very large inputs. Split sizes and the number
# of shuffle partitions belong to the cluster and are left alone.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Timestamps carry no zone; UTC keeps daylight-saving shifts out of durations.
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cartograin")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution with skew splitting for this session."""
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    With the setting absent, a folder of this machine is set for a local master;
    on a cluster that would not survive the loss of a node, so it is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            configured = tempfile.mkdtemp(prefix="cartograin-checkpoint-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def by_rows(df: DataFrame, rows: int, per_partition: int = 50_000, least: int = 1) -> DataFrame:
    """Few enough partitions that each holds about ``per_partition`` rows: an
    iterative fit runs many jobs, and each costs a task per partition. Where a
    row is much work, ``least`` partitions are kept as long as each has a fifth of that."""
    wanted = max(-(-rows // per_partition), min(least, -(-rows * 5 // per_partition)))
    return df.coalesce(max(1, wanted))
