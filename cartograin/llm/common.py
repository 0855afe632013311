"""What the corpus operators share: reading, staging, row identity, running totals by group."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_folder

#: The separators of the word rule ``[^\x20\x09-\x0D]+``.
WORD = "[^\\x20\\x09-\\x0D]+"

#: Rows that one window partition sorts when a group is dealt over buckets.
BUCKET_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the cluster's shared folder and read from there.

    It cuts lineage, survives lost executors, and fixes values such as row numbers.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpus/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def boxed(documents: DataFrame, **own: Column) -> DataFrame:
    """Each row whole as column ``document``, and columns of the operator beside it, so that no names clash."""
    document = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("document")
    return documents.select(document, *[value.alias(name) for name, value in own.items()])


def row_key(*columns: str) -> Column:
    """96 bits of identity from the given columns; nulls differ from empty values.

    Rows that agree in all of them share a key, so a table of verdicts has to be
    distinct by key before it is joined.
    """
    parts = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    return F.struct(F.xxhash64(*parts).alias("a"), F.hash(*parts).alias("b"))


def unit_hash(*columns: Column) -> Column:
    """A repeatable number in [0, 1) from a 64-bit hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))


def ranges_for(rows: Column) -> Column:
    """Number of ranges a group of so many rows is cut into by ``running_before``."""
    return F.ceil(rows / F.lit(BUCKET_ROWS))


def running_before(df: DataFrame, group: list[str], order: list[Column], amount: str, total: str, ranges: str | None = None) -> DataFrame:
    """Sum of ``amount`` over the rows of the group that come earlier, as column ``total``.

    ``order`` begins with a uniform number in [0, 1) (``unit_hash``). A group is cut
    into equal ranges of that number, about ``BUCKET_ROWS`` rows each; offsets of the
    ranges come from their sums, so a group of any size is spread over many tasks.
    ``ranges`` names a column that already has the number of ranges (``ranges_for``).
    """
    if ranges is None:
        counts = df.groupBy(*group).agg(ranges_for(F.count(F.lit(1))).alias("_ranges"))
        df, ranges = null_safe_join(df, counts, group), "_ranges"
    dealt = df.withColumn("_range", F.floor(order[0] * F.col(ranges)))
    sums = dealt.groupBy(*group, "_range").agg(F.sum(amount).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumn("_within", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    joined = null_safe_join(within, offsets, [*group, "_range"])
    return joined.withColumn(total, F.col("_within") + F.col("_offset")).drop("_ranges", "_range", "_within", "_offset")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the keys of the left side stay."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_right_{key}")
    condition = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_right_{key}" for key in keys]) if how not in ("left_semi", "left_anti") else joined
