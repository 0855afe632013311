"""Distributions and associations computed from counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpointed
from .joins import lookup_join, with_scalar
from .ranking import column_quantiles, exact_quantiles, running_totals


def percentile_cap(df: DataFrame, columns: Sequence[str], q: float = 0.99, approximate: bool = False) -> DataFrame:
    """Rows at or below the ``q`` quantile of every listed column (each quantile
    over the whole frame); a NULL never passes."""
    limits = column_quantiles(df, columns, {"cap": q}, approximate)
    renamed = limits.select(*[F.col(f"{name}_cap").alias(f"_cap{i}") for i, name in enumerate(columns)])
    capped = with_scalar(df, renamed)
    for i, name in enumerate(columns):
        capped = capped.filter(F.col(name).cast("double") <= F.col(f"_cap{i}"))
    return capped.drop(*renamed.columns)


def histogram(df: DataFrame, column: str, bins: int, cap: float | None = None) -> DataFrame:
    """Equal-width counts over [min, max]; the maximum falls in the last bin and
    empty bins are reported with 0."""
    # One narrow column, read once per step below, so written once.
    source = checkpointed(df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull()))
    if cap is not None:
        source = percentile_cap(source, ["v"], cap)
    value = F.col("v").cast("double")
    span = source.agg(F.min(value).alias("_min"), F.max(value).alias("_max"))
    width = F.col("_max") - F.col("_min")
    position = F.when(width > 0, F.floor((value - F.col("_min")) * bins / F.when(width > 0, width))).otherwise(0)
    binned = (
        with_scalar(source, span)
        .groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    grid = span.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_min", "_max")
    step = (F.col("_max") - F.col("_min")) / bins
    return (
        grid.join(binned, "bin", "left")
        .select(
            "bin",
            (F.col("_min") + step * F.col("bin")).alias("lower"),
            (F.col("_min") + step * (F.col("bin") + 1)).alias("upper"),
            F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"),
        )
        .orderBy("bin")
    )


def value_counts(df: DataFrame, column: Column | str, name: str, count: str = "n") -> DataFrame:
    value = F.col(column) if isinstance(column, str) else column
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias(count))


def hexbin(df: DataFrame, x: str, y: str, gridsize: int = 45, cap: float | None = 0.99) -> DataFrame:
    """Counts on a hexagonal lattice: two rectangular lattices, one shifted by
    half a cell, each point going to the nearer centre. Non-empty cells only."""
    # Two narrow columns, read once per step below, so written once.
    points = checkpointed(df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna())
    if cap is not None:
        points = percentile_cap(points, ["x", "y"], cap)
    across, down = gridsize, int(gridsize / math.sqrt(3))
    box = points.agg(
        F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1")
    )
    sx, sy = (F.col("_x1") - F.col("_x0")) / across, (F.col("_y1") - F.col("_y0")) / down
    sized = with_scalar(points, box.withColumns({"_sx": sx, "_sy": sy}))
    scaled = sized.withColumns(
        {
            "_u": F.when(F.col("_sx") > 0, (F.col("x") - F.col("_x0")) / F.when(F.col("_sx") > 0, F.col("_sx"))).otherwise(0.0),
            "_v": F.when(F.col("_sy") > 0, (F.col("y") - F.col("_y0")) / F.when(F.col("_sy") > 0, F.col("_sy"))).otherwise(0.0),
        }
    )
    corner = F.pow(F.col("_u") - F.rint("_u"), 2) + 3 * F.pow(F.col("_v") - F.rint("_v"), 2)
    middle = F.pow(F.col("_u") - F.floor("_u") - 0.5, 2) + 3 * F.pow(F.col("_v") - F.floor("_v") - 0.5, 2)
    cells = scaled.select(
        F.when(corner < middle, F.rint("_u")).otherwise(F.floor("_u") + 0.5).alias("_i"),
        F.when(corner < middle, F.rint("_v")).otherwise(F.floor("_v") + 0.5).alias("_j"),
    )
    counted = cells.groupBy("_i", "_j").agg(F.count(F.lit(1)).alias("n"))
    return with_scalar(counted, box.withColumns({"_sx": sx, "_sy": sy})).select(
        (F.col("_x0") + F.col("_i") * F.col("_sx")).alias("cx"),
        (F.col("_y0") + F.col("_j") * F.col("_sy")).alias("cy"),
        "n",
    )


def pearson(df: DataFrame, x: str, y: str, name: str = "pearson") -> DataFrame:
    """Over the rows where both columns are present."""
    return df.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(name))


def average_ranks(pairs: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """For each column of the counted ``pairs`` (count ``n``): one row per
    distinct value with the mean rank ``<column>_rank`` of its rows. All columns
    share one sort."""
    stacked = F.array(*[F.struct(F.lit(i).alias("c"), F.col(name).alias("v")) for i, name in enumerate(columns)])
    long = pairs.select(F.explode(stacked).alias("_e"), "n").select("_e.c", "_e.v", "n")
    counts = long.groupBy("c", "v").agg(F.sum("n").alias("_n"))
    upto = running_totals(counts, ["v"], {"_upto": "_n"}, within=["c"])
    mean_rank = F.col("_upto") - (F.col("_n") - 1) / F.lit(2.0)
    return {
        name: upto.filter(F.col("c") == i).select(F.col("v").alias(name), mean_rank.alias(f"{name}_rank"))
        for i, name in enumerate(columns)
    }


def spearman(df: DataFrame, x: str, y: str, name: str = "spearman") -> DataFrame:
    """Rank correlation, ties at their average rank, pairs with a NULL left out.

    The rows become counted (x, y) pairs first. The ranks are unique per value,
    and a value with a large share of the pairs is spread over several tasks.
    """
    present = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).dropna()
    # Read several times below, so written once.
    pairs = checkpointed(present.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("n")))
    ranks = average_ranks(pairs, ["_x", "_y"])
    ranked = lookup_join(pairs, ranks["_x"], "_x")
    ranked = lookup_join(ranked, ranks["_y"], "_y")
    # Ranks average (N + 1) / 2 in each column; centred sums keep precision.
    size = pairs.agg(((F.sum("n") + 1) / F.lit(2.0)).alias("_mid"))
    dx, dy = F.col("_x_rank") - F.col("_mid"), F.col("_y_rank") - F.col("_mid")
    sums = with_scalar(ranked, size).agg(
        F.sum(F.col("n") * dx * dy).alias("xy"), F.sum(F.col("n") * dx * dx).alias("xx"), F.sum(F.col("n") * dy * dy).alias("yy")
    )
    scale = F.sqrt("xx") * F.sqrt("yy")
    return sums.select((F.col("xy") / F.when(scale > 0, scale)).alias(name))


def quantile_edges(df: DataFrame, column: str, bands: int) -> DataFrame:
    """One row: array ``edges`` of the distinct quantile edges, ascending."""
    names = {f"_e{i}": i / bands for i in range(bands + 1)}
    found = exact_quantiles(df, column, names)
    return found.select(F.array_distinct(F.array(*names)).alias("edges"))


def quantile_band(df: DataFrame, column: str, bands: int, name: str) -> DataFrame:
    """Right-closed quantile bands 1..m (m <= ``bands`` after merging equal
    edges), the lowest value included; NULL stays NULL. Adds ``name``,
    ``name_lower`` and ``name_upper``."""
    edges = quantile_edges(df, column, bands)
    value = F.col(column).cast("double")
    inner = F.filter(F.slice("_edges", 2, bands), lambda e: e < value)
    placed = with_scalar(df, edges.withColumnRenamed("edges", "_edges"))
    last = F.greatest(F.size("_edges") - 1, F.lit(1))
    band = F.when(value.isNotNull(), F.least(F.size(inner) + 1, last))
    return placed.withColumn(name, band).withColumns(
        {
            f"{name}_lower": F.get("_edges", F.col(name) - 1),
            f"{name}_upper": F.coalesce(F.get("_edges", F.col(name)), F.get("_edges", F.col(name) - 1)),
        }
    ).drop("_edges")


def crosstab_share(df: DataFrame, rows: str, columns: str, values: Sequence[object]) -> DataFrame:
    """Row-normalised contingency table; ``values`` lists the column labels."""
    counts = df.groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1)))
    counts = counts.select(F.col(rows), *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(str(v)) for v in values])
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0)).cast("double")
    shares = [(F.col(f"`{v}`") / F.when(total > 0, total)).alias(str(v)) for v in values]
    return counts.select(rows, *shares)


def minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns scaled to [0, 1] over the frame; a constant column becomes 0."""
    span = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"_lo_{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"_hi_{c}") for c in columns],
    )
    scaled = {}
    for c in columns:
        width = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        scaled[c] = (F.col(c).cast("double") - F.col(f"_lo_{c}")) / F.when(width != 0, width).otherwise(1.0)
    return with_scalar(df, span).withColumns(scaled).select(*df.columns)


def top_values_joined(df: DataFrame, key: str, value: str, k: int, name: str, separator: str = ", ") -> DataFrame:
    """The ``k`` most frequent values per key as one string, ties alphabetical.
    The rank filter is applied before the shuffle too, so a task only ever sees
    ``k`` rows of a key from each upstream task."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n")).filter(F.col(value).isNotNull())
    place = F.row_number().over(W.partitionBy(key).orderBy(F.desc("_n"), value))
    best = counts.withColumn("_place", place).filter(F.col("_place") <= k)
    listed = F.array_sort(F.collect_list(F.struct(F.col("_place").alias("p"), F.col(value).alias("v"))))
    return best.groupBy(key).agg(F.array_join(F.transform(listed, lambda e: e["v"]), separator).alias(name))
