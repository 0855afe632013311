"""Global order without a single-task sort.

An un-partitioned window moves every row into one task. Here the rows are range
partitioned and sorted, each row records its partition and position, and the
partition totals (one row per partition) give every partition its starting
offset. The sorted rows are checkpointed once, because two evaluations of a
range partitioning may draw different boundaries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpointed
from .joins import lookup_join, with_scalar

_POSITION_BITS = 33
# A table of group sizes is broadcast up to this many (counted) rows.
BROADCAST_GROUPS = 10_000


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _sorted_blocks(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    order = [_column(c) for c in order]
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_block", F.shiftright("_place", _POSITION_BITS).cast("int"))
    )
    return checkpointed(placed)


def distributed_rank(df: DataFrame, order: Sequence[Column | str], rank: str = "rank") -> DataFrame:
    """``row_number()`` over the whole frame. ``order`` must end in a unique key."""
    blocks = _sorted_blocks(df, order)
    # One row per partition: small by construction.
    sizes = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        blocks.join(F.broadcast(offsets), "_block")
        .withColumn(rank, F.col("_offset") + position + 1)
        .drop("_block", "_place", "_offset")
    )


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Mapping[str, Column | str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running sums in ``order``, restarting for each ``within`` group.

    A group may span many partitions. Only the first group of a partition can
    continue from the one before, so the offsets are at most one row per
    partition.
    """
    prepared = df.withColumns({f"_v_{name}": _column(value) for name, value in sums.items()})
    blocks = _sorted_blocks(prepared, [*within, *order])
    names = list(sums)
    sizes = blocks.groupBy("_block", *within).agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in names])
    before = W.partitionBy(*within) if within else W.partitionBy()
    before = before.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_block", *within, *[F.sum(f"_s_{n}").over(before).alias(f"_o_{n}") for n in names])
    starts = starts.dropna(how="all", subset=[f"_o_{n}" for n in names])
    local = W.partitionBy("_block", *within).orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    summed = blocks.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(local) for n in names})
    # NULL group keys compare equal here, so the join is null-safe.
    starts = starts.select(F.col("_block").alias("_b"), *[F.col(c).alias(f"_g_{c}") for c in within], *[f"_o_{n}" for n in names])
    match = F.col("_block") == F.col("_b")
    for c in within:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    joined = summed.join(F.broadcast(starts), match, "left")
    totals = {n: F.col(f"_r_{n}") + F.coalesce(F.col(f"_o_{n}"), F.lit(0)) for n in names}
    return joined.withColumns(totals).select(*df.columns, *names)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    approximate: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles, one row per ``by`` group (NULL values
    and NULL groups are left out).

    Values are first counted, then the counts are accumulated in order across
    partitions, so no task holds a whole group. ``approximate`` switches to the
    mergeable sketch for dashboards that can live with an error bound.
    """
    present = df.select(*by, value).dropna()
    if approximate:
        return present.groupBy(*by).agg(
            *[F.percentile_approx(value, q, 10_000).cast("double").alias(name) for name, q in quantiles.items()]
        )
    counts = present.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    running = running_totals(counts, [value], {"_upto": "_n"}, within=by)
    sizes = running.groupBy(*by).agg(F.max("_upto").alias("_size"))
    if by and sizes.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        placed = running.join(F.broadcast(sizes), list(by))
    elif by:
        placed = lookup_join(running, sizes, list(by))
    else:
        placed = with_scalar(running, sizes)
    number = F.col(value).cast("double")
    picks = []
    for index, q in enumerate(quantiles.values()):
        at = F.lit(float(q)) * (F.col("_size") - 1).cast("double")
        for side, position in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("_upto") - F.col("_n") <= position) & (position < F.col("_upto"))
            picks.append(F.max(F.when(holds, number)).alias(f"_{side}{index}"))
    found = placed.groupBy(*by).agg(F.max("_size").alias("_size"), *picks)
    result = []
    for index, (name, q) in enumerate(quantiles.items()):
        at = F.lit(float(q)) * (F.col("_size") - 1).cast("double")
        low, high = F.col(f"_lo{index}"), F.col(f"_hi{index}")
        result.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return found.select(*by, *result)


def column_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float], approximate: bool = False
) -> DataFrame:
    """Quantiles of several columns in one row, ``<column>_<name>`` each; the
    columns are stacked, so they share one pass and one sort."""
    if len(columns) == 1:
        single = exact_quantiles(df, columns[0], quantiles, approximate=approximate)
        return single.select(*[F.col(q).alias(f"{columns[0]}_{q}") for q in quantiles])
    stacked = F.array(*[F.struct(F.lit(i).alias("c"), F.col(name).cast("double").alias("v")) for i, name in enumerate(columns)])
    long = df.select(F.explode(stacked).alias("_e")).select(F.col("_e.c").alias("_column"), F.col("_e.v").alias("_value"))
    found = exact_quantiles(long, "_value", quantiles, by=["_column"], approximate=approximate)
    return found.agg(
        *[
            F.max(F.when(F.col("_column") == i, F.col(q))).alias(f"{name}_{q}")
            for i, name in enumerate(columns)
            for q in quantiles
        ]
    )


def quantile_bin(
    df: DataFrame,
    value: str,
    bins: int,
    tie: str,
    name: str,
    reverse: bool = False,
) -> DataFrame:
    """Equal-count bins 1..``bins`` by first-come rank (ties broken by ``tie``).

    The rank ``r`` of ``n`` rows falls in bin ``ceil((r - 1) * bins / (n - 1))``,
    at least 1, which is where linear-interpolation edges of the ranks put it.
    """
    gaps = F.greatest(F.col("_size") - 1, F.lit(0))
    lasts = [F.floor(gaps * b / bins) + 1 for b in range(1, bins)]
    number = _parts_by_rank(df, value, tie, lasts)
    return number.withColumn(name, (F.lit(bins + 1) - F.col("_part") if reverse else F.col("_part")).cast("int")).drop("_part")


def _parts_by_rank(df: DataFrame, value: str, tie: str, lasts: Sequence[Column]) -> DataFrame:
    """``df`` with ``_part``: 1 plus the number of the given ranks (functions of ``_size``) that lie before the row.

    Only (value, tie) is sorted. The rows at the given ranks come back as one row, and
    every row of ``df`` is compared with them where it is.
    """
    place = F.struct(F.col(value).isNull().alias("n"), F.col(value).alias("v"), F.col(tie).alias("t"))
    ranked = distributed_rank(df.select(value, tie), [F.col(value).asc_nulls_last(), F.col(tie)], "_rank")
    sized = with_scalar(ranked, ranked.agg(F.count(F.lit(1)).alias("_size")))
    edges = sized.agg(*[F.max(F.when(F.col("_rank") == last, place)).alias(f"_edge{i}") for i, last in enumerate(lasts)])
    beyond = [F.coalesce(place > F.col(f"_edge{i}"), F.lit(True)).cast("int") for i in range(len(lasts))]
    placed = with_scalar(df, edges).withColumn("_part", sum(beyond, F.lit(1)))
    return placed.drop(*[f"_edge{i}" for i in range(len(lasts))])


def temporal_split(
    df: DataFrame,
    ts: str,
    key: str,
    cuts: tuple[float, float] = (0.70, 0.85),
    name: str = "split",
) -> DataFrame:
    """Label rows train / validation / test by their place in time order."""
    parts = _parts_by_rank(df, ts, key, [F.floor(F.col("_size") * F.lit(cut)) for cut in cuts])
    label = F.element_at(F.array(F.lit("train"), F.lit("validation"), F.lit("test")), F.col("_part"))
    return parts.withColumn(name, label).drop("_part")


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows; ``order`` must end in a unique key so ties are decided."""
    return df.orderBy(*[_column(c) for c in order]).limit(k)


def head_tail(df: DataFrame, ascending: Sequence[Column], descending: Sequence[Column], k: int) -> DataFrame:
    """The ``k`` first and ``k`` last rows, without repeats."""
    return df.orderBy(*ascending).limit(k).union(df.orderBy(*descending).limit(k)).dropDuplicates()


def sample_exact(df: DataFrame, key: str | Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen by a seeded digest of the key (the
    same rows on every run and in any engine)."""
    keys = [key] if isinstance(key, str) else list(key)
    digest = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.orderBy(digest, *keys).limit(n)


def share_of_total(df: DataFrame, value: Column | str, name: str, bounded: bool = False) -> DataFrame:
    """``100 * value / sum(value)``. ``bounded`` frames (a fixed label domain)
    use a window; others attach the total as a one-row broadcast."""
    value = _column(value)
    if bounded:
        total = F.sum(value).over(W.partitionBy())
        return df.withColumn(name, F.lit(100.0) * value.cast("double") / total.cast("double"))
    joined = with_scalar(df, df.agg(F.sum(value).alias("_total")))
    return joined.withColumn(name, F.lit(100.0) * value.cast("double") / F.col("_total").cast("double")).drop("_total")
