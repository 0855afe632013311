"""Joins that keep one row per left row, and helpers that fix the grain first.

Two rules hold throughout. A 1:N table is aggregated to the join key before it
is joined, so no measure is counted twice. And every join is many-to-one
against a side that is unique on the key, so its output never outgrows the left
side; where the left side may carry a hot key, that key's rows are spread over
several tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Frequent-item sketch: keys above one part in a few hundred are always found.
HOT_KEYS_TRACKED = 256
HOT_SKETCH_ITEMS = 8192


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """At most ``HOT_KEYS_TRACKED`` rows ``(_token, _pieces)`` for heavy keys.

    A key is heavy when its rows would fill more than two average shuffle
    partitions; ``_pieces`` is how many average partitions they would fill. One
    pass over the key columns with a bounded sketch per task finds them, and a
    miss only costs balance, never rows.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = f"approx_top_k(_token, {HOT_KEYS_TRACKED}, {HOT_SKETCH_ITEMS})"
    tops = df.select(F.xxhash64(*keys).alias("_token")).agg(
        F.expr(sketch).alias("_tops"), F.count(F.lit(1)).alias("_total")
    )
    share = F.col("_top.count") / F.col("_total")
    return (
        tops.select(F.explode("_tops").alias("_top"), "_total")
        .filter(share * partitions > 2)
        .select(
            F.col("_top.item").alias("_token"),
            F.ceil(share * partitions).cast("int").alias("_pieces"),
        )
    )


_LOOKUPS = ("inner", "left", "left_semi", "left_anti")


def lookup_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Many-to-one equi join; ``right`` must be unique on ``on`` (for semi and
    anti joins it need not be).

    How to join is left to adaptive execution, which knows the sizes of both
    shuffled sides: a small right side is broadcast, and a partition that a heavy
    key fills is split, since the left side decides every row by itself.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in _LOOKUPS:
        raise ValueError(f"unsupported join type: {how}")
    return left.join(right, keys, how)


def spread_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], heavy_from: DataFrame, how: str = "inner") -> DataFrame:
    """``lookup_join`` for a hot key that adaptive execution can't split, as when
    the joined rows are aggregated without another shuffle.

    ``heavy_from`` names the stored table whose key column tells which keys are
    heavy. The rows of heavy keys are dealt out over as many buckets as they would
    fill partitions, and the single matching right row is repeated once per
    bucket. The repeats are bounded by the number of shuffle partitions.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in _LOOKUPS:
        raise ValueError(f"unsupported join type: {how}")
    heavy = F.broadcast(hot_keys(heavy_from, keys))
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    # The map task's number is stable across retries and spreads exact copies too.
    dealt = (
        left.withColumn("_token", F.xxhash64(*keys))
        .join(heavy, "_token", "left")
        .withColumn("_bucket", F.pmod(F.hash(*left.columns, F.spark_partition_id()), pieces))
        .drop("_token", "_pieces")
    )
    repeated = (
        right.withColumn("_token", F.xxhash64(*keys))
        .join(heavy, "_token", "left")
        .withColumn("_bucket", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_token", "_pieces")
    )
    return dealt.join(repeated, [*keys, "_bucket"], how).drop("_bucket")


def join_at_grain(
    left: DataFrame,
    detail: DataFrame,
    keys: str | Sequence[str],
    aggregates: Mapping[str, Column],
    how: str = "inner",
    fill: object | None = None,
) -> DataFrame:
    """Aggregate ``detail`` to ``keys``, then join it to ``left``.

    ``how='inner'`` drops left rows without detail; ``how='left'`` keeps them,
    with the aggregates set to ``fill`` when one is given.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    grouped = detail.groupBy(*keys).agg(*[column.alias(name) for name, column in aggregates.items()])
    joined = lookup_join(left, grouped, keys, how)
    if how == "left" and fill is not None:
        joined = joined.withColumns(
            {name: F.coalesce(F.col(name), F.lit(fill).cast(joined.schema[name].dataType)) for name in aggregates}
        )
    return joined


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a global aggregate) to every row."""
    return df.crossJoin(F.broadcast(one_row))


def assemble_row(*one_row_frames: DataFrame) -> DataFrame:
    """Place several one-row frames side by side."""
    first, *rest = one_row_frames
    for frame in rest:
        first = with_scalar(first, frame)
    return first


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent row; a NULL key is an orphan."""
    known = parent.select(F.col(parent_key or key).alias(key))
    return lookup_join(child, known, key, "left_anti")


def star_join(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    translation: DataFrame,
) -> DataFrame:
    """Items with their order, product and (optional) translated category."""
    catalogue = lookup_join(products, translation, "product_category_name", "left")
    by_order = lookup_join(items, orders, "order_id")
    return lookup_join(by_order, catalogue, "product_id")


def shift_self_join(
    df: DataFrame,
    month: str,
    shifts: Mapping[str, int],
    columns: Sequence[str],
) -> DataFrame:
    """Attach ``columns`` of the row some months earlier, one set per suffix in
    ``shifts``; NULL when that month is absent (unlike ``lag``, which would
    silently take the row before a gap). ``month`` must be unique.

    Every row is sent to its own month and to the months that look back at it,
    and one aggregation brings them together: ``df`` is evaluated once, where a
    self-join would evaluate it once per side.
    """
    targets = [F.struct(F.lit("").alias("s"), F.col(month).alias("m"))]
    targets += [F.struct(F.lit(s).alias("s"), F.add_months(F.col(month), n).alias("m")) for s, n in shifts.items()]
    sent = df.select(F.explode(F.array(*targets)).alias("_to"), *[c for c in df.columns if c != month])

    def of(suffix: str, name: str) -> Column:
        return F.max(F.when(F.col("_to.s") == suffix, F.col(name))).alias(f"{name}{suffix}")

    kept = [of("", name) for name in df.columns if name != month]
    earlier = [of(suffix, name) for suffix in shifts for name in columns]
    present = F.max(F.col("_to.s") == "").alias("_here")
    met = sent.groupBy(F.col("_to.m").alias(month)).agg(present, *kept, *earlier)
    return met.filter("_here").drop("_here")


def dominant_value(
    df: DataFrame,
    key: str,
    value: str,
    weight: Column | None = None,
) -> DataFrame:
    """Per ``key`` the value with the largest weight (default: row count), ties
    to the alphabetically first, NULL last. One aggregate after another, so a
    hot key is reduced on the map side and never sorted in one task."""
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = df.groupBy(key, value).agg(total.alias("_size"))
    best = F.min(F.struct((-F.col("_size")).alias("s"), F.col(value).isNull().alias("m"), F.col(value).alias("v")))
    return sizes.groupBy(key).agg(best["v"].alias(value))


def join_dominant(
    left: DataFrame,
    detail: DataFrame,
    key: str,
    value: str,
    alias: str | None = None,
    weight: Column | None = None,
) -> DataFrame:
    winner = dominant_value(detail, key, value, weight)
    if alias:
        winner = winner.withColumnRenamed(value, alias)
    return lookup_join(left, winner, key, "left")


def latest(ts: str, tie: str, *columns: str) -> Column:
    """Aggregate: struct of ``columns`` from the row with the greatest ``ts``,
    ties to the smallest ``tie``. Merges like max(), so it needs no sort."""
    newest_first = F.struct(
        (-F.unix_micros(F.col(ts).cast("timestamp"))).alias("t"),
        F.col(tie).alias("i"),
        *[F.col(name) for name in columns],
    )
    return F.min(newest_first)


def latest_row(df: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """One row per ``key``: the columns of its latest row."""
    picked = df.groupBy(key).agg(latest(ts, tie, *columns).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{name}").alias(name) for name in columns])


def date_spine(
    df: DataFrame,
    date: str,
    values: Sequence[str],
    series: Sequence[str] = (),
    fill: object = 0,
) -> DataFrame:
    """One row per calendar day between each series' first and last date, with
    ``fill`` on the days that were not observed."""
    bounds = df.groupBy(*series).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    days = F.explode(F.sequence(F.col("_first"), F.col("_last"), F.expr("interval 1 day")))
    spine = bounds.filter(F.col("_first").isNotNull()).select(*series, days.alias(date))
    joined = spine.join(df.select(*series, date, *values), [*series, date], "left")
    filled = {name: F.coalesce(F.col(name), F.lit(fill).cast(df.schema[name].dataType)) for name in values}
    return joined.withColumns(filled)


def union_all(*frames: DataFrame, distinct: bool = False) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first.dropDuplicates() if distinct else first


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Report form: decimal columns as double."""
    return df.select(
        *[
            F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )
