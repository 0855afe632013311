"""Constraints as queries: counts, keys, references, domains, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .joins import assemble_row, union_all
from .ranking import column_quantiles


class DataQualityError(ValueError):
    """A constraint that must hold does not."""


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_all(*counted).orderBy("table_name")


def distinct_counts(columns: Mapping[str, tuple[DataFrame, str]], approximate: bool = False) -> DataFrame:
    """One row; each entry names an output column and the key it counts."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    return _one_row({name: (df, count(F.col(key))) for name, (df, key) in columns.items()})


def _one_row(measures: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """All measures in one row, in the given order; those of one frame share one aggregate."""
    frames: dict[int, tuple[DataFrame, list[Column]]] = {}
    for name, (df, measure) in measures.items():
        frames.setdefault(id(df), (df, []))[1].append(measure.alias(name))
    return assemble_row(*[df.agg(*wanted) for df, wanted in frames.values()]).select(*measures)


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def duplicate_key_summary(checks: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per check: how many keys repeat, and how many rows they cover."""
    parts = []
    for name, (df, keys) in checks.items():
        parts.append(
            duplicate_keys(df, keys)
            .agg(
                F.count(F.lit(1)).alias("duplicate_keys"),
                F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("rows_involved"),
            )
            .select(F.lit(name).alias("check_name"), "duplicate_keys", "rows_involved")
        )
    return union_all(*parts)


def null_counts(columns: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return _one_row({name: (df, F.count_if(F.col(key).isNull())) for name, (df, key) in columns.items()})


def orphan_counts(checks: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """One row; each entry counts child rows without a parent. Children are
    counted per key before the join, so a hot key travels as one row."""
    parts = []
    for name, (child, parent, key) in checks.items():
        per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        lost = per_key.join(parent.select(key), key, "left_anti")
        parts.append(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name)))
    return assemble_row(*parts)


def range_check(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    value = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~value.between(low, high)).alias("out_of_range"),
        F.count_if(value.isNull()).alias("missing"),
    )


def conditional_counts(counts: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row; each entry counts the rows of a frame that meet a condition."""
    return _one_row({name: (df, F.count_if(condition)) for name, (df, condition) in counts.items()})


def quality_profile(datasets: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows, columns, repeated rows and keys, missing cells, text cardinality."""
    parts = []
    for name, (df, keys) in datasets.items():
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        empty = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
        # Copies are counted on the map side, so a row held by a third of the
        # table is one group; the groups then fold by key, then to one row.
        rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        by_key = rows.withColumn("_empty", empty * F.col("_n")).groupBy(*keys)
        by_key = by_key.agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_kinds"), F.sum("_empty").alias("_empty"))
        sizes = by_key.agg(
            F.sum("_n").alias("rows"),
            (F.sum("_n") - F.sum("_kinds")).alias("duplicate_rows"),
            (F.sum("_n") - F.count(F.lit(1))).alias("duplicate_business_keys"),
            F.sum("_empty").alias("missing_cells"),
        )
        distinct = sum((F.countDistinct(F.col(c)) for c in text), F.lit(0)) if text else F.lit(0)
        variety = df.agg(distinct.alias("categorical_cardinality"))
        parts.append(
            assemble_row(sizes, variety).select(
                F.lit(name).alias("dataset"),
                F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                F.lit(len(df.columns)).cast("bigint").alias("columns"),
                F.coalesce("duplicate_rows", F.lit(0)).cast("bigint").alias("duplicate_rows"),
                F.coalesce("duplicate_business_keys", F.lit(0)).cast("bigint").alias("duplicate_business_keys"),
                F.coalesce("missing_cells", F.lit(0)).cast("bigint").alias("missing_cells"),
                F.col("categorical_cardinality").cast("bigint").alias("categorical_cardinality"),
            )
        )
    return union_all(*parts)


def describe_stats(df: DataFrame, columns: Sequence[str], percentiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per numeric column: count, mean, std, min, percentiles, max, and skewness
    with the small-sample correction."""
    names = {f"p{q * 100:g}".replace(".", "_"): q for q in percentiles}
    measures = []
    for name in columns:
        value = F.col(name).cast("double")
        n = F.count(value).cast("double")
        measures.append(
            F.struct(
                F.count(value).alias("count"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
                (F.skewness(value) * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)).alias("skewness"),
            ).alias(f"_of_{name}")
        )
    both = assemble_row(df.agg(*measures), column_quantiles(df, columns, names))
    lines = [
        F.struct(f"_of_{name}.*", *[F.col(f"{name}_{p}").alias(p) for p in names], F.lit(name).alias("column")) for name in columns
    ]
    return both.select(F.inline(F.array(*lines)))


def _first_match(df: DataFrame, condition: Column) -> bool:
    return bool(df.filter(condition).limit(1).count())


def assert_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if duplicate_keys(df, keys).limit(1).count():
        raise DataQualityError(f"more than one row per {', '.join(keys)}")
    return df


def assert_domain(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Every rule must be true on every row; NULL counts as a failure. One pass for all rules."""
    if rules:
        broken = df.agg(*[_broken(rule).alias(f"_r{i}") for i, rule in enumerate(rules.values())]).first()
        _refuse(rules, broken)
    return df


def assert_rows(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """``assert_grain`` and ``assert_domain`` in one job: broken rules are counted
    per key on the map side, and the keys fold to one row."""
    names = [f"_r{i}" for i in range(len(rules))]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[_broken(rule).alias(name) for name, rule in zip(names, rules.values())])
    found = per_key.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names], F.count_if(F.col("_n") > 1).alias("_repeated")).first()
    if found["_repeated"]:
        raise DataQualityError(f"more than one row per {', '.join(keys)}")
    _refuse(rules, found)
    return df


def _broken(rule: Column) -> Column:
    return F.count_if(~F.coalesce(rule, F.lit(False)))


def _refuse(rules: Mapping[str, Column], broken: Sequence[int]) -> None:
    """``broken`` has the number of rows against each rule, in order."""
    failed = [f"{name} ({rows} rows)" for name, rows in zip(rules, broken) if rows]
    if failed:
        raise DataQualityError(f"rule broken: {', '.join(failed)}")


def assert_continuous_days(df: DataFrame, date: str, series: Sequence[str] = ()) -> DataFrame:
    """Each series has each calendar day between its ends exactly once."""
    spans = df.groupBy(*series).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.countDistinct(date).alias("_days"),
        (F.datediff(F.max(date), F.min(date)) + 1).alias("_span"),
    )
    if _first_match(spans, (F.col("_rows") != F.col("_days")) | (F.col("_days") != F.col("_span"))):
        raise DataQualityError(f"{date} has gaps or repeats")
    return df


def reconcile(actual: DataFrame, expected: DataFrame, column: str, tolerance: float = 0.01) -> float:
    """Compare the totals of a measure reached along two paths; returns the gap."""
    left = actual.agg(F.coalesce(F.sum(column), F.lit(0)).cast("double").alias("_a"))
    right = expected.agg(F.coalesce(F.sum(column), F.lit(0)).cast("double").alias("_b"))
    row = assemble_row(left, right).first()
    gap = abs(row["_a"] - row["_b"])
    if gap > tolerance:
        raise DataQualityError(f"{column}: {row['_a']} against {row['_b']}, more than {tolerance} apart")
    return gap


def refuse_features(df: DataFrame, features: Sequence[str], source: Mapping[str, str], prohibited: Sequence[str]) -> None:
    """Raises on features that leak, have no stated source or are absent."""
    chosen = set(features)
    problems = {
        "leakage": sorted(chosen & set(prohibited)),
        "undocumented": sorted(chosen - set(source)),
        "missing": sorted(chosen - set(df.columns)),
    }
    if any(problems.values()):
        raise DataQualityError(f"feature audit failed: {problems}")


def audit_features(df: DataFrame, features: Sequence[str], source: Mapping[str, str], prohibited: Sequence[str]) -> DataFrame:
    """Per feature: source table, rows, nulls, distinct values, and whether it is
    known at prediction time; one aggregate over the rows. Refused features
    raise before any row is read."""
    refuse_features(df, features, source, prohibited)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(f).alias(f"_held_{f}") for f in features],
        *[F.count_distinct(f).alias(f"_distinct_{f}") for f in features],
    )
    lines = [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(source[f]).alias("source"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_held_{f}")).alias("nulls"),
            F.col(f"_distinct_{f}").alias("distinct_values"),
            F.lit(f not in prohibited).alias("available_at_prediction_time"),
        )
        for f in features
    ]
    return counts.select(F.inline(F.array(*lines)))


def rejected_reasons(rules: Mapping[str, Column]) -> Column:
    """Array of the names of the rules a row breaks (NULL breaks a rule)."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    )


def split_valid(df: DataFrame, rules: Mapping[str, Column], allowed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with a ``reasons`` array. Unknown or absent
    columns fail the batch as a whole."""
    extra, missing = set(df.columns) - set(allowed), set(allowed) - set(df.columns)
    if extra or missing:
        raise DataQualityError(f"unexpected columns {sorted(extra)}, missing columns {sorted(missing)}")
    checked = df.withColumn("reasons", rejected_reasons(rules))
    valid = checked.filter(F.size("reasons") == 0).drop("reasons")
    return valid, checked.filter(F.size("reasons") > 0)
