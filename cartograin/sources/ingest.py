"""CSV files into typed tables, and tables into Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.expressions import nan_to_null
from .contract import TABLES, TableSpec

# Comments hold line breaks, commas and doubled quotes.
_CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}


class SourceError(ValueError):
    """Input files are absent or lack required columns."""


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file (or folder of them); reads the first line only."""
    return spark.read.options(header="true", quote='"', escape='"').csv(path).columns


def validate_sources(
    spark: SparkSession,
    folder: str,
    tables: Iterable[TableSpec] = TABLES,
    filenames: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Check that every file is there and has the columns its table needs; all
    findings are reported together. Returns the path of each table."""
    paths, problems = {}, []
    for spec in tables:
        path = f"{folder.rstrip('/')}/{(filenames or {}).get(spec.name, spec.filename)}"
        try:
            header = csv_header(spark, path)
        except AnalysisException:
            problems.append(f"{path} does not exist")
            continue
        lacking = [name for name in spec.headers if name not in header]
        if lacking:
            problems.append(f"{path} lacks {', '.join(lacking)}")
        paths[spec.name] = path
    if problems:
        raise SourceError("; ".join(problems))
    return paths


def coerce_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Text to timestamp without zone; text that is no timestamp becomes NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS timestamp_ntz)") for c in columns})


def nans_to_nulls(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def csv_scan(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Read one table's CSV by header name, rename, and cast to its schema.

    Every field is read as text first, so a malformed timestamp or number turns
    into NULL in its own column instead of spoiling the row.
    """
    header = csv_header(spark, path)
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw = spark.read.schema(text).options(**_CSV_OPTIONS).option("multiLine", spec.multiline).csv(path)
    renamed = raw.withColumnsRenamed({source: target for target, source in spec.header_names})
    timestamps = set(spec.timestamps)
    columns: list[Column] = []
    for field in spec.schema.fields:
        if field.name in timestamps or isinstance(field.dataType, T.StringType):
            columns.append(F.col(field.name))
        else:
            columns.append(_number(field))
    return coerce_timestamps(renamed.select(*columns), spec.timestamps)


def _number(field: T.StructField) -> Column:
    """Cast text to a number; integral columns may be written as '3.0'."""
    if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
        via = f"try_cast(try_cast(`{field.name}` AS decimal(20,2)) AS {field.dataType.simpleString()})"
    else:
        via = f"try_cast(`{field.name}` AS {field.dataType.simpleString()})"
    return F.expr(via).alias(field.name)


def reload_tables(
    spark: SparkSession,
    source_folder: str,
    target_folder: str,
    tables: Iterable[TableSpec] = TABLES,
    filenames: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Validate all sources, then replace every table at once; repeatable. Row
    counts are observed while writing, so nothing is read twice.

    The tables go to a folder of their own. One row of the manifest, written
    last, publishes them together: its file appears by a single rename, so a
    load that fails half-way leaves readers with the tables they had. Of two
    loads at the same time, the one of the greater version name is read.
    """
    tables = tuple(tables)
    paths = validate_sources(spark, source_folder, tables, filenames)
    version, written = uuid.uuid4().hex, {}
    for spec in tables:
        seen = Observation(f"load_{spec.name}")
        frame = csv_scan(spark, paths[spec.name], spec).observe(seen, F.count(F.lit(1)).alias("rows"))
        frame.write.parquet(table_path(target_folder, spec.name, version))
        written[spec.name] = seen.get["rows"]
    latest = _loads(spark, target_folder)[:1]
    entry = (latest[0].sequence + 1 if latest else 1, version, list(written.items()))
    spark.createDataFrame([entry], _MANIFEST).coalesce(1).write.mode("append").json(_manifest_path(target_folder))
    return written


# One small row per load.
_MANIFEST = "sequence bigint, version string, tables array<struct<name: string, rows: bigint>>"


def _manifest_path(folder: str) -> str:
    return f"{folder.rstrip('/')}/load_manifest"


def _loads(spark: SparkSession, folder: str) -> list[Row]:
    """Published loads, latest first."""
    try:
        manifest = spark.read.schema(_MANIFEST).json(_manifest_path(folder))
    except AnalysisException:
        return []
    return manifest.orderBy(F.desc("sequence"), F.desc("version")).collect()


def current_version(spark: SparkSession, folder: str) -> str | None:
    """Version that readers get; None for a folder without published loads."""
    loads = _loads(spark, folder)
    return loads[0].version if loads else None


def drop_old_versions(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Delete the tables of all but the ``keep`` latest published loads; returns
    how many loads had tables to delete. Queries planned on them fail from then
    on, and tables of loads that were never published are left alone."""
    if keep < 1:
        raise ValueError("the current version is never deleted")
    dropped = 0
    for load in _loads(spark, folder)[keep:]:
        path = spark._jvm.org.apache.hadoop.fs.Path(_version_path(folder, load.version))
        dropped += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return dropped


def _version_path(folder: str, version: str) -> str:
    return f"{folder.rstrip('/')}/versions/{version}"


def table_path(folder: str, name: str, version: str | None = None) -> str:
    """Without a version, the table lies in ``folder`` itself."""
    return f"{_version_path(folder, version) if version else folder.rstrip('/')}/{name}"


def table_scan(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the latest published load, or, where nothing was published, of
    a plain folder of Parquet tables."""
    return spark.read.parquet(table_path(folder, name, current_version(spark, folder)))


def load_tables(spark: SparkSession, folder: str, tables: Iterable[TableSpec] = TABLES) -> dict[str, DataFrame]:
    """All tables by name, of one and the same load; nothing but the manifest is
    read until a query needs it."""
    version = current_version(spark, folder)
    return {spec.name: spark.read.parquet(table_path(folder, spec.name, version)) for spec in tables}


def read_select(spark: SparkSession, query: str, parameters: Mapping[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """One SELECT or WITH statement with bound parameters over named frames."""
    if query.lstrip().split(None, 1)[0].lower() not in ("select", "with"):
        raise ValueError("only SELECT and WITH queries are read")
    if frames:
        return spark.sql(query, args=dict(parameters or {}) or None, **frames)
    return spark.sql(query, args=dict(parameters or {}) or None)
