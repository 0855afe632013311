"""Run registered queries and their SQL side by side.

    python -m checks.compare [sf_dir] [name prefixes …]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if value is None or value is pd.NaT:
        return "∅"
    if isinstance(value, float):
        return "∅" if value != value else repr(value + 0.0)
    if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, Decimal):
        return f"DECIMAL {value}"
    if hasattr(value, "item"):
        return _cell(value.item())
    if isinstance(value, pd.Timestamp):
        return str(value)
    if type(value).__name__ == "datetime":
        return str(pd.Timestamp(value))
    if type(value).__name__ == "date":
        return str(pd.Timestamp(value))
    return repr(value) if isinstance(value, int) else str(value)


def canonical(rows: list[tuple], columns: list[str]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


_FAMILY = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(frame, cursor) -> list[str]:
    """Differences as text; empty when both sides agree in names, types and values."""
    problems = []
    left = canonical([tuple(r) for r in frame.collect()], frame.columns)
    names = [d[0] for d in cursor.description]
    right = canonical(cursor.fetchall(), names)
    if left[0] != right[0]:
        return [f"columns {left[0]} against {right[0]}"]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    for name, kind in frame.dtypes:
        if _FAMILY.get(kind, kind) != kinds[name].upper():
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    if len(left[1]) != len(right[1]):
        problems.append(f"{len(left[1])} rows against {len(right[1])}")
    elif left[1] != right[1]:
        different = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    return problems


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from cartograin.registry import REGISTRY
    from cartograin.session import local_session

    from .oracle import ORACLE

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark, connection, failures = local_session(8), connect(folder), 0
    for name, run in REGISTRY.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        if name not in ORACLE:
            print(f"{name:36s} no SQL", flush=True)
            continue
        begin = time.time()
        try:
            problems = compare(run(spark, folder), connection.execute(ORACLE[name]))
        except Exception as error:  # noqa: BLE001
            problems = [str(error)[:600].replace("\n", " | ")]
        failures += bool(problems)
        print(f"{name:36s} {'ok' if not problems else 'DIFFERENT ' + '; '.join(problems)} {time.time() - begin:.1f}s", flush=True)
    print(f"{failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    raise SystemExit(main())
