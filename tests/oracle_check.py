"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as driver  # noqa: E402

TABLES = ("orders", "customer", "documents", "benchmark", "labels")


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.date().isoformat() if value.time() == datetime.time() else value.isoformat()
    return str(value)


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def compare(frame, con, name: str) -> str | None:
    """None when both sides agree, else a short description of the difference."""
    got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(driver.oracle_sql()[name])
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{dict(zip(got[0], a))} != {dict(zip(want[0], b))}"
    return None


def main() -> None:
    from polderbook.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    sf_dir = f"/root/testdata/sf{sf}"
    con = connection(sf_dir)
    bad = 0
    for name in sys.argv[2:] or driver.queries():
        start = time.time()
        try:
            problem = compare(driver.queries()[name](spark, sf_dir), con, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
