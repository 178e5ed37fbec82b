"""Compare queries with their SQL oracles: python tests/check.py [sf_dir] [query ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_points  # noqa: E402


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = db.sql(sql)
    return result.columns, result.fetchall()


def normal(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return repr(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def differences(spark, sf_dir: str, name: str) -> tuple[int, str]:
    """(rows, '') when equal, else (rows, what differs)."""
    df = entry_points.queries()[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return len(got), ""
    columns, rows = oracle_rows(sf_dir, sql)
    want = canonical(columns, rows)
    if sorted(df.columns) != sorted(columns):
        return len(got), f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        more, less = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return len(got), f"{len(got)} rows, {len(want)} wanted; extra {more[:2]}; lacking {less[:2]}"
    return len(got), ""


if __name__ == "__main__":
    from tillstream.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    settings = {"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-")}
    spark = build_session("check", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for query in sys.argv[2:] or entry_points.queries():
        began = time.time()
        try:
            n, problem = differences(spark, folder, query)
        except Exception as error:  # report and go on with the next query
            n, problem = 0, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {query:28} {n:7} rows {time.time() - began:6.2f}s {problem}", flush=True)
    sys.exit(bool(bad))
