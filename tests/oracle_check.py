"""Compare every query with its SQL: ``python -m tests.oracle_check [folder] [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

import __spark_entry__ as driver
from marquee.session import build_session


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def sorted_rows(rows, names) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def differences(spark, db, folder: str, name: str) -> str | None:
    """None where Spark and SQL agree, else what differs."""
    df = driver.queries()[name](spark, folder)
    got = sorted_rows([tuple(r) for r in df.collect()], df.columns)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    want = sorted_rows(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if got != want:
        odd = [(a, b) for a, b in zip(got, want) if a != b][:2]
        return f"{len(got)} and {len(want)} rows, first differences {odd}"
    return None if got else "no rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(driver.queries())
    spark = build_session("oracle-check", "local[8]", 8, **{"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db = database(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, db, folder, name)
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
