"""Compare registered queries with their oracle SQL.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _bag(names: list[str], rows: list) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(repr(r[i]) for i in order) for r in rows)


def expected(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return _bag(names, cursor.fetchall())


def actual(df) -> tuple[list[str], Counter]:
    return _bag(df.columns, [tuple(r) for r in df.collect()])


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    got_names, got = actual(df)
    want_names, want = expected(con, sql)
    if got_names != want_names:
        return f"columns {got_names} instead of {want_names}"
    if got != want:
        return (
            f"{got.total()} rows instead of {want.total()}; "
            f"surplus {list((got - want).items())[:2]}, missing {list((want - got).items())[:2]}"
        )
    if not want:
        return "no rows to compare"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in chosen:
        start = time.time()
        try:
            problem = difference(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
