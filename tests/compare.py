"""Runs a registered query and its SQL on the same tables and compares all rows.

``python -m tests.compare [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """The number of Spark rows, and what differs from the SQL result; values must be identical."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    columns = sorted(names)
    found = []
    if sorted(spark_df.columns) != columns:
        return 0, [f"columns {sorted(spark_df.columns)} != {columns}"]
    places = [names.index(c) for c in columns]
    expected = Counter(tuple(row[p] for p in places) for row in result.fetchall())
    rows = [tuple(row) for row in spark_df.select(*columns).collect()]
    actual = Counter(rows)
    for label, extra in (("only in Spark", actual - expected), ("only in SQL", expected - actual)):
        if extra:
            sample = [tuple(str(v)[:80] for v in r) for r in sorted(extra, key=str)[:3]]
            found.append(f"{sum(extra.values())} rows {label}, such as {sample}")
    return len(rows), found


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark, con, sql = make_session(), connect(sf_dir), oracle_sql()
    for name in chosen:
        start = time.time()
        try:
            rows, found = differences(queries()[name](spark, sf_dir), con, sql[name])
        except Exception as error:  # a failing query must not hide the others
            rows, found = 0, [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'FAIL' if found else 'ok  '} {name:32s} {rows:8d} rows {time.time() - start:6.2f} s", flush=True)
        for line in found:
            print("     ", line)


if __name__ == "__main__":
    main()
