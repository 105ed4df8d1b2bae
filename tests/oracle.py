"""Compare each query with its SQL: `python tests/oracle.py [sf_dir] [query ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _sorted(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(df, connection, sql: str) -> str | None:
    """None when both give the same columns and the same rows, else what differs."""
    cursor = connection.execute(sql)
    wanted_columns = [d[0] for d in cursor.description]
    if sorted(wanted_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(wanted_columns)}"
    wanted = _sorted(wanted_columns, cursor.fetchall())
    got = _sorted(df.columns, (tuple(row) for row in df.collect()))
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for mine, theirs in zip(got, wanted):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{mine} != {theirs}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tradelake.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(
        "oracle",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            wrong = difference(query(spark, folder), connection, oracle_sql()[name])
        except Exception as error:  # noqa: BLE001 - report and go on
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += wrong is not None
        print(f"{name:26s} {time.time() - start:6.1f}s {'ok' if wrong is None else wrong}", flush=True)
    print("failed:", failed)
