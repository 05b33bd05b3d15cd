"""Compare each registered query with its SQL twin.

Usage: python tests/compare.py <sf_dir> [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from datetime import date, datetime

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def normal(value):
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def differences(spark_frame, connection, sql: str) -> tuple[int, int, str]:
    """Row counts of both sides and a description of what differs, empty if nothing."""
    columns = sorted(spark_frame.columns)
    mine = Counter(
        tuple(normal(row[c]) for c in columns) for row in spark_frame.toLocalIterator()
    )
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return sum(mine.values()), -1, f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(normal(row[i]) for i in order) for row in cursor.fetchall())
    only_mine, only_theirs = mine - theirs, theirs - mine
    text = ""
    if only_mine or only_theirs:
        text = f"{sum(only_mine.values())} only in Spark {list(only_mine)[:3]}, "
        text += f"{sum(only_theirs.values())} only in SQL {list(only_theirs)[:3]}"
    return sum(mine.values()), sum(theirs.values()), text


def types(spark_frame, connection, sql: str) -> dict:
    """Column types that differ by name."""
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    theirs = {d[0]: str(d[1]) for d in connection.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {n: names.get(t, t) for n, t in spark_frame.dtypes}
    return {n: (t, theirs.get(n)) for n, t in mine.items() if theirs.get(n) != t}


def main() -> int:
    from tests.session import local_session

    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    connection = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in oracles:
                rows, expected, text = differences(frame, connection, oracles[name])
                wrong = types(frame, connection, oracles[name])
                text += f" types {wrong}" if wrong else ""
            else:
                rows, expected, text = frame.count(), None, ""
        except Exception as error:  # noqa: BLE001 - report and go on
            rows, expected, text = -1, -1, str(error)[:1500]
        failed += bool(text)
        print(f"{'FAIL' if text else 'ok':5}{name:32}{rows:>9} {expected!s:>9} {time.time() - start:6.1f}s {text}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
