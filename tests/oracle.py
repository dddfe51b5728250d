"""Compare registered queries with their SQL oracle on DuckDB.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value) if isinstance(value, decimal.Decimal) else value
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    return value


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    return type(value).__name__


def compare(spark_frame, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    frame = spark_frame
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    got = [tuple(r) for r in frame.collect()]
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    order = sorted(names)
    a_index = [frame.columns.index(n) for n in order]
    b_index = [names.index(n) for n in order]
    a = [tuple(plain(r[i]) for i in a_index) for r in got]
    b = [tuple(plain(r[i]) for i in b_index) for r in expected]
    kinds_a = [{kind(r[i]) for r in got if r[i] is not None} for i in a_index]
    kinds_b = [{kind(r[i]) for r in expected if r[i] is not None} for i in b_index]
    for name, x, y in zip(order, kinds_a, kinds_b):
        if x != y:
            return f"type of {name}: {x} != {y}"
    only_a, only_b = Counter(a) - Counter(b), Counter(b) - Counter(a)
    if only_a or only_b:
        return (f"{sum(only_a.values())} rows differ of {len(a)}; columns {order}; "
                f"spark {sorted(only_a, key=str)[:2]} oracle {sorted(only_b, key=str)[:2]}")
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from strataline.session import local_session
    from strataline.suite.all import ORACLES, QUERIES

    names = sys.argv[2:] or list(QUERIES)
    spark, connection, bad = local_session(8), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = compare(frame, connection, ORACLES[name])
            else:
                problem = f"no oracle ({frame.count()} rows)"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
