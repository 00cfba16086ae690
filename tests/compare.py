"""Compare queries with their SQL on one scale folder: python tests/compare.py [sf] [names]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, decimal.Decimal)):
        return float(value) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


def connect(sf_dir):
    from catalog.domain import TABLES

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def difference(spark, db, sf_dir, name, query, sql):
    """None when equal, else what differs."""
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return None
    cursor = db.execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(got[1])} rows differ, first {got[0]} {wrong[0]}"
    return None if got[1] else "no rows"


def main():
    import __spark_entry__ as driver
    from pyspark.sql import SparkSession

    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    queries, oracles = driver.queries(), driver.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(spark, db, sf_dir, name, query, oracles.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s"
              f"{'' if name in oracles else ' (no sql)'} {problem or ''}", flush=True)
    print(f"{bad} wrong of {len(only) or len(queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
