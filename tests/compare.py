"""Run queries next to their SQL in DuckDB and compare the rows.

    python tests/compare.py [sf_dir] [name ...]
"""

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(value):
    if value is None or isinstance(value, bool):
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 6)
    if isinstance(value, (datetime, date)):
        return str(value)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def connect(sf):
    db = duckdb.connect()
    for name in TABLES.split():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return db


def compare(df, db, sql):
    """None when equal, else a short account of the difference."""
    got = rows(df.columns, df.collect())
    found = db.execute(sql)
    names = [c[0] for c in found.description]
    want = rows(names, found.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        return (
            f"{sum(got.values())} rows, oracle {sum(want.values())};"
            f" extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}"
        )
    return None


def main():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from tidemirror.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    oracles = oracle_sql()
    failed = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        began = time.perf_counter()
        try:
            df = run(spark, sf)
            problem = compare(df, db, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad = problem is not None and not problem.startswith("rows only")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name} {time.perf_counter() - began:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
