"""Run registered queries next to their oracle and compare rows: ``check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rooftally.fixtures import TABLES  # noqa: E402
from rooftally.queries import ORACLES, QUERIES  # noqa: E402
from rooftally.session import build_session  # noqa: E402


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value.asDict().values())
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if type(value).__name__ == "Decimal":
        return plain(float(value))
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str):
    """(ok, message, seconds)"""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    records = df.collect()
    seconds = time.time() - start
    mine = rows_of(df.columns, records)
    if name not in ORACLES:
        return True, f"no oracle, {len(records)} rows", seconds
    answer = con.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    theirs = rows_of(columns, answer.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}", seconds
    if mine != theirs:
        only_mine, only_theirs = list((mine - theirs).items())[:3], list((theirs - mine).items())[:3]
        return False, f"{sum(mine.values())} rows against {sum(theirs.values())}\n  spark {only_mine}\n  duckdb {only_theirs}", seconds
    return True, f"{len(records)} rows", seconds


def main() -> int:
    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in arguments or list(QUERIES):
        try:
            ok, message, seconds = compare(spark, con, sf_dir, name)
        except Exception as error:  # the report goes on with the next query
            ok, message, seconds = False, f"{type(error).__name__}: {str(error)[:400]}", 0.0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {seconds:6.2f}s  {message}", flush=True)
    print(f"{bad} of {len(arguments or QUERIES)} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
