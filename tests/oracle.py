"""Run registered queries beside their DuckDB SQL and compare rows, columns and values.

    python -m tests.oracle --sf 0.01 [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import os
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.plans.registry import TABLES  # noqa: E402

TESTDATA = "/root/testdata"


def local_session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quayside-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "localhost")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _canon(value):
    if value is None:
        return "~null~"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, float):
        return f"f:{value!r}"
    if isinstance(value, decimal.Decimal):
        return f"d:{value}"
    if isinstance(value, datetime.datetime):
        return f"t:{value.isoformat()}"
    if isinstance(value, datetime.date):
        return f"a:{value.isoformat()}"
    return f"{type(value).__name__}:{value}"


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sf_dir):
    """None when both sides agree, else a text saying how they differ."""
    df = query(spark, sf_dir)
    ours = table_of(df.columns, [tuple(r) for r in df.collect()])
    if query.oracle is None:
        return None
    cur = con.execute(query.oracle)
    theirs = table_of([d[0] for d in cur.description], cur.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} <> {theirs[0]}"
    if ours[1] != theirs[1]:
        a, b = set(ours[1]), set(theirs[1])
        return (
            f"{ours[0]}: {len(ours[1])} rows <> {len(theirs[1])} rows; "
            f"ours only {sorted(a - b)[:3]}; theirs only {sorted(b - a)[:3]}"
        )
    return None if ours[1] else "no rows"


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import quayside.plans as plans

    sf_dir = f"{TESTDATA}/sf{args.sf}"
    spark, con = local_session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, query in plans.QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, query, sf_dir)
        except Exception as e:  # keep going: the report is the point
            problem = f"{type(e).__name__}: {str(e)[:900]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        kind = "ok " if query.oracle else "run"
        if problem:
            bad += 1
        print(f"{'BAD' if problem else kind} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
