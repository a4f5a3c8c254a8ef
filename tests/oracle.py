"""Compares queries with their DuckDB oracles: python tests/oracle.py [SF_DIR] NAME..."""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: int = 4) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("tests").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g").config("spark.driver.host", "127.0.0.1").getOrCreate()
    )


def plain(value):
    """A comparable form of a value: floats to 9 significant digits."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if hasattr(value, "asDict"):
        return tuple((k, plain(v)) for k, v in sorted(value.asDict().items()))
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    return str(value)


def expected(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in found.fetchall())


def actual(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in names]).collect())


def differences(df: DataFrame, sql: str, sf_dir: str) -> str:
    a, b = actual(df), expected(sql, sf_dir)
    if a[0] != b[0]:
        return f"columns {a[0]} and {b[0]}"
    if a[1] != b[1]:
        return f"rows {sum(a[1].values())} and {sum(b[1].values())}; only Spark {list((a[1] - b[1]).items())[:2]}; only DuckDB {list((b[1] - a[1]).items())[:2]}"
    return ""


if __name__ == "__main__":
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e

    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, q, o = session(8), e.queries(), e.oracle_sql()
    spark.sparkContext.setLogLevel("ERROR")
    for name in args or q:
        began = time.time()
        try:
            bad = differences(q[name](spark, sf), o[name], sf) if name in o else f"no oracle, {q[name](spark, sf).count()} rows"
        except Exception as x:
            bad = f"{type(x).__name__} {str(x)[:700]}"
        print(f"{time.time() - began:5.1f}s {name}: {bad or 'ok'}", flush=True)
