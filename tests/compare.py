"""Run queries beside their SQL twins and compare whole results."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return None if v is None else str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda t: [x or "\0" for x in t]
    )


def difference(df, con, sql: str) -> str | None:
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(names)}\n got  {g}\n want {w}"
    return None if got else "no rows"


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracle = e.oracle_sql()
    for name, fn in e.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            out = difference(fn(spark, sf), con, oracle[name]) if name in oracle else "no oracle"
        except Exception as ex:
            out = f"{type(ex).__name__}: {str(ex)[:1500]}"
        print(f"{name:28s} {time.time() - t:6.1f}s {'OK' if out is None else out}", flush=True)
