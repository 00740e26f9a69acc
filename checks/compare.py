"""Run queries and their SQL side by side and report differences."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from padron.session import builder

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


def difference(spark, con, sf_dir: str, name: str) -> str:
    """Empty when both sides agree in columns and rows."""
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, (tuple(r) for r in frame.collect()))
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns differ: {sorted(set(columns) ^ set(frame.columns))}"
    if got != want:
        only = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum((got - want).values())} rows only in Spark, {sum((want - got).values())} only in SQL: {only}"
    return ""


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        builder("compare")
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = "no SQL" if name not in ORACLE else difference(spark, con, sf_dir, name)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(problem)
        print(f"{name:28s} {time.time() - start:5.1f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
