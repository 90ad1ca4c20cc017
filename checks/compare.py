"""Run queries beside their SQL: python -m checks.compare SF_DIR [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES, tuned

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted, nulls made comparable."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "\0null"
        return f"{type(v).__name__}:{v!r}"

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES.split():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return db


def differences(spark: SparkSession, db: duckdb.DuckDBPyConnection, sf: str, query, sql: str) -> str | None:
    """What differs between the query and its SQL; None when nothing does."""
    df = query(spark, sf)
    ours = rows_of(df.columns, df.collect())
    found = db.execute(sql)
    columns = [d[0] for d in found.description]
    theirs = rows_of(columns, found.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if ours == theirs:
        return None
    extra, missing = set(ours) - set(theirs), set(theirs) - set(ours)
    return f"rows {len(ours)} vs {len(theirs)}; only ours {list(extra)[:2]}; only SQL {list(missing)[:2]}"


def main(sf: str, *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    failed = 0
    for name in names or QUERIES:
        if name not in ORACLE:
            print(f"{name}: no SQL, {QUERIES[name](spark, sf).count()} rows", flush=True)
            continue
        start = time.time()
        try:
            problem = differences(spark, db, sf, tuned(QUERIES[name]), ORACLE[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name}: {problem or 'equal'} ({time.time() - start:.1f} s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
