"""Run registered queries and their oracles side by side: python -m checks.compare <sf_dir> [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


def result_rows(columns, rows) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(df: DataFrame, con, sql: str) -> str | None:
    """What differs between a query's result and its oracle; None if nothing does."""
    found = result_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted = result_rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if found != wanted:
        first = next((pair for pair in zip(found, wanted) if pair[0] != pair[1]), None)
        return f"{len(found)} rows, oracle {len(wanted)}; first difference {first}"
    return None


def main(argv: list[str]) -> int:
    from checks import ORACLES, QUERIES

    sf_dir, names = argv[0], argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", "/tmp/tenura-compare")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problem = differences(QUERIES[name](spark, sf_dir), con, ORACLES[name])
            else:
                problem = None
                QUERIES[name](spark, sf_dir).collect()
        except Exception as error:  # report every query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:36} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
