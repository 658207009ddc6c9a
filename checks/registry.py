"""Registered queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sql import oracle
from checks.world import World

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COLUMNS: dict[str, str] = {}


def typed(df: DataFrame, columns: str) -> DataFrame:
    """Result columns typed and rounded as in ``sql.oracle``."""
    kinds = {"b": "bigint", "t": "date", "s": "string", "f": "boolean"}
    chosen = []
    for group in columns.split():
        kind, names = group.split(":")
        for name in names.split(","):
            value = F.round(F.col(name).cast("double") + 1e-10, 6) if kind == "d" else F.col(name).cast(kinds[kind])
            chosen.append(value.alias(name))
    return df.select(*chosen)


def check(
    name: str, columns: str, build: Callable[[World], DataFrame], body: str | None = None, *needs: str
) -> None:
    """Register a query and, if there is one, its oracle over the CTEs ``needs``."""
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    COLUMNS[name] = columns
    QUERIES[name] = lambda spark, sf_dir: typed(build(World(spark, sf_dir)), columns)
    if body is not None:
        ORACLES[name] = oracle(body, columns, *needs)


def check_same(name: str, other: str, build: Callable[[World], DataFrame]) -> None:
    """Register another way to the result of the query ``other``, under the same oracle."""
    check(name, COLUMNS[other], build)
    ORACLES[name] = ORACLES[other]
