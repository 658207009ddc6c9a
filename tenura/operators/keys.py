"""Dense integer surrogate keys for string keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.placement import dense_index


def number_keys(keys: DataFrame, key: str = "msno", id_column: str = "user_id") -> DataFrame:
    """Ids 0, 1, 2, ... in key order for distinct keys; NULL and empty keys get none."""
    return dense_index(keys.where(F.col(key).isNotNull() & (F.col(key) != "")).select(key), key, id_column)


def build_id_map(tables: Mapping[str, DataFrame], key: str = "msno", id_column: str = "user_id") -> DataFrame:
    """``number_keys`` over the keys of all tables."""
    keyed = [df.select(key) for df in tables.values() if key in df.columns]
    if not keyed:
        raise ValueError(f"no table has a column {key}")
    return number_keys(reduce(DataFrame.union, keyed).distinct(), key, id_column)


def id_map_duplicates(id_map: DataFrame, key: str = "msno") -> DataFrame:
    """Keys that occur more than once in a map, with their count; empty for a sound map."""
    return id_map.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def apply_id_map(
    tables: Mapping[str, DataFrame], id_map: DataFrame, key: str = "msno", id_column: str = "user_id"
) -> dict[str, DataFrame]:
    """Replace the key of each table by its id, under the key's own name; unmapped rows drop out."""

    def mapped(df: DataFrame) -> DataFrame:
        rest = [column for column in df.columns if column != key]
        return df.join(id_map, key).select(F.col(id_column).alias(key), *rest)

    return {name: mapped(df) if key in df.columns else df for name, df in tables.items()}


def id_map_losses(tables: Mapping[str, DataFrame], id_map: DataFrame, key: str = "msno") -> DataFrame:
    """Rows per table, and rows whose key is not in the map."""

    def losses(name: str, df: DataFrame) -> DataFrame:
        known = id_map.select(key, F.lit(1).alias("_known"))
        return (
            df.select(key)
            .join(known, key, "left")
            .agg(
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(F.col("_known").isNull()).alias("lost_rows"),
            )
            .select(F.lit(name).alias("table_name"), "row_count", "lost_rows")
        )

    return reduce(DataFrame.unionByName, [losses(n, df) for n, df in tables.items() if key in df.columns])
