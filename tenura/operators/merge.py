"""Merging versioned extracts of the same table."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tenura.functions.packing import DECIMAL_BITS, Packing, Part, parts_of


def merge_prefer_latest(v1: DataFrame, v2: DataFrame, key: str = "msno") -> DataFrame:
    """One row per key, from ``v2`` where it has the key.

    Several rows of one version with the same key: the smallest by the remaining columns, NULL first. Written as
    an aggregation, so rows are reduced before the exchange and no key is gathered in a window. Where the remaining columns
    are packed into a number, or there is one of any type, as in the label tables, it is aggregated by hashing, without a sort.
    """
    rest = [column for column in v2.columns if column != key]
    both = v2.withColumn("_priority", F.lit(0)).unionByName(v1.withColumn("_priority", F.lit(1)))
    if len(rest) == 1:
        value = F.col(rest[0])
        sums = []
        for n in (0, 1):
            own = F.col("_priority") == n
            sums += [F.count_if(own).alias(f"_rows{n}"), F.count_if(own & value.isNull()).alias(f"_nulls{n}")]
            sums += [F.min(F.when(own, value)).alias(f"_least{n}")]
        chosen = F.when(F.col("_rows0") > 0, F.when(F.col("_nulls0") == 0, F.col("_least0")))
        chosen = chosen.otherwise(F.when(F.col("_nulls1") == 0, F.col("_least1"))).alias(rest[0])
        return both.groupBy(key).agg(*sums).select(*[F.col(c) if c == key else chosen for c in v2.columns])
    priority, parts = Part("_priority", IntegerType(), 0, 1), parts_of(both, rest)
    if parts is not None and priority.bits + sum(p.bits for p in parts) <= DECIMAL_BITS:
        packing = Packing(priority, *parts)
        values = packing.unpack(F.col("_best"))
        best = both.groupBy(key).agg(F.min(packing.pack()).alias("_best"))
        return best.select(*[F.col(c) if c == key else values[c].alias(c) for c in v2.columns])
    best = both.groupBy(key).agg(F.min(F.struct("_priority", *rest)).alias("_best"))
    return best.select(*[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in v2.columns])


def merge_concat(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """All rows of both versions, duplicates kept; matched by name, else by position."""
    if set(v1.columns) == set(v2.columns):
        return v1.unionByName(v2)
    return v1.union(v2)


def merge_single_version(df: DataFrame) -> DataFrame:
    """The only version there is, unchanged."""
    return df


def merge_versions(
    tables: Mapping[str, DataFrame],
    base_names: Sequence[str],
    key: str = "msno",
    drop_sources: bool = False,
) -> dict[str, DataFrame]:
    """Build ``<base without raw_>_merge`` for each base name out of its ``_v1/_v2/_v3`` tables.

    ``raw_members`` is taken from version 3, ``raw_train`` prefers version 2 per key, the others are
    concatenated; a single version is passed through. Bases without any version are skipped.
    """
    merged = dict(tables)
    for base in base_names:
        v1, v2, v3 = (tables.get(f"{base}_v{n}") for n in (1, 2, 3))
        if base == "raw_members":
            result = v3
        elif v1 is not None and v2 is not None:
            result = merge_prefer_latest(v1, v2, key) if base == "raw_train" else merge_concat(v1, v2)
        else:
            result = v1 if v1 is not None else v2
        if result is None:
            warnings.warn(f"{base}: no version to merge, skipped", stacklevel=2)
            continue
        merged[f"{base.replace('raw_', '')}_merge"] = merge_single_version(result)
        if drop_sources:
            for n in (1, 2, 3):
                merged.pop(f"{base}_v{n}", None)
    return merged
