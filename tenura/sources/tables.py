"""Copying, renaming, extending and profiling tables of a table set."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions.sampling import SEED, exact_sample

Tables = Mapping[str, DataFrame]


def copy_tables(
    tables: Tables, mapping: Mapping[str, str], overwrite: bool = False, location: str | None = None
) -> dict[str, DataFrame]:
    """Store full copies in the catalog under the names ``mapping`` gives (source to target).

    A target that exists is kept unless ``overwrite``. ``location`` puts the files of each copy in
    a folder of that name below it instead of the warehouse.
    """
    copies = {}
    for source, target in mapping.items():
        if source not in tables:
            warnings.warn(f"{source}: no such table, skipped", stacklevel=2)
            continue
        df = tables[source]
        writer = df.write.mode("overwrite" if overwrite else "ignore")
        if location:
            writer = writer.option("path", f"{location.rstrip('/')}/{target}")
        writer.saveAsTable(target)
        copies[target] = df.sparkSession.table(target)
    return copies


def rename_versioned(tables: Tables, names: Sequence[str], suffix: str = "_v1") -> dict[str, DataFrame]:
    """Add a version suffix to the listed tables, except where the new name is taken."""
    renamed = dict(tables)
    for name in names:
        target = f"{name}{suffix}"
        if name in renamed and target not in renamed:
            renamed[target] = renamed.pop(name)
    return renamed


def rename_catalog_table(spark: SparkSession, name: str, suffix: str = "_v1") -> bool:
    """The same for a table of the catalog; False when there is nothing to rename."""
    target = f"{name}{suffix}"
    if not spark.catalog.tableExists(name) or spark.catalog.tableExists(target):
        return False
    spark.sql(f"ALTER TABLE `{name}` RENAME TO `{target}`")
    return True


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a column; no change when it is absent or the new name is taken."""
    if old not in df.columns or new in df.columns:
        return df
    return df.withColumnRenamed(old, new)


def rename_key_column(
    tables: Tables, old: str = "msno", new: str = "user_id", names: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Rename the key column in the listed tables (all by default)."""
    chosen = set(names if names is not None else tables)
    return {name: rename_column(df, old, new) if name in chosen else df for name, df in tables.items()}


def add_column(
    df: DataFrame, name: str, data_type: str, default: str | None = None, overwrite: bool = True
) -> DataFrame:
    """Add a typed column holding a SQL default expression (NULL without one), as the last column.

    An existing column is replaced, or kept when ``overwrite`` is False.
    """
    if name in df.columns and not overwrite:
        return df
    value = F.expr(default) if default is not None else F.lit(None)
    kept = [column for column in df.columns if column != name]
    return df.select(*kept, value.cast(data_type).alias(name))


def table_profile(tables: Tables) -> DataFrame:
    """One row per column of every table: row count, column count, position, name and type."""

    def profile(name: str, df: DataFrame) -> DataFrame:
        described = F.array(
            *[
                F.struct(
                    F.lit(position).alias("column_no"),
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("column_type"),
                )
                for position, field in enumerate(df.schema.fields, start=1)
            ]
        )
        return (
            df.agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), "row_count", F.inline(described))
            .withColumn("column_count", F.lit(len(df.columns)))
        )

    return reduce(DataFrame.unionByName, [profile(name, df) for name, df in tables.items()])


def table_sample(df: DataFrame, size: int = 5, key: Sequence[str] | None = None, seed: int = SEED) -> DataFrame:
    """Some rows of a table: the first ones met, in no particular order, or with a ``key`` the same on every run."""
    return df.limit(size) if key is None else exact_sample(df, size, key, seed)
