"""CSV and Parquet in and out, for sets of named tables."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tenura.sources.schemas import raw_schema


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_csv_tables(
    spark: SparkSession,
    csv_dir: str,
    csv_files: Sequence[str],
    schemas: Mapping[str, StructType] | None = None,
    existing: Mapping[str, DataFrame] | None = None,
    overwrite: bool = True,
    corrupt_column: str | None = None,
) -> dict[str, DataFrame]:
    """Read CSV files with a header; a table is named after its file.

    Fields that do not parse become NULL. With ``corrupt_column``, tables with a known schema get a column that holds
    such lines whole; :func:`land_csv_tables` counts them.

    Missing files are skipped with a warning. Tables already in ``existing`` are kept as they are
    unless ``overwrite``. The schema comes from ``schemas``, else from the known raw extracts; only
    a file with neither costs an extra pass to infer it.
    """
    tables = dict(existing or {})
    for csv_file in csv_files:
        name = csv_file.removesuffix(".csv")
        path = f"{csv_dir.rstrip('/')}/{csv_file}"
        if not _exists(spark, path):
            warnings.warn(f"{csv_file}: no such file, skipped", stacklevel=2)
            continue
        if name in tables and not overwrite:
            continue
        schema = (schemas or {}).get(name) or raw_schema(name)
        reader = spark.read.option("header", True)
        if schema and corrupt_column:
            schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
        tables[name] = reader.csv(path)
    return tables


def land_csv_tables(
    spark: SparkSession,
    csv_dir: str,
    csv_files: Sequence[str],
    output_dir: str,
    schemas: Mapping[str, StructType] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Parse CSV files once and keep them as Parquet: the stored tables, and a count of lines that did not parse.

    The counts have a row per table: ``table_name``, ``n_rows``, ``n_corrupt``. Lines that did not parse stay, with NULLs.
    """
    marker = "_corrupt_line"
    landed, counts = {}, []
    for name, df in read_csv_tables(spark, csv_dir, csv_files, schemas, corrupt_column=marker).items():
        marked = df if marker in df.columns else df.withColumn(marker, F.lit(None).cast("string"))
        path = f"{output_dir.rstrip('/')}/{name}.parquet"
        marked.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(marked.schema).parquet(path)
        landed[name] = stored.drop(marker)
        counts.append(
            stored.agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count(marker).alias("n_corrupt")
            )
        )
    if not counts:
        return landed, spark.createDataFrame([], "table_name string, n_rows long, n_corrupt long")
    return landed, reduce(DataFrame.unionByName, counts)


def _chosen(tables: Mapping[str, DataFrame], names: Sequence[str] | None) -> dict[str, DataFrame]:
    chosen = {}
    for name in names if names is not None else tables:
        if name in tables:
            chosen[name] = tables[name]
        else:
            warnings.warn(f"{name}: no such table, skipped", stacklevel=3)
    return chosen


def write_parquet_tables(
    tables: Mapping[str, DataFrame],
    output_dir: str,
    names: Sequence[str] | None = None,
    compression: str = "zstd",
) -> dict[str, str]:
    """Write each table to ``<output_dir>/<name>.parquet``; returns the paths written."""
    paths = {}
    for name, df in _chosen(tables, names).items():
        paths[name] = f"{output_dir.rstrip('/')}/{name}.parquet"
        df.write.mode("overwrite").option("compression", compression).parquet(paths[name])
    return paths


def write_csv_tables(
    tables: Mapping[str, DataFrame],
    output_dir: str,
    names: Sequence[str] | None = None,
    include_header: bool = True,
) -> dict[str, str]:
    """Write each table to ``<output_dir>/<name>.csv``; returns the paths written."""
    paths = {}
    for name, df in _chosen(tables, names).items():
        paths[name] = f"{output_dir.rstrip('/')}/{name}.csv"
        df.write.mode("overwrite").option("header", include_header).csv(paths[name])
    return paths
