"""Stored layouts that later reads profit from: usage by month, and tables in buckets of users.

**By month.** A folder per calendar month of a date column; inside, files are sorted by user, so that the statistics of a file
part tell which users it holds. Readers that look at memberships join the months first (``functions.months``).

**By user.** Tables that are joined on the user again and again are saved as bucketed catalog tables, sorted inside a bucket.
All of them have the same buckets, so a join on the user, and an aggregation or window over it, starts without an exchange. A bucket is
read by one task, which a user with a large share of the rows would hold up. Users with more than ``hot_rows`` rows in any of the
tables are therefore kept in plain tables beside the buckets (``<table>_hot``), in all tables alike. ``UserTables.each`` runs a
plan on both parts and puts the results together; the plan has to work on whole users, as every operator here does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions.months import MONTH, month_of
from tenura.functions.ordered import HOT_ROWS
from tenura.session import materialize


def write_by_month(
    df: DataFrame, path: str, date: str = "date", user: str = "user_id", compression: str = "zstd", mode: str = "overwrite"
) -> str:
    """Write ``df`` with a folder per month of ``date``; returns the path.

    Rows are dealt by month, user and day in equal parts, so a month or a user of any size is written by many tasks, and a task
    opens files of few months. Rows with a NULL date are kept in a folder of their own.
    """
    order = (MONTH, user, date)
    dealt = df.withColumn(MONTH, month_of(date)).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.write.mode(mode).partitionBy(MONTH).option("compression", compression).parquet(path)
    return path


def read_by_month(spark: SparkSession, path: str) -> DataFrame:
    """A table of :func:`write_by_month`, with its month as last column."""
    return spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("int"))


@dataclass(frozen=True)
class UserTables:
    """Tables saved in buckets of users; names without their prefix."""

    spark: SparkSession
    prefix: str
    names: Sequence[str]
    hot: bool = field(default=False)

    def ordinary(self, name: str) -> DataFrame:
        """The rows of all users but the hot ones, in buckets."""
        return self.spark.table(f"{self.prefix}{name}")

    def table(self, name: str) -> DataFrame:
        """All rows of a table."""
        rows = self.ordinary(name)
        return rows.unionByName(self.spark.table(f"{self.prefix}{name}_hot")) if self.hot else rows

    def each(self, plan: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
        """``plan`` on the tables of ordinary users, and on those of hot users where there are any."""
        result = plan({name: self.ordinary(name) for name in self.names})
        if not self.hot:
            return result
        hot = plan({name: self.spark.table(f"{self.prefix}{name}_hot") for name in self.names})
        return result.unionByName(hot)

    def drop(self) -> None:
        """Forget the tables; files at a path of their own stay."""
        for name in self.names:
            for table in [f"{self.prefix}{name}"] + [f"{self.prefix}{name}_hot"] * self.hot:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")


def hot_users(tables: Mapping[str, DataFrame], user: str = "user_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The users with more than ``hot_rows`` rows in any of the tables, stored."""
    counts = [
        df.groupBy(user).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows).select(user) for df in tables.values()
    ]
    return materialize(reduce(DataFrame.union, counts).distinct(), "hot-users")


def save_by_user(
    tables: Mapping[str, DataFrame],
    prefix: str,
    output_dir: str,
    order: Mapping[str, Sequence[str]] | None = None,
    user: str = "user_id",
    buckets: int | None = None,
    hot_rows: int | None = HOT_ROWS,
    compression: str = "zstd",
) -> UserTables:
    """Save ``tables`` as catalog tables ``<prefix><name>`` below ``output_dir``, in ``buckets`` of users.

    ``order`` has the columns that a table's rows are sorted by after the user. Each bucket is one file. Tables that exist
    are replaced. Rows with a NULL user stay with the ordinary ones. ``hot_rows=None`` skips the look for hot users.
    """
    spark = next(iter(tables.values())).sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_users(tables, user, hot_rows) if hot_rows is not None else None
    some_hot = hot is not None and not hot.isEmpty()
    for name, df in tables.items():
        sort = [user, *(order or {}).get(name, ())]
        path = f"{output_dir.rstrip('/')}/{name}"
        ordinary = df.join(hot, user, "left_anti") if some_hot else df
        dealt = ordinary.select(df.columns).repartition(buckets, user).write.bucketBy(buckets, user).sortBy(*sort)
        dealt.option("path", path).option("compression", compression).mode("overwrite").saveAsTable(f"{prefix}{name}")
        if some_hot:
            apart = df.join(hot, user, "left_semi").select(df.columns).repartitionByRange(*sort).sortWithinPartitions(*sort)
            written = apart.write.option("path", f"{path}_hot").option("compression", compression)
            written.mode("overwrite").saveAsTable(f"{prefix}{name}_hot")
    return UserTables(spark, prefix, list(tables), some_hot)
