"""Subscription tables derived from an order / customer / event star schema.

Dates are mapped onto 2015-2017; all raw numbers are integral, so sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments from orders: order dates squeezed by 3 onto 2015-01-01 ... 2017-03-12."""
    return (
        _table(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey as k",
            "o_custkey as user_id",
            "date_add(date '2015-01-01', cast(datediff(cast(o_orderdate as date), date '1995-01-01') div 3 as int)) as td",
            "case o_orderkey % 10 when 0 then 7 when 1 then 90 when 2 then 31 when 3 then 180 when 4 then 400 "
            "when 5 then 60 else 30 end as p",
        )
        .selectExpr(
            "cast(user_id as bigint) as user_id",
            "cast(1 + k % 40 as bigint) as payment_method_id",
            "cast(p as bigint) as payment_plan_days",
            "cast(p * 5 as bigint) as plan_list_price",
            "cast(case when k % 9 = 0 then 0 else p * 5 end as bigint) as actual_amount_paid",
            "cast(case when k % 20 = 0 then 0 else 1 end as bigint) as is_auto_renew",
            "td as transaction_date",
            "date_add(td, cast(case when k % 7 = 0 then -(k % 5) else p end as int)) as membership_expire_date",
            "cast(case when k % 7 = 0 then 1 else 0 end as bigint) as is_cancel",
        )
    )


def user_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily usage from events, one row per user and day."""
    kinds = {"num_25": "error", "num_50": "view", "num_75": "click", "num_985": "signup", "num_100": "purchase"}
    return (
        _table(spark, sf_dir, "events")
        .selectExpr(
            "cast(user_id * 10 + event_id % 10 as bigint) as user_id",
            "date_add(date '2017-02-15', datediff(cast(ts as date), date '2024-01-01')) as date",
            "event_type",
            "cast(round(value * 300) as bigint) as secs",
        )
        .groupBy("user_id", "date")
        .agg(
            *[
                F.sum(F.when(F.col("event_type") == kind, 1).otherwise(0)).cast("long").alias(name)
                for name, kind in kinds.items()
            ],
            F.countDistinct("event_type").alias("num_unq"),
            F.sum("secs").cast("double").alias("total_secs"),
        )
    )


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles from customers, with raw gender and integer registration date."""
    return _table(spark, sf_dir, "customer").selectExpr(
        "c_name as msno",
        "cast(c_custkey as bigint) as user_id",
        "cast(c_nationkey % 22 as bigint) as city",
        "cast(floor(c_acctbal / 100) as bigint) as bd",
        "case c_mktsegment when 'BUILDING' then 'male' when 'MACHINERY' then 'female' "
        "when 'FURNITURE' then 'unknown' end as gender",
        "cast(c_nationkey % 5 + 1 as bigint) as registered_via",
        "cast(20040101 + (c_custkey % 12) * 10000 + (c_custkey % 11) * 100 + c_custkey % 28 as bigint) "
        "as registration_init_time",
    )


def train_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "customer")
        .where("c_custkey % 5 <> 4")
        .selectExpr(
            "cast(c_custkey as bigint) as user_id",
            "cast(case when c_custkey % 10 = 0 then 1 else 0 end as bigint) as is_churn",
        )
    )


def train_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "customer")
        .where("c_custkey % 7 <> 6")
        .selectExpr(
            "cast(c_custkey as bigint) as user_id",
            "cast(case when c_custkey % 11 = 0 then 1 else 0 end as bigint) as is_churn",
        )
    )


def with_name_key(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace ``user_id`` by the customer name as string key ``msno``."""
    names = _table(spark, sf_dir, "customer").selectExpr("cast(c_custkey as bigint) as user_id", "c_name as msno")
    return df.join(names, "user_id").select("msno", *[c for c in df.columns if c != "user_id"])
