"""Input tables of the registered queries, derived by Spark from the star-schema files."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators import features, membership, merge, transform
from tenura.plans.preprocess import PREVIOUS_COLUMNS, sequence_table
from tenura.session import apply_settings, scratch_dir
from tenura.sources import layout, star_schema


class World:
    """Lazily built inputs over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = apply_settings(spark), sf_dir

    @cached_property
    def tx(self) -> DataFrame:
        return star_schema.transactions(self.spark, self.sf_dir)

    @cached_property
    def logs(self) -> DataFrame:
        return star_schema.user_logs(self.spark, self.sf_dir)

    @cached_property
    def monthly(self) -> DataFrame:
        """The usage, stored by month."""
        return layout.read_by_month(self.spark, layout.write_by_month(self.logs, self.folder("usage")))

    @cached_property
    def raw_members(self) -> DataFrame:
        return star_schema.raw_members(self.spark, self.sf_dir)

    @cached_property
    def members(self) -> DataFrame:
        return transform.parse_int_dates(transform.encode_gender(self.raw_members)).drop("msno")

    @cached_property
    def tv1(self) -> DataFrame:
        return star_schema.train_v1(self.spark, self.sf_dir)

    @cached_property
    def tv2(self) -> DataFrame:
        return star_schema.train_v2(self.spark, self.sf_dir)

    @cached_property
    def train(self) -> DataFrame:
        return merge.merge_prefer_latest(self.tv1, self.tv2, "user_id")

    @cached_property
    def seq(self) -> DataFrame:
        return sequence_table(self.tx).drop(*PREVIOUS_COLUMNS)

    @cached_property
    def usage(self) -> DataFrame:
        """Usage with time outside a day's seconds set to NULL."""
        return transform.nullify_out_of_range(self.logs, "total_secs", 0, 86400)

    @cached_property
    def hours(self) -> DataFrame:
        return transform.convert_unit(self.logs, "total_secs", "total_hours", divisor=3600)

    @cached_property
    def members_last(self) -> DataFrame:
        last = self.seq.groupBy("user_id").agg(F.max("membership_expire_date").alias("last_expire"))
        return self.members.join(last, "user_id", "left")

    @cached_property
    def members5(self) -> DataFrame:
        return membership.attach_label(membership.last_txn_in_window(self.members, self.seq), self.train)

    @cached_property
    def last_txn(self) -> DataFrame:
        return features.user_last_txn(self.members5, self.seq)

    @cached_property
    def filtered(self) -> DataFrame:
        return features.logs_in_membership(self.logs, self.last_txn)

    @cached_property
    def ml(self) -> DataFrame:
        return features.feature_table(self.members5, self.seq, self.logs)

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        """The four tables cohort filters run on."""
        return {
            "train": self.train, "transactions": self.tx, "user_logs": self.logs, "members": self.raw_members,
        }

    def named(self, df: DataFrame) -> DataFrame:
        """Keyed by the customer name instead of the id."""
        return star_schema.with_name_key(df, self.spark, self.sf_dir)

    @cached_property
    def raw_tables(self) -> dict[str, DataFrame]:
        """Raw extracts: string key, integer dates, two versions each."""

        def ints(df, *columns):
            return df.withColumns({c: F.date_format(c, "yyyyMMdd").cast("long") for c in columns})

        even = F.col("user_id") % 2 == 0
        tx = ints(self.tx, "transaction_date", "membership_expire_date")
        logs = ints(self.logs, "date")
        return {
            "raw_train_v1": self.named(self.tv1),
            "raw_train_v2": self.named(self.tv2),
            "raw_transactions_v1": self.named(tx.where(even)),
            "raw_transactions_v2": self.named(tx.where(~even)),
            "raw_user_logs_v1": self.named(logs.where(even)),
            "raw_user_logs_v2": self.named(logs.where(~even)),
            "raw_members_v3": self.raw_members.drop("user_id"),
        }

    def folder(self, name: str) -> str:
        """A new folder below the shared scratch folder."""
        import uuid

        return f"{scratch_dir(self.spark)}/{name}-{uuid.uuid4().hex}"


def survivors(tables: dict[str, DataFrame], key: str = "user_id") -> DataFrame:
    """Rows per table and user."""
    parts = [df.select(F.lit(name).alias("table_name"), key) for name, df in tables.items()]
    return reduce(DataFrame.union, parts).groupBy("table_name", key).agg(F.count(F.lit(1)).alias("n_rows"))
