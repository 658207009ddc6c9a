"""From raw extracts to the saved tables that features and reports are built on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tenura.functions.ordered import HOT_ROWS
from tenura.operators.sequence import transaction_order
from tenura.plans.preprocess import PreprocessSettings, preprocess
from tenura.plans.training import training_table
from tenura.session import stages
from tenura.sources.files import write_parquet_tables
from tenura.sources.layout import UserTables, read_by_month, save_by_user, write_by_month

# The tables that leave the pipeline.
OUTPUTS = ("train_merge", "transactions_merge", "user_logs_merge", "members_merge", "transactions_seq", "user_id_map")
USAGE = "user_logs_merge"


@dataclass(frozen=True)
class Exported:
    """What :func:`export_run` has written."""

    users: UserTables
    usage_path: str
    reports: dict[str, str]

    def usage(self) -> DataFrame:
        """The usage by month, for readers that look at memberships."""
        return read_by_month(self.users.spark, self.usage_path)

    def tables(self) -> dict[str, DataFrame]:
        """All outputs read back, the usage by month."""
        return {name: self.users.table(name) for name in OUTPUTS} | {USAGE: self.usage()}

    def training_table(self, weekday_mode: str = "documented", fill: float | None = 0.0) -> DataFrame:
        """The training table out of the saved tables."""
        return training_table(self.tables(), weekday_mode, fill)


def export_run(
    tables: Mapping[str, DataFrame],
    output_dir: str,
    prefix: str = "",
    settings: PreprocessSettings = PreprocessSettings(),
    buckets: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> Exported:
    """Run ``preprocess`` and save its six tables in buckets of users, the usage by month as well, and its two reports.

    Usage and payments are sorted inside a bucket in the order that sequences and daily work need. Nothing that was stored on
    the way is left when this returns.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = output_dir.rstrip("/")
    with stages(spark) as stored:
        made = preprocess(tables, settings)
        payments = transaction_order(made["transactions_merge"])
        order = {
            "transactions_merge": payments,
            "transactions_seq": ("sequence_group_id", "sequence_id"),
            USAGE: ("date",),
        }
        users = save_by_user({n: made[n] for n in OUTPUTS}, prefix, folder, order, buckets=buckets, hot_rows=hot_rows)
        usage = write_by_month(users.table(USAGE), f"{folder}/user_logs_by_month")
        reports = write_parquet_tables(made, folder, ["exclusion_counts", "date_report"])
        stored.release()
    return Exported(users, usage, reports)
