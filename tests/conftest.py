from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tenura.session import apply_settings  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    session.stop()


START = date(2016, 1, 1)


def day(n: int | None) -> date | None:
    return None if n is None else START + timedelta(days=n)


TX_SCHEMA = (
    "user_id long, payment_method_id long, payment_plan_days long, plan_list_price long, actual_amount_paid long, "
    "is_auto_renew long, transaction_date date, membership_expire_date date, is_cancel long"
)


@pytest.fixture
def payments(spark):
    """Payments from (user, paid on day, expires on day, cancel, plan days)."""

    def make(rows):
        full = [(u, 1, plan, plan * 5, plan * 5, 1, day(t), day(e), c) for u, t, e, c, plan in rows]
        return spark.createDataFrame(full, TX_SCHEMA)

    return make


LOG_SCHEMA = (
    "user_id long, date date, num_25 long, num_50 long, num_75 long, num_985 long, num_100 long, num_unq long, "
    "total_secs double"
)


def rows_of(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df.select(*sorted(df.columns))
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
