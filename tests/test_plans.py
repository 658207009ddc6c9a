"""What the physical plans may and may not hold."""

import pytest
from pyspark.sql import functions as F

from checks.world import World
from tenura.operators import cohort, features, sequence
from tenura.plans.preprocess import sequence_table
from tests.conftest import SF_SMALL


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


@pytest.fixture
def shuffled(spark):
    """Plans as for inputs too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def world(spark):
    return World(spark, SF_SMALL)


@pytest.mark.parametrize(
    "build",
    [
        lambda w: sequence.sessionize_transactions(w.tx),
        lambda w: sequence_table(w.tx),
        lambda w: cohort.with_previous(w.tx),
    ],
)
def test_ordered_columns_take_one_exchange_and_one_sort(world, build):
    text = plan(build(world))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1
    assert "SinglePartition" not in text


@pytest.mark.parametrize(
    "build",
    [
        lambda w: w.ml,
        lambda w: features.logs_in_membership(w.logs, w.last_txn),
        lambda w: cohort.drop_same_day_duplicates(w.tables, w.tx)["transactions"],
        lambda w: cohort.keep_common_users(w.tables)["user_logs"],
        lambda w: w.members5,
    ],
)
def test_row_level_plans_have_no_single_partition_and_no_nested_loop(world, shuffled, build):
    text = plan(build(world))
    assert "SinglePartition" not in text
    assert "NestedLoop" not in text


def test_anti_join_is_not_null_aware_broadcast(world, shuffled):
    text = plan(cohort.drop_same_day_duplicates(world.tables, world.tx)["user_logs"])
    assert "LeftAnti" in text and "BroadcastHashJoin" not in text


def test_membership_usage_joins_on_user_and_day_after_reducing(spark, shuffled, tmp_path):
    """Usage is exchanged once, reduced, by (user, day); the join finds it in place."""
    World(spark, SF_SMALL).logs.write.parquet(str(tmp_path / "logs"))
    World(spark, SF_SMALL).last_txn.write.parquet(str(tmp_path / "last"))
    logs, last = (spark.read.parquet(str(tmp_path / n)) for n in ("logs", "last"))
    text = plan(features.usage_profile(features.logs_in_membership(features.daily_usage(logs), last)))
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    # Usage by (user, day), the window's days by (user, day), and the rows inside it by user.
    assert len(exchanges) == 3
    assert sum("date" in line for line in exchanges) == 2


def test_scans_read_only_the_columns_they_need(world):
    text = plan(cohort.same_day_duplicate_users(world.tx))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp" in scan


def test_filters_reach_the_scan(spark, world, tmp_path):
    world.logs.write.parquet(str(tmp_path / "logs"))
    logs = spark.read.parquet(str(tmp_path / "logs"))
    from tenura.operators import daily

    hours = logs.withColumn("total_hours", F.col("total_secs") / 3600)
    assert "GreaterThanOrEqual(date,2017-01-30)" in plan(daily.recent_activity(hours))


def test_hot_key_probe_prunes_windows_below_it(world):
    counts = world.seq.groupBy("user_id").count()
    assert "Window" not in plan(counts)
