import statistics

import pytest

from tenura.operators import daily, features, membership
from tenura.plans.preprocess import sequence_table
from tenura.plans.training import training_run
from tests.conftest import LOG_SCHEMA, SF_CHECK, day, rows_of
from tests.test_plans import plan

WINDOW = (str(day(50)), str(day(120)))


@pytest.fixture
def case(spark, payments):
    """Members, payments and usage of a few edge cases."""

    def make(tx, usage):
        logs = spark.createDataFrame(
            [(u, day(d), *plays, 1, secs) for u, d, plays, secs in usage] or [(99, day(0), 0, 0, 0, 0, 0, 0, 0.0)],
            LOG_SCHEMA,
        )
        seq = sequence_table(payments(tx))
        users = sorted({t[0] for t in tx})
        members = spark.createDataFrame([(u, day(-60)) for u in users], "user_id long, registration_init_time date")
        labels = spark.createDataFrame([(u, 0) for u in users], "user_id long, is_churn long")
        members = membership.attach_label(membership.last_txn_in_window(members, seq, WINDOW), labels)
        return members, seq, logs

    return make


def composed(members, seq, logs, fill=0.0):
    last_txn = features.user_last_txn(members, seq)
    usage = features.logs_in_membership(logs, last_txn)
    history = features.membership_history(members, seq)
    return features.ml_features(
        members,
        features.user_logs_features(last_txn, usage, fill=fill),
        features.transactions_features(last_txn, history, seq),
        features.members_features(members, seq),
    )


PLAYS = (1, 0, 0, 0, 3)


def test_user_without_usage(case):
    data = case([(1, 40, 70, 0, 30)], [])
    row = features.feature_table(*data).collect()[0]
    assert row.log_term_min == row.log_term_max == row.log_term_avg == row.log_term_median == 1.0
    assert row.num_25_avg == row.log_acc == row.log_std == row.num_25_ratio == 0.0
    assert row.registration_dur == pytest.approx(130 / 30)


def test_one_log_counts_both_edges(case):
    row = features.feature_table(*case([(1, 40, 70, 0, 30)], [(1, 50, PLAYS, 7200.0)])).collect()[0]
    assert row.log_term_min == pytest.approx(10 / 30)
    assert row.log_term_max == pytest.approx(20 / 30)
    assert row.log_term_median == pytest.approx(15 / 30)
    assert row.log_term_avg == pytest.approx(15 / 30)
    assert (row.log_std, row.max_ratio, row.total_hours_avg) == (0.0, 0.0, pytest.approx(2 / 30))
    assert (row.num_25_ratio, row.num_100_ratio) == (0.25, 0.75)


def test_window_borders(case):
    usage = [(1, 39, PLAYS, 3600.0), (1, 40, PLAYS, 3600.0), (1, 69, PLAYS, 3600.0), (1, 70, PLAYS, 3600.0)]
    members, seq, logs = case([(1, 40, 70, 0, 30)], usage)
    inside = features.logs_in_membership(logs, features.user_last_txn(members, seq))
    assert rows_of(inside, "date", "days_before_expire") == [(day(40), 30), (day(69), 1)]
    row = features.feature_table(members, seq, logs).collect()[0]
    assert row.week_1 == 1.0
    assert row.log_acc == pytest.approx(0.5)


def test_all_silent_plays(case):
    usage = [(1, 45, (0, 0, 0, 0, 0), 0.0), (1, 52, (0, 0, 0, 0, 0), 0.0)]
    row = features.feature_table(*case([(1, 40, 70, 0, 30)], usage)).collect()[0]
    assert (row.num_25_ratio, row.max_ratio, row.log_acc, row.week_day_ratio) == (0.0, 0.0, 0.0, 0.0)
    kept = features.feature_table(*case([(1, 40, 70, 0, 30)], usage), fill=None).collect()[0]
    assert (kept.num_25_ratio, kept.week_day_ratio, kept.num_25_avg) == (None, None, 0.0)


def test_several_rows_on_one_day_are_zero_gaps(case):
    days = [45, 45, 45, 52, 52, 60]
    usage = [(1, d, PLAYS, 600.0) for d in days]
    row = features.feature_table(*case([(1, 40, 70, 0, 30)], usage)).collect()[0]
    gaps = [5, 10] + [b - a for a, b in zip(days, days[1:])]
    assert row.log_term_min == 0.0
    assert row.log_term_max == pytest.approx(max(gaps) / 30)
    assert row.log_term_avg == pytest.approx(statistics.mean(gaps) / 30)
    assert row.log_term_median == pytest.approx(statistics.median(gaps) / 30)
    assert row.log_days_ratio == pytest.approx(3 / 30)


@pytest.mark.parametrize("expire", [60, 58])
def test_period_of_zero_or_less(case, expire):
    tx = [(1, 55, 61, 0, 30), (1, 60, expire, 1, 30), (1, 61, expire, 1, 30)]
    members, seq, logs = case(tx, [(1, 59, PLAYS, 60.0), (1, 60, PLAYS, 60.0)])
    row = features.feature_table(members, seq, logs).collect()[0]
    assert row.log_term_avg == pytest.approx((expire - 61) / 30)
    assert (row.num_25_avg, row.last_is_cancel) == (0.0, 1)
    assert rows_of(composed(members, seq, logs)) == rows_of(features.feature_table(members, seq, logs))


def test_cancel_takes_the_plan_before_it(case):
    tx = [(1, 0, 30, 0, 31), (1, 25, 115, 0, 90), (1, 60, 90, 1, 30), (1, 70, 80, 1, 7)]
    members, seq, logs = case(tx, [])
    row = features.feature_table(members, seq, logs).collect()[0]
    assert row.last_is_cancel == 1
    assert row.payment_plan_months == 1.0
    assert (row.tx_seq_length, row.cancel_exist, row.had_churn) == (3, 1, 0)
    assert row.membership_months == pytest.approx(115 / 30)
    assert row.actual_plan_months == pytest.approx((80 - 60) / 30)


def test_member_without_its_payment_keeps_a_row(case, spark):
    members, seq, logs = case([(1, 40, 70, 0, 30), (2, 40, 70, 0, 30)], [])
    lone = features.feature_table(members, seq.where("user_id = 1"), logs)
    assert rows_of(lone, "user_id", "had_churn", "num_25_avg") == [(1, 0, 0.0), (2, None, None)]


def test_fused_table_equals_composed_operators(spark):
    from checks.world import World

    w = World(spark, SF_CHECK)
    columns = ("user_id", *[c for c in features.FEATURES])
    fused = {r[0]: r[1:] for r in rows_of(w.ml, *columns)}
    single = {r[0]: r[1:] for r in rows_of(composed(w.members5, w.seq, w.logs), *columns)}
    assert fused.keys() == single.keys()
    for user, values in fused.items():
        assert values == pytest.approx(single[user], abs=1e-9), user


def test_prefix_buckets_do_not_change_the_history(case, monkeypatch):
    tx = [(1, 5 * n, 5 * n + 20, 1 if n == 3 else 0, 30) for n in range(15)]
    members, seq, logs = case(tx, [])
    whole = rows_of(features.membership_history(members, seq)), rows_of(features.feature_table(members, seq, logs))
    monkeypatch.setattr(features, "POSITIONS_PER_BUCKET", 4)
    assert whole == (
        rows_of(features.membership_history(members, seq)), rows_of(features.feature_table(members, seq, logs)),
    )


def test_daily_usage_first_changes_nothing(case):
    usage = [(1, d, PLAYS, 600.0 * d) for d in (45, 45, 52, 60, 60, 61)]
    members, seq, logs = case([(1, 40, 70, 0, 30)], usage)
    last_txn = features.user_last_txn(members, seq)
    raw = features.usage_profile(features.logs_in_membership(logs, last_txn)).collect()[0]
    reduced = features.usage_profile(
        features.logs_in_membership(features.daily_usage(logs), last_txn)
    ).collect()[0]
    assert list(reduced) == pytest.approx(list(raw))


def test_weekday_modes(case, spark):
    # day(45) is Monday 2016-02-15, day(50) Saturday.
    usage = [(1, 45, PLAYS, 3600.0), (1, 50, PLAYS, 3600.0)]
    data = case([(1, 40, 70, 0, 30)], usage)
    documented = features.feature_table(*data).collect()[0].week_day_ratio
    executed = features.feature_table(*data, weekday_mode="as_executed").collect()[0].week_day_ratio
    assert (documented, executed) == (0.5, 0.5)
    monday_only = case([(1, 40, 70, 0, 30)], usage[:1])
    assert features.feature_table(*monday_only).collect()[0].week_day_ratio == 1.0
    assert features.feature_table(*monday_only, weekday_mode="as_executed").collect()[0].week_day_ratio == 0.0


def test_checklist_on_the_training_table(spark, tmp_path):
    from checks.world import World

    w = World(spark, SF_CHECK)
    result = training_run(
        {"members_merge": w.members5, "transactions_seq": w.seq, "user_logs_merge": w.logs}, str(tmp_path)
    )
    table = result["ml_features"]
    assert len(table.columns) == 33
    members = w.members5.where("last_expire_date is not null")
    assert table.count() == table.select("user_id").distinct().count() == members.count()
    assert table.where("registration_dur < 0").isEmpty()
    ratios = ("log_days_ratio", "week_day_ratio", "log_acc", "num_25_ratio", "num_100_ratio")
    assert table.where(" or ".join(f"not {c} between 0 and 1" for c in ratios)).isEmpty()
    assert table.where("log_term_min > log_term_median or log_term_median > log_term_max").isEmpty()
    labels = {r.is_churn: r["count"] for r in members.groupBy("is_churn").count().collect()}
    assert {r.is_churn: r.cnt for r in result["validation_labels"].collect()} == labels
    assert rows_of(spark.read.parquet(str(tmp_path / "ml_features.parquet"))) == rows_of(table)


# --- daily layer ---


def test_grid_covers_every_user_and_day(spark):
    logs = spark.createDataFrame([(1, day(3), 5, 2.5), (2, day(99), 7, 1.0)], "user_id long, date date, n long, x double")
    grid = daily.dense_daily_grid(logs, str(day(2)), str(day(4)), base_date=str(day(0)))
    assert rows_of(grid, "user_id", "date_idx", "n", "x") == [
        (1, 2, 0, 0.0), (1, 3, 5, 2.5), (1, 4, 0, 0.0), (2, 2, 0, 0.0), (2, 3, 0, 0.0), (2, 4, 0, 0.0),
    ]


def test_forward_fill_stops_at_the_carried_expiry(spark):
    rows = [(1, day(0), None, None, None), (1, day(1), day(1), 30, day(3)), (1, day(2), None, None, None), (1, day(3), None, None, None)]
    df = spark.createDataFrame(
        rows, "user_id long, date date, transaction_date date, plan long, membership_expire_date date"
    )
    on = daily.ffill_transactions(df, ["plan"])
    assert [r.plan for r in on.orderBy("date").collect()] == [None, 30, 30, 30]
    stopped = daily.ffill_transactions(df, ["plan"], stop_at_expiry=True)
    assert [r.plan for r in stopped.orderBy("date").collect()] == [None, 30, 30, None]


def test_date_floor_keeps_null(spark):
    df = spark.createDataFrame([(day(1),), (day(5),), (None,)], "d date")
    assert rows_of(daily.clip_date_floor(df, "d", str(day(3)))) == rows_of(
        spark.createDataFrame([(day(3),), (day(5),), (None,)], "d date")
    )


def test_recent_activity_upper_bound(spark):
    logs = spark.createDataFrame([(1, day(d), 1.0) for d in (0, 40, 59, 60, 61)], "user_id long, date date, total_hours double")
    assert daily.recent_activity(logs, str(day(60))).collect()[0].active_days_30d == 4
    assert daily.recent_activity(logs, str(day(60)), until=str(day(60))).collect()[0].active_days_30d == 2


def test_grid_keeps_nulls_of_recorded_rows(spark):
    df = spark.createDataFrame([(1, day(0), None, 3), (2, day(1), 5.0, None)], "user_id long, date date, total_secs double, num_25 long")
    got = daily.dense_daily_grid(df, str(day(0)), str(day(1)))
    assert rows_of(got, "user_id", "date", "total_secs", "num_25") == [
        (1, day(0), None, 3), (1, day(1), 0.0, 0), (2, day(0), 0.0, 0), (2, day(1), 5.0, None),
    ]


def test_forward_fill_starts_with_the_payment_before_the_first_day(spark, payments):
    paid = payments([(1, -20, -5, 0, 15), (1, -12, 18, 0, 30), (1, 3, 40, 0, 60), (2, 9, 20, 0, 7)])
    grid = spark.createDataFrame([(u, day(d)) for u in (1, 2) for d in range(5)], "user_id long, date date")
    joined = daily.daily_logs_with_transactions(grid, paid)
    for hot in (None, 2):
        got = daily.ffill_transactions(joined, ["payment_plan_days"], payments=paid, hot_rows=hot).orderBy("user_id", "date")
        assert [r.payment_plan_days for r in got.collect()] == [30, 30, 30, 60, 60] + [None] * 5


def test_usage_is_pruned_before_it_moves(spark, tmp_path):
    """The scan gets the days that memberships cover, and only their users' usage is exchanged."""
    from tenura.sources import star_schema
    from tests.conftest import SF_SMALL
    from checks.world import World

    world = World(spark, SF_SMALL)
    star_schema.user_logs(spark, SF_SMALL).write.parquet(str(tmp_path / "logs"))
    logs = spark.read.parquet(str(tmp_path / "logs"))
    table = features.feature_table(world.members5, world.seq, logs)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date," in plan and "LessThan(date," in plan
    assert "LeftSemi" in plan
    assert rows_of(table) == rows_of(world.ml)


def test_unfolded_days_are_not_broadcast(spark, tmp_path):
    """A stored window is small, its days are not: with the usual threshold the join on them still sorts and merges."""
    spark.createDataFrame(
        [(u, day(0), day(300), 300) for u in range(40)],
        "user_id long, log_start_date date, log_end_date date, membership_period long",
    ).write.parquet(str(tmp_path / "last"))
    spark.createDataFrame([(u, day(7), *PLAYS, 1, 60.0) for u in range(50)], LOG_SCHEMA).write.parquet(str(tmp_path / "logs"))
    last, logs = (spark.read.parquet(str(tmp_path / n)) for n in ("last", "logs"))
    found = features.logs_in_membership(features.daily_usage(logs), last)
    assert "BroadcastHashJoin" not in plan(found) and "SortMergeJoin" in plan(found)
    assert rows_of(found, "user_id", "days_before_expire") == sorted([(u, 293) for u in range(40)], key=repr)


def test_tables_of_users_are_not_broadcast(spark):
    """Small files of members, payments and usage are many rows in the driver: with the usual threshold all are merged."""
    from checks.world import World

    world = World(spark, SF_CHECK)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) == 10 << 20
    snapshot, table = features.payment_snapshot(world.members5, world.seq), world.ml
    assert "Broadcast" not in plan(snapshot) and "Broadcast" not in plan(table)
    assert "LeftSemi" in plan(table)
