import pytest
from pyspark.sql import functions as F

from tenura.operators import cohort, transform
from tenura.plans.preprocess import PREVIOUS_COLUMNS, exclude, preprocess, sequence_table
from tenura.sources import star_schema
from tests.conftest import SF_CHECK, SF_SMALL, day, rows_of
from tests.test_plans import plan


@pytest.fixture
def users(spark):
    return lambda *ids: spark.createDataFrame([(i,) for i in ids], "user_id long")


def ids(df):
    return sorted(r.user_id for r in df.select("user_id").collect() if r.user_id is not None)


def test_common_users_ignore_null_and_duplicates(users):
    tables = {"a": users(1, 2, 2, None), "b": users(2, 3, None), "c": users(2, 2, 1)}
    assert ids(cohort.common_users(tables)) == [2]
    kept = cohort.keep_common_users(tables)
    assert ids(kept["a"]) == [2, 2]
    assert ids(kept["c"]) == [2, 2]


def test_presence_flags(users, spark):
    logs = spark.createDataFrame([(1, 5.0), (1, None), (2, 3.0)], "user_id long, x double")
    seen = cohort.table_presence({"a": users(1, 3), "logs": logs}, flags={"logs": F.col("x").isNull()})
    assert rows_of(seen, "user_id", "in_all", "flag_logs") == [(1, True, True), (2, False, False), (3, False, False)]


def test_common_users_need_two_tables_and_a_user(users):
    with pytest.raises(ValueError, match="two tables"):
        cohort.common_users({"a": users(1)})
    with pytest.raises(ValueError, match="no user in common"):
        cohort.keep_common_users({"a": users(1), "b": users(2)}, require_nonempty=True)


def test_empty_exclusion_set_changes_nothing(users, payments):
    tables = {"a": users(1, 2)}
    tx = payments([(1, 0, 30, 0, 30)])
    assert ids(cohort.drop_same_day_duplicates(tables, tx)["a"]) == [1, 2]
    assert ids(cohort.drop_consecutive_cancels(tables, tx)["a"]) == [1, 2]


def test_tables_without_the_key_pass_through(users, spark):
    other = spark.createDataFrame([(1,)], "n long")
    assert cohort.keep_users({"o": other}, users(1))["o"] is other


def test_duplicates_count_non_cancels_only(payments):
    tx = payments([(1, 0, 30, 0, 30), (1, 0, 40, 1, 30), (2, 0, 30, 0, 30), (2, 0, 60, 0, 60), (3, 0, 1, 0, 7)])
    assert ids(cohort.same_day_duplicate_users(tx)) == [2]
    assert ids(cohort.same_day_duplicate_users(tx, min_txn_count=1)) == [1, 2, 3]


def test_look_back_rules(payments):
    tx = payments(
        [
            (1, 10, 40, 0, 30), (1, 20, 5, 1, 30),  # expires before the previous payment
            (2, 0, 30, 0, 30), (2, 10, 60, 0, 30), (2, 20, 29, 1, 30),  # below the expiry two back
            (3, 0, 30, 1, 30), (3, 10, 60, 1, 30),  # two cancels in a row
            (4, 0, 30, 1, 30), (4, 1, 60, 0, 30), (4, 2, 59, 1, 30),
        ]
    )
    assert ids(cohort.cancel_before_prev_txn_users(tx)) == [1]
    assert ids(cohort.cancel_before_prev2_expire_users(tx)) == [2]
    assert ids(cohort.consecutive_cancel_users(tx)) == [3]


def test_plan_days_bounds_differ_by_flag(spark):
    seq = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (3, 1, -31), (4, 1, -32), (5, 0, 411), (6, 1, 411)], "user_id long, is_cancel long, actual_plan_days long")
    assert ids(cohort.plan_days_out_of_range_users(seq)) == [1, 4, 5, 6]
    assert ids(cohort.plan_days_out_of_range_users(seq, cohort.PIPELINE_PLAN_DAYS_BOUNDS)) == [1, 5, 6]


def test_impact_and_removed_sample(users):
    before, after = {"a": users(1, 1, 2, 3)}, {"a": users(1, 1)}
    row = cohort.filter_impact(before, after).collect()[0].asDict()
    assert (row["rows_before"], row["rows_after"], row["rows_removed"]) == (4, 2, 2)
    assert (row["users_before"], row["users_after"], row["users_removed"]) == (3, 1, 2)
    assert set(ids(cohort.removed_sample(before["a"], after["a"]))) == {2, 3}
    assert cohort.removed_sample(before["a"], after["a"], 1).count() == 1
    empty = cohort.filter_impact({"a": users()}, {"a": users()}).collect()[0]
    assert (empty.rows_before, empty.pct_users_removed) == (0, None)


def test_fused_filters_equal_sequential_filters(spark):
    tx, logs = star_schema.transactions(spark, SF_CHECK), star_schema.user_logs(spark, SF_CHECK)
    usage = transform.nullify_out_of_range(logs, "total_secs", 0, 86400)
    seq, flags = exclude(tx, cohort.null_usage_users(usage))
    counts = {r.step_name: r.user_count for r in cohort.exclusion_counts(flags).collect()}
    tables = {"tx": tx, "usage": usage, "seq": seq.drop(*PREVIOUS_COLUMNS)}
    rules = (
        ("same_day_duplicates", lambda t: cohort.same_day_duplicate_users(t["tx"])),
        ("null_usage", lambda t: cohort.null_usage_users(t["usage"])),
        ("expire_year_out_of_range", lambda t: cohort.expire_year_out_of_range_users(t["tx"])),
        (
            "plan_days_out_of_range",
            lambda t: cohort.plan_days_out_of_range_users(t["seq"], cohort.PIPELINE_PLAN_DAYS_BOUNDS),
        ),
        ("cancel_before_prev_txn", lambda t: cohort.cancel_before_prev_txn_users(t["seq"])),
        ("cancel_before_prev2_expire", lambda t: cohort.cancel_before_prev2_expire_users(t["seq"])),
        ("consecutive_cancels", lambda t: cohort.consecutive_cancel_users(t["seq"])),
    )
    for name, rule in rules:
        found = spark.createDataFrame([(i,) for i in ids(rule(tables))], "user_id long")
        assert found.count() == counts.get(name, 0), name
        tables = cohort.drop_users(tables, found)
    fused = cohort.drop_users({"tx": tx, "usage": usage}, flags)
    assert rows_of(fused["tx"]) == rows_of(tables["tx"])
    assert rows_of(fused["usage"]) == rows_of(tables["usage"])
    assert fused["tx"].select("user_id").distinct().count() == 215


def test_preprocess_needs_both_label_versions(spark):
    with pytest.raises(ValueError, match="raw_train_v1"):
        preprocess({})


def test_preprocess_tables_are_consistent(spark):
    from checks.world import World

    tables = preprocess(World(spark, SF_SMALL).raw_tables)
    members = ids(tables["members_merge"])
    assert len(members) == len(set(members)) > 0
    for name in ("train_merge", "transactions_merge", "transactions_seq", "user_logs_merge"):
        assert set(ids(tables[name])) == set(members), name
    assert dict(tables["members_merge"].dtypes)["registration_init_time"] == "date"
    assert dict(tables["members_merge"].dtypes)["gender"] == "int"
    assert tables["user_logs_merge"].where("total_secs is null").isEmpty()
    hours = tables["user_logs_merge"].where(F.abs(F.col("total_hours") * 3600 - F.col("total_secs")) > 1e-6)
    assert hours.isEmpty()
    assert tables["train_merge"].where("is_churn not in (0, 1)").isEmpty()


def test_null_usage_needs_nullified_time(spark):
    logs = spark.createDataFrame([(1, 90000.0), (2, 10.0)], "user_id long, total_secs double")
    assert ids(cohort.null_usage_users(logs)) == []
    assert ids(cohort.null_usage_users(transform.nullify_out_of_range(logs, "total_secs", 0, 86400))) == [1]


def test_expiry_years(payments):
    tx = payments([(1, 0, 30, 0, 30), (2, 0, 900, 0, 30), (3, 0, -400, 1, 30)])
    assert ids(cohort.expire_year_out_of_range_users(tx)) == [2, 3]
    assert day(900).year == 2018


def test_transition(spark):
    v1 = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 0)], "user_id long, is_churn long")
    v2 = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "user_id long, is_churn long")
    assert ids(cohort.transition_users(v1, v2)) == [1, 3]
    assert ids(cohort.transition_users(v1, v2, 0, [1])) == [1]
    kept = cohort.keep_churn_transition({"t": v1}, v1, v2, 1, (0, 1))
    assert ids(kept["t"]) == [2]


def test_sequence_table_carries_what_the_rules_need(payments):
    assert {*PREVIOUS_COLUMNS, "actual_plan_days", "plan_days_diff"} <= set(
        sequence_table(payments([(1, 0, 30, 0, 30)])).columns
    )


def test_more_tables_than_bits_in_a_long(spark):
    tables = {f"t{n}": spark.createDataFrame([(1,), (n + 10,)], "user_id long") for n in range(70)}
    assert [r.user_id for r in cohort.common_users(tables).collect()] == [1]
    del tables["t69"]
    tables["t69"] = spark.createDataFrame([(2,)], "user_id long")
    assert cohort.common_users(tables).count() == 0


@pytest.mark.parametrize(
    "drop, kept",
    [
        (cohort.drop_plan_days_out_of_range, {2, None}),
        (cohort.drop_cancel_before_prev_txn, {2, 3, None}),
        (cohort.drop_cancel_before_prev2_expire, {2, 3, None}),
        (cohort.drop_consecutive_cancels, {1, 2, 3, None}),
    ],
)
def test_dropped_users_are_found_once_for_all_tables(payments, spark, drop, kept):
    seq = payments([(1, 10, 40, 0, 30), (1, 35, 65, 0, 30), (1, 36, 20, 1, 30), (2, 10, 40, 0, 30), (3, 10, 600, 0, 30)])
    seq = sequence_table(seq).drop(*PREVIOUS_COLUMNS)
    ids = spark.createDataFrame([(u,) for u in (1, 2, 3, 3, None)], "user_id long")
    tables = drop({"seq": seq.select("user_id"), "ids": ids, "more": ids}, seq)
    # Rows of one table are not ordered again to find the users that it loses.
    assert all("Window" not in plan(tables[name]) for name in ("ids", "more"))
    assert {r.user_id for r in tables["ids"].collect()} == kept
    assert {r.user_id for r in tables["seq"].collect()} == kept - {None}
