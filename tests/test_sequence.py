import pytest

from tenura.operators import membership, sequence
from tenura.plans.preprocess import sequence_table
from tests.conftest import day, rows_of

PLACE = ("transaction_date", "sequence_group_id", "sequence_id")


def places(df):
    return [r[1:] for r in rows_of(df, *PLACE)]


def test_single_payment(payments):
    row = sequence.sessionize_transactions(payments([(1, 0, 30, 0, 30)])).collect()[0]
    assert (row.sequence_group_id, row.sequence_id) == (0, 0)
    assert (row.before_transaction_term, row.before_membership_expire_term) == (-1, -1)
    assert row.is_churn == 1


@pytest.mark.parametrize("gap, group", [(30, 0), (31, 1)])
def test_gap_limit_is_inclusive(payments, gap, group):
    seq = sequence.sessionize_transactions(payments([(1, 0, 30, 0, 30), (1, 30 + gap, 60 + gap, 0, 30)]))
    last = rows_of(seq, *PLACE)[-1]
    assert last[1:] == (group, 0 if group else 1)


def test_terms_cross_group_borders(payments):
    seq = sequence.sessionize_transactions(payments([(1, 0, 30, 0, 30), (1, 100, 130, 0, 30)]))
    assert rows_of(seq, "before_transaction_term", "before_membership_expire_term") == [(-1, -1), (100, 70)]


def test_churn_flag_against_the_cutoff(payments):
    tx = payments([(1, 0, 30, 0, 30), (1, 20, 60, 0, 30), (1, 120, 150, 0, 30)])
    late = sequence.sessionize_transactions(tx, cutoff_date=str(day(179)))
    assert [r[1] for r in rows_of(late, "transaction_date", "is_churn")] == [0, 1, -1]
    assert [r[1] for r in rows_of(sequence.sessionize_transactions(tx, cutoff_date=str(day(180))), "transaction_date", "is_churn")] == [0, 1, 1]


def test_ties_on_both_dates_give_contiguous_positions(payments):
    seq = sequence.sessionize_transactions(payments([(1, 0, 30, 0, 30), (1, 0, 30, 0, 60), (1, 0, 30, 0, 30)]))
    assert sorted(r.sequence_id for r in seq.collect()) == [0, 1, 2]
    by_plan = {r.sequence_id: r.payment_plan_days for r in seq.collect()}
    assert by_plan == {0: 30, 1: 30, 2: 60}


def test_positions_are_contiguous_per_group(spark):
    from pyspark.sql import functions as F

    from tenura.sources import star_schema
    from tests.conftest import SF_CHECK

    seq = sequence_table(star_schema.transactions(spark, SF_CHECK))
    groups = seq.groupBy("user_id", "sequence_group_id").agg(
        F.count("*").alias("n"), F.min("sequence_id").alias("lo"), F.max("sequence_id").alias("hi")
    )
    assert groups.where("lo <> 0 or hi <> n - 1").isEmpty()
    users = groups.groupBy("user_id").agg(F.count("*").alias("n"), F.max("sequence_group_id").alias("hi"))
    assert users.where("hi <> n - 1").isEmpty()


def test_actual_plan_days(payments):
    tx = payments([(1, 0, 30, 0, 30), (1, 20, 60, 0, 30), (1, 25, 40, 1, 30), (1, 90, 120, 0, 30)])
    got = sequence.add_actual_plan_days(sequence.sessionize_transactions(tx))
    assert [r[1] for r in rows_of(got, "transaction_date", "actual_plan_days")] == [30, 30, -20, 30]


def test_fused_table_equals_single_operators(spark):
    from tenura.sources import star_schema
    from tests.conftest import SF_SMALL

    tx = star_schema.transactions(spark, SF_SMALL)
    single = sequence.add_actual_plan_days(sequence.sessionize_transactions(tx))
    assert rows_of(single) == rows_of(sequence_table(tx).select(*single.columns))


def test_cluster_by_user_keeps_rows(payments):
    seq = sequence_table(payments([(2, 0, 30, 0, 30), (1, 5, 35, 0, 30), (1, 0, 30, 0, 30)]))
    assert [r.user_id for r in sequence.cluster_by_user(seq).collect()] == [1, 1, 2]


# --- reference membership ---

MEMBERS = "user_id long, registration_init_time date"


@pytest.fixture
def members(spark):
    return lambda *users: spark.createDataFrame([(u, day(-100)) for u in users], MEMBERS)


WINDOW = (str(day(50)), str(day(80)))
FOUND = ("user_id", "last_expire_date", "last_seq_id", "p_tx_id", "pp_tx_id")


def test_last_txn_takes_the_latest_expiry_in_the_window(payments, members):
    seq = sequence_table(payments([(1, 0, 30, 0, 30), (1, 25, 60, 0, 30), (1, 40, 75, 0, 30), (1, 60, 200, 0, 90)]))
    got = membership.last_txn_in_window(members(1, 2), seq, WINDOW)
    assert rows_of(got, *FOUND) == [(1, day(75), 0, 2, 1), (2, None, None, None, None)]


def test_later_cancel_in_the_window_overrides(payments, members):
    seq = sequence_table(payments([(1, 25, 75, 0, 30), (1, 52, 55, 1, 30), (1, 53, 54, 1, 30)]))
    got = membership.last_txn_in_window(members(1), seq, WINDOW)
    assert rows_of(got, *FOUND) == [(1, day(54), 0, 2, 1)]


def test_cancel_before_the_latest_expiry_does_not_override(payments, members):
    seq = sequence_table(payments([(1, 25, 55, 0, 30), (1, 30, 52, 1, 30), (1, 40, 70, 0, 30)]))
    got = membership.last_txn_in_window(members(1), seq, WINDOW)
    assert rows_of(got, *FOUND) == [(1, day(70), 0, 2, 1)]


def test_first_position_has_no_previous(payments, members):
    seq = sequence_table(payments([(1, 30, 60, 0, 30)]))
    assert rows_of(membership.last_txn_in_window(members(1), seq, WINDOW), *FOUND) == [(1, day(60), 0, 0, None)]


def test_seq_info_falls_back_from_a_cancel(payments, spark):
    tx = [(1, 0, 30, 0, 30), (1, 20, 50, 0, 30), (1, 22, 45, 1, 30), (2, 0, 20, 1, 30), (3, 0, 30, 0, 30)]
    seq = sequence_table(payments(tx))
    given = spark.createDataFrame([(1, day(45)), (2, day(20)), (3, None), (4, day(9))], "user_id long, last_expire date")
    info = membership.membership_seq_info(given, seq)
    wanted = [(1, 0, 1), (2, 0, 0), (3, None, None), (4, None, None)]
    assert rows_of(info, "user_id", "membership_seq_group_id", "membership_seq_id") == wanted
    durations = membership.membership_durations(info, seq)
    columns = ("user_id", "previous_membership_duration", "previous_membership_seq_duration")
    assert rows_of(durations, *columns) == [(1, 25, 45), (2, 20, 20), (3, None, None), (4, None, None)]


def test_attach_label_keeps_unmatched_members(members, spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (9, 1)], "user_id long, is_churn long")
    assert rows_of(membership.attach_label(members(1, 2), labels), "user_id", "is_churn") == [(1, 1), (2, None)]


def test_null_dates_do_not_start_groups(spark):
    """The first payment is known by its place; NULL dates come last and open no group."""
    from tests.conftest import TX_SCHEMA

    rows = [(1, 1, 30, 150, 150, 1, None if t is None else day(t), day(e), 0) for t, e in ((None, 30), (30, 59), (59, 90))]
    got = sequence.sessionize_transactions(spark.createDataFrame(rows, TX_SCHEMA)).orderBy("membership_expire_date").collect()
    assert [(r.sequence_group_id, r.sequence_id, r.before_transaction_term) for r in got] == [(0, 2, None), (0, 0, -1), (0, 1, 29)]
