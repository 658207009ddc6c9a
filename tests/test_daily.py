from __future__ import annotations

import random
from datetime import timedelta

import pytest

from tenura.operators import daily
from tests.conftest import TX_SCHEMA, day, rows_of
from tests.test_plans import plan, shuffled  # noqa: F401


def held(rows, first, last, stop):
    """The payment of each user and day by looking at all of them."""
    out = []
    for user in {r[0] for r in rows}:
        for n in range(first, last + 1):
            paid = [r for r in rows if r[0] == user and r[1] is not None and r[1] <= n]
            if paid:
                best = max(paid, key=lambda r: r[1:])
                if not stop or n < best[2]:
                    out.append((user, day(n), best[4]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("stop", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 6])
def test_payments_of_each_day(payments, stop, hot_rows):
    rng = random.Random(6)
    rows = [(rng.randint(1, 8), t, t + rng.randint(-5, 25), rng.randint(0, 1), i) for i, t in enumerate(rng.choices(range(60), k=90))]
    # Equal up to the plan days, which come last of what differs.
    tx = payments(rows)
    got = daily.daily_payments(tx, str(day(20)), str(day(41)), ["payment_plan_days"], stop_at_expiry=stop, hot_rows=hot_rows)
    assert rows_of(got, *got.columns) == held(rows, 20, 41, stop)


def test_no_days_outside_the_range(payments):
    tx = payments([(1, 0, 10, 0, 30), (1, 5, 9, 0, 31), (1, 5, 9, 0, 32), (2, 50, 60, 0, 33)])
    for stop in (False, True):
        assert daily.daily_payments(tx, str(day(30)), str(day(29)), ["is_cancel"], stop_at_expiry=stop).count() == 0
    spans = daily.payment_intervals(tx)
    assert rows_of(spans, "user_id", "payment_plan_days", "valid_from", "valid_to") == [
        (1, 30, day(0), day(5)), (1, 32, day(5), None), (2, 33, day(50), None)
    ]
    assert daily.payment_intervals(tx.limit(0)).count() == 0


def test_null_dates_never_hold(spark):
    tx = spark.createDataFrame([(1, 1, 30, 5, 5, 1, None, day(9), 0), (1, 1, 31, 5, 5, 1, day(3), None, 0)], TX_SCHEMA)
    got = daily.daily_payments(tx, str(day(2)), str(day(4)), ["payment_plan_days"])
    assert rows_of(got, *got.columns) == [(1, day(3), 31), (1, day(4), 31)]
    assert daily.daily_payments(tx, str(day(2)), str(day(4)), ["payment_plan_days"], stop_at_expiry=True).count() == 0


def test_forward_fill_reads_the_days_once(spark, shuffled, payments, tmp_path):  # noqa: F811
    tx = payments([(u, t, t + 20, 0, 30 + t) for u in range(5) for t in (1, 9, 30)])
    days = spark.createDataFrame([(u, day(n)) for u in range(6) for n in range(5, 40)], "user_id long, date date")
    daily.daily_logs_with_transactions(days, tx).write.parquet(str(tmp_path / "daily"))
    tx.write.parquet(str(tmp_path / "tx"))
    stored, paid = (spark.read.parquet(str(tmp_path / n)) for n in ("daily", "tx"))
    filled = daily.ffill_transactions(stored, ["payment_plan_days"], payments=paid)
    text = plan(filled)
    assert sum("daily" in line for line in text.splitlines() if "FileScan" in line) == 1
    assert text.count("Exchange ") == 1
    by_interval = daily.daily_payments(paid, str(day(5)), str(day(39)), ["payment_plan_days"])
    got = [r for r in rows_of(filled, "user_id", "date", "payment_plan_days") if r[2] is not None]
    assert got == rows_of(by_interval, "user_id", "date", "payment_plan_days") and len(got) == 5 * 35
    assert {r[1] for r in rows_of(filled, "user_id", "date")} == {day(5) + timedelta(days=n) for n in range(35)}
