"""Hot keys take another path to the same values."""

import random

import pytest
from pyspark.sql import functions as F

from tenura.functions.ordered import Lag, Lead, RunLast, RunMax, RunSum, hot_keys, ordered
from tenura.functions.placement import dense_index, exact_median, exact_percentiles
from tenura.operators import cohort, daily, reports, sequence
from tenura.plans.preprocess import sequence_table
from tenura.sources import star_schema
from tests.conftest import SF_SMALL, day, rows_of


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small test data would be merged into one partition, hence one slice."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def steps(rows):
    rows = rows.add(
        lag1=Lag("v"), lag2=Lag("v", 2), nxt=Lead("v"), total=RunSum("v"), top=RunMax("v"), known=RunLast("w")
    )
    rows = rows.derive(changed=F.when(F.col("lag1") != F.col("v"), 1).otherwise(0))
    return rows.add(changes=RunSum("changed"))


@pytest.fixture(scope="module")
def skewed(spark):
    """One user with most of the rows, many of them equal; gaps in one column; NULL order values, which come last."""
    rng = random.Random(7)
    rows = [(1, rng.randrange(40), rng.randrange(9), rng.choice([None, 1, 2])) for _ in range(900)]
    rows += [(1, 5, 3, 2)] * 400 + [(1, None, 4, None)] * 5
    rows += [(u, rng.randrange(40), rng.randrange(9), rng.choice([None, 1])) for u in range(2, 60) for _ in range(6)]
    return spark.createDataFrame(rows, "k long, t long, v long, w long").repartition(7)


def test_sliced_path_equals_plain_path(skewed):
    order = ("t", "v", "w")
    plain = ordered(skewed, "k", order, steps, hot_rows=None)
    sliced = ordered(skewed, "k", order, steps, hot_rows=100)
    assert rows_of(plain) == rows_of(sliced)


def test_every_key_hot(skewed):
    order = ("t", "v", "w")
    plain = ordered(skewed, "k", order, steps, hot_rows=None)
    assert rows_of(plain) == rows_of(ordered(skewed, "k", order, steps, hot_rows=1))


def test_any_number_of_keys_may_be_hot(spark):
    """More hot keys than fit a short list, each split, none left in a plain window."""
    rows = spark.range(0, 60_000, 1, 8).select(
        (F.col("id") % 12_000).alias("k"), (F.col("id") % 7).alias("t"), (F.col("id") % 11).alias("v"),
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("w"),
    )
    assert hot_keys(rows, ["k"], hot_rows=4).count() == 12_000
    plain = ordered(rows, "k", ("t", "v", "w"), steps, hot_rows=None)
    assert rows_of(plain) == rows_of(ordered(rows, "k", ("t", "v", "w"), steps, hot_rows=4))


def test_keys_are_counted_on_the_table_given(skewed):
    few = skewed.where("k <> 1")
    order = ("t", "v", "w")
    plain = ordered(skewed, "k", order, steps, hot_rows=None)
    assert rows_of(plain) == rows_of(ordered(skewed, "k", order, steps, hot_rows=5, counted=few))


def test_hot_rows_are_spread_over_slices(spark):
    """Equal rows of one user do not end up in one slice."""
    from tenura.functions.ordered import _sliced

    copies = spark.range(0, 20000, 1, 8).select(F.lit(1).alias("k"), F.lit(1).alias("t"))
    slices = _sliced(copies, ("k",), ("t",)).df.groupBy("_slice").count().collect()
    assert len(slices) > 1
    assert max(r["count"] for r in slices) < 0.6 * 20000


@pytest.mark.parametrize(
    "operator",
    [
        lambda tx, hot: sequence.sessionize_transactions(tx, hot_rows=hot),
        lambda tx, hot: sequence.add_actual_plan_days(sequence.sessionize_transactions(tx, hot_rows=hot), hot_rows=hot),
        lambda tx, hot: sequence_table(tx, hot_rows=hot),
        lambda tx, hot: cohort.with_previous(tx, hot_rows=hot),
        lambda tx, hot: reports.cancel_streaks(sequence_table(tx), hot_rows=hot),
        lambda tx, hot: reports.expire_decreases(sequence_table(tx), hot_rows=hot),
    ],
)
def test_operators_do_not_depend_on_the_split(spark, operator):
    tx = star_schema.transactions(spark, SF_SMALL)
    assert rows_of(operator(tx, None)) == rows_of(operator(tx, 11))


def test_forward_fill_does_not_depend_on_the_split(spark):
    paid = lambda u, d: d % 5 == u
    rows = [
        (u, day(d), day(d) if paid(u, d) else None, d if paid(u, d) else None) for u in range(4) for d in range(40)
    ]
    df = spark.createDataFrame(rows, "user_id long, date date, transaction_date date, payment_plan_days long")
    plain = daily.ffill_transactions(df, ["payment_plan_days"], hot_rows=None)
    assert rows_of(plain) == rows_of(daily.ffill_transactions(df, ["payment_plan_days"], hot_rows=10))
    first = plain.where("user_id = 0").orderBy("date").limit(6).collect()
    assert [r.payment_plan_days for r in first] == [0, 0, 0, 0, 0, 5]


def test_dense_index_is_a_bijection_in_key_order(spark):
    keys = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    got = dense_index(keys, "k", "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(5000))
    assert [r.k for r in got] == sorted(r.k for r in got)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0, 1.0, 1.0, 9.0, 7.5], [2.0] * 50 + [float(n) for n in range(31)]])
def test_exact_percentiles(spark, values):
    import numpy

    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    fractions = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r.fraction: r.value for r in exact_percentiles(df, "x", fractions).collect()}
    assert got == pytest.approx({p: numpy.percentile(values, 100 * p) for p in fractions})


def test_median_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_median(df, "x").collect()[0].median is None
