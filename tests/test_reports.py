import numpy
import pytest

from tenura.functions.bins import DAY_GAP_BUCKETS, SIGN_BUCKETS, bucket_distribution, histogram
from tenura.operators import reports
from tenura.plans.preprocess import sequence_table
from tests.conftest import rows_of


def test_bucket_distribution_shares(spark):
    df = spark.createDataFrame([(1, -3), (1, 0), (2, 4), (2, 8), (3, None)], "user_id long, x long")
    got = bucket_distribution(df, "x", SIGN_BUCKETS).orderBy("bucket_no").collect()
    assert [(r.bucket, r.row_count, r.user_count) for r in got] == [("negative", 1, 1), ("zero", 1, 1), ("positive", 3, 2)]
    assert [r.pct_rows for r in got] == [20.0, 20.0, 60.0]
    assert got[2].pct_users == pytest.approx(200 / 3)


@pytest.mark.parametrize("value, bucket", [(7, "1-7"), (8, "8-30"), (365, "181-365"), (366, "> 365")])
def test_day_gap_edges(spark, value, bucket):
    df = spark.createDataFrame([(1, value)], "user_id long, x long")
    assert bucket_distribution(df, "x", DAY_GAP_BUCKETS).collect()[0].bucket == bucket


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 9.0, 10.0], [4.0, 4.0], list(range(101))])
def test_histogram_matches_equal_width_bins(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = histogram(df, "x", 10).orderBy("bin_no").collect()
    counts, edges = numpy.histogram(values, bins=10)
    assert [r["count"] for r in got] == list(counts)
    assert [r.lower for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_nothing(spark):
    assert histogram(spark.createDataFrame([(None,)], "x double"), "x").isEmpty()


def test_plan_days_category_with_null(spark):
    rows = [(1, 30), (1, 30), (2, 31), (3, 30), (3, 31), (4, 30), (4, 7), (5, 30), (5, None)]
    tx = spark.createDataFrame(rows, "user_id long, payment_plan_days long")
    wanted = [(1, "only_30"), (2, "only_31"), (3, "both_30_31"), (4, "other"), (5, "other")]
    assert rows_of(reports.plan_days_category(tx), "user_id", "category") == wanted


def test_transition_matrix_has_all_cells(spark):
    v1 = spark.createDataFrame([(1, 0)], "user_id long, is_churn long")
    v2 = spark.createDataFrame([(1, 0), (2, 1)], "user_id long, is_churn long")
    got = reports.label_transition_matrix(v1, v2)
    assert rows_of(got, "v1_churn", "v2_0", "v2_1", "v2_null") == [("0", 1, 0, 0), ("1", 0, 0, 0), ("NULL", 0, 1, 0)]
    assert {r.pct_0 for r in got.collect()} == {50.0, 0.0}


def test_streaks(payments):
    flags = [1, 1, 0, 1, 1, 1, 0, 1]
    tx = payments([(1, n, n + 30, c, 30) for n, c in enumerate(flags)])
    assert rows_of(reports.cancel_streaks(tx), "streak_length") == [(2,), (3,)]
    report = reports.cancel_streak_report(sequence_table(tx))
    assert rows_of(report["counts"], "consecutive_rows", "consecutive_users") == [(3, 1)]
    assert report["histories"].count() == 8


def test_reports_without_cases(payments):
    seq = sequence_table(payments([(1, 0, 30, 0, 30)]))
    for report in (reports.cancel_before_prev_txn_report, reports.cancel_before_prev2_expire_report):
        tables = report(seq)
        assert tables["counts"].collect()[0].anomaly_rows == 0
        assert tables["buckets"].isEmpty() and tables["histogram"].isEmpty()
        assert tables["gaps"].collect()[0].median_diff is None
    assert reports.expire_decrease_report(seq)["counts"].collect()[0].pct_rows == 0.0
    assert reports.cancel_plan_days_detail(seq)["summary"].collect()[0].mode_val is None


def test_correlation_settings(spark):
    rows = [(n, float(n), None if n == 3 else float(-n), 5) for n in range(12)]
    df = spark.createDataFrame(rows, "user_id long, a double, b double, c long")
    pairs = {(r.col_a, r.col_b): r for r in reports.correlation_pairs(df).collect()}
    assert set(pairs) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert pairs["a", "b"].r == pytest.approx(-1.0)
    assert pairs["a", "b"].n_rows == 11
    assert pairs["a", "c"].r is None or numpy.isnan(pairs["a", "c"].r)
    limited = reports.correlation_pairs(df, null_values={"a": {"min": 0, "max": 5}})
    assert limited.isEmpty()
    kept = reports.correlation_pairs(df, exclude=["USER_ID", "C"], null_handling="fillzero").collect()
    assert [(r.col_a, r.col_b, r.n_rows) for r in kept] == [("a", "b", 12)]
    with pytest.raises(ValueError):
        reports.correlation_pairs(df, exclude=["user_id", "a", "b"])
    strong = reports.strong_pairs(reports.correlation_pairs(df), 0.9)
    assert rows_of(strong, "col_a", "col_b") == [("a", "b")]


def test_sampling_is_exact_and_seeded(spark):
    df = spark.range(1000).toDF("x")
    first, again = reports.sample_rows(df, 50, seed=1), reports.sample_rows(df, 50, seed=1)
    assert first.count() == 50
    assert rows_of(first) == rows_of(again)
    sampled = reports.clip_distribution(df, "x", 100, 900, sample_size=50)
    assert sampled["regions"].where("region = 'overall'").collect()[0]["count"] == 50


def test_clip_regions_without_bounds(spark):
    df = spark.createDataFrame([(float(n),) for n in range(5)] + [(None,)], "x double")
    got = {r.region: r for r in reports.clip_distribution(df, "x")["regions"].collect()}
    assert set(got) == {"overall", "in_range"}
    assert (got["overall"].median, got["overall"].null_count, got["in_range"]["count"]) == (2.0, 1, 5)


def test_column_stats_of_empty_table(spark):
    row = reports.column_stats(spark.createDataFrame([], "x double"), "x").collect()[0]
    assert (row.total, row.null_ratio, row.median) == (0, 0.0, None)


def test_duplicate_report_counts(payments):
    tx = payments([(1, 0, 30, 0, 30), (1, 0, 60, 0, 60), (1, 0, 90, 0, 90), (2, 0, 30, 0, 30)])
    report = reports.duplicate_txn_report(tx)
    row = report["summary"].collect()[0]
    assert (row.total_users, row.dup_users, row.dup_pairs, row.dup_txns, row.clean_users) == (2, 1, 1, 3, 1)
    assert rows_of(report["distribution"]) == [(1, 3)]


@pytest.mark.parametrize("handling", ["dropna", "fillzero", "fillmean", "pairwise"])
def test_correlations_of_a_wide_table(spark, handling):
    import pandas

    rng = numpy.random.default_rng(3)
    data = pandas.DataFrame(rng.standard_normal((120, 31)) + 1e6, columns=[f"c{i}" for i in range(31)])
    data["c30"] = 4.0
    for column in ("c3", "c9"):
        data.loc[rng.choice(120, 20, replace=False), column] = numpy.nan
    rows = [tuple(None if v != v else v for v in row) for row in data.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data.columns))
    table = {"dropna": data.dropna(), "fillzero": data.fillna(0), "fillmean": data.fillna(data.mean())}.get(handling, data)
    wanted = table.corr()
    got = reports.correlation_pairs(df, null_handling=handling).collect()
    assert len(got) == 465
    for r in got:
        expected = wanted.loc[r.col_a, r.col_b]
        assert r.r is None if r.col_b == "c30" else r.r == pytest.approx(expected, abs=1e-9)
        assert r.n_rows == len(table)


SINGLE = {
    "sign_dist": reports.plan_days_sign_dist, "sign_mix": reports.user_sign_mix, "buckets": reports.plan_days_buckets,
    "vs_actual": reports.plan_vs_actual, "by_plan": reports.plan_days_by_plan, "by_cancel": reports.plan_days_by_cancel,
    "negative": reports.negative_patterns,
}


def test_one_report_holds_what_seven_say(spark):
    import random

    rng = random.Random(4)

    def pick(*values):
        return rng.choice(values)

    rows = [
        (pick(1, 2, 3, 4, 5, None), pick(7, 30, 31, None), pick(-400, -30, -1, 0, 1, 30, 31, 500, None), pick(0, 1, None))
        for _ in range(150)
    ]
    seq = spark.createDataFrame(rows, "user_id long, payment_plan_days long, actual_plan_days long, is_cancel long")
    for given in (seq, seq.where("user_id = 1"), seq.limit(0), seq.where("actual_plan_days is null")):
        found = reports.plan_days_tables(given, top=100)
        assert set(found) == set(SINGLE)
        for name, single in SINGLE.items():
            wanted = single(given, 100) if name in ("by_plan", "negative") else single(given)
            assert found[name].columns == wanted.columns
            assert rows_of(found[name]) == rows_of(wanted), name


def test_one_report_scans_once_and_unfolds_counts(spark, tmp_path):
    import tenura.operators.reports as module

    seq = spark.range(200).selectExpr("id % 9 user_id", "30L payment_plan_days", "id % 5 - 2 actual_plan_days", "id % 2 is_cancel")
    seq.write.parquet(str(tmp_path / "seq"))
    stored, plans = spark.read.parquet(str(tmp_path / "seq")), []
    kept = module.materialize
    module.materialize = lambda df, label: plans.append(df) or kept(df, label)
    try:
        reports.plan_days_tables(stored)
    finally:
        module.materialize = kept
    (cells,) = plans
    text = cells._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert text.count("FileScan") == 1 and text.count("Expand") == 1
    assert text.index("Expand") < text.index("Exchange hashpartitioning(user_id")
