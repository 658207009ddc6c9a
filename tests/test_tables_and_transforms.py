import warnings

import pytest

from tenura.operators import keys, merge, transform
from tenura.sources import files, tables
from tests.conftest import rows_of


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


# --- files and tables ---


def test_csv_and_parquet_round_trip(spark, tmp_path, frame):
    logs = frame([("a", 20170301, 1, 2, 3, 4, 5, 6, 7.5)], files.raw_schema("raw_user_logs_v2"))
    files.write_csv_tables({"raw_user_logs_v2": logs}, str(tmp_path))
    with pytest.warns(UserWarning, match="absent.csv"):
        read = files.read_csv_tables(spark, str(tmp_path), ["raw_user_logs_v2.csv", "absent.csv"])
    assert list(read) == ["raw_user_logs_v2"]
    assert rows_of(read["raw_user_logs_v2"]) == rows_of(logs)
    assert read["raw_user_logs_v2"].schema == logs.schema
    with pytest.warns(UserWarning, match="gone"):
        paths = files.write_parquet_tables({"t": logs}, str(tmp_path / "out"), ["t", "gone"])
    assert rows_of(spark.read.parquet(paths["t"])) == rows_of(logs)
    assert any(".zstd.parquet" in p.name for p in (tmp_path / "out" / "t.parquet").iterdir())


def test_csv_keeps_existing_tables_unless_overwritten(spark, tmp_path, frame):
    files.write_csv_tables({"raw_train_v1": frame([("a", 1)], "msno string, is_churn long")}, str(tmp_path))
    old = {"raw_train_v1": frame([("b", 0)], "msno string, is_churn long")}
    kept = files.read_csv_tables(spark, str(tmp_path), ["raw_train_v1.csv"], existing=old, overwrite=False)
    assert rows_of(kept["raw_train_v1"]) == rows_of(old["raw_train_v1"])
    new = files.read_csv_tables(spark, str(tmp_path), ["raw_train_v1.csv"], existing=old)
    assert rows_of(new["raw_train_v1"], "msno") == [("a",)]


def test_unknown_csv_is_inferred(spark, tmp_path, frame):
    files.write_csv_tables({"other": frame([(1, "x")], "n long, s string")}, str(tmp_path))
    read = files.read_csv_tables(spark, str(tmp_path), ["other.csv"])["other"]
    assert dict(read.dtypes) == {"n": "int", "s": "string"}


def test_copy_tables_ignores_or_overwrites(spark, tmp_path, frame):
    first, second = frame([(1,)], "n long"), frame([(2,)], "n long")
    tables.copy_tables({"a": first}, {"a": "copy_target"}, location=str(tmp_path))
    kept = tables.copy_tables({"a": second}, {"a": "copy_target"}, location=str(tmp_path))
    assert rows_of(kept["copy_target"]) == [(1,)]
    replaced = tables.copy_tables({"a": second}, {"a": "copy_target"}, overwrite=True, location=str(tmp_path))
    assert rows_of(replaced["copy_target"]) == [(2,)]
    assert tables.rename_catalog_table(spark, "copy_target")
    assert not tables.rename_catalog_table(spark, "copy_target")
    assert spark.catalog.tableExists("copy_target_v1")


def test_add_and_rename_columns(frame):
    df = frame([(1,)], "a long")
    assert tables.rename_column(df, "missing", "b").columns == ["a"]
    assert tables.rename_column(df.withColumn("b", df.a), "a", "b").columns == ["a", "b"]
    assert tables.add_column(df, "b", "double").dtypes == [("a", "bigint"), ("b", "double")]
    assert rows_of(tables.add_column(df, "a", "long", "7", overwrite=False)) == [(1,)]
    assert rows_of(tables.add_column(df, "a", "long", "7")) == [(7,)]


def test_table_sample_is_bounded(spark):
    assert tables.table_sample(spark.range(100), 3).count() == 3


# --- merge and keys ---


def test_merge_prefers_v2_and_keeps_one_row_per_key(frame):
    v1 = frame([("a", 1), ("b", 1), (None, 1)], "msno string, is_churn long")
    v2 = frame([("a", 0), ("a", 1), ("c", 0)], "msno string, is_churn long")
    assert rows_of(merge.merge_prefer_latest(v1, v2), "msno", "is_churn") == rows_of(
        frame([("a", 0), ("b", 1), ("c", 0), (None, 1)], "msno string, is_churn long"), "msno", "is_churn"
    )


def test_merge_versions_covers_single_and_missing(frame):
    one = frame([("a", 1)], "msno string, is_churn long")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        got = merge.merge_versions(
            {"raw_train_v2": one, "raw_user_logs_v1": one, "raw_members_v1": one, "raw_members_v3": one},
            ["raw_train", "raw_user_logs", "raw_members", "raw_transactions"],
            drop_sources=True,
        )
    assert sorted(got) == ["members_merge", "train_merge", "user_logs_merge"]
    assert "raw_transactions" in str(caught[0].message)


def test_merge_concat_matches_names_before_positions(frame):
    a, b = frame([(1, 2)], "x long, y long"), frame([(4, 3)], "y long, x long")
    assert rows_of(merge.merge_concat(a, b), "x", "y") == [(1, 2), (3, 4)]
    assert rows_of(merge.merge_concat(a, frame([(5, 6)], "p long, q long")), "x", "y") == [(1, 2), (5, 6)]


def test_id_map_skips_null_and_empty_keys(frame):
    a = frame([("b",), ("a",), (None,), ("",)], "msno string")
    b = frame([("c",), ("a",)], "msno string")
    id_map = keys.build_id_map({"a": a, "b": b, "other": frame([(1,)], "n long")})
    assert rows_of(id_map, "msno", "user_id") == [("a", 0), ("b", 1), ("c", 2)]
    assert keys.id_map_duplicates(id_map).isEmpty()
    applied = keys.apply_id_map({"a": a}, id_map)["a"]
    assert rows_of(applied, "msno") == [(0,), (1,)]
    losses = keys.id_map_losses({"a": a, "b": b}, id_map)
    assert rows_of(losses, "table_name", "row_count", "lost_rows") == [("a", 4, 2), ("b", 2, 0)]


# --- transforms ---


def test_bad_dates_become_null_and_are_counted(frame):
    df = frame([(20170228,), (20170231,), (0,), (None,), (2017,)], "transaction_date long")
    parsed = transform.parse_int_dates(df)
    assert parsed.dtypes == [("transaction_date", "date")]
    assert parsed.where("transaction_date is null").count() == 4
    report = transform.int_date_report(df).collect()[0]
    assert (report.total, report.unset, report.bad) == (5, 2, 2)
    assert transform.parse_int_dates(parsed).dtypes == parsed.dtypes


def test_nullify_keeps_bounds_and_nulls(frame):
    df = frame([(-1.0,), (0.0,), (5.0,), (6.0,), (None,)], "x double")
    kept = transform.nullify_out_of_range(df, "x", 0, 5)
    assert sorted(r.x for r in kept.collect() if r.x is not None) == [0.0, 5.0]
    assert transform.nullify_out_of_range(df, "x", max_val=5).where("x is null").count() == 2
    assert rows_of(transform.nullify_out_of_range(df, "x")) == rows_of(df)


def test_rules_leave_unknown_conditions_alone(frame):
    df = frame([(None, "a"), (1, "b"), (5, None)], "x long, s string")
    kept = transform.apply_rules(df, [{"column": "x", "operator": "<", "value": 3, "action": "delete_row"}])
    assert rows_of(kept, "x") == [(5,), (None,)]
    kept = transform.apply_rules(df, [{"column": "s", "operator": "not_in", "value": ["a"], "action": "set_null"}])
    assert rows_of(kept, "s") == [("a",), (None,), (None,)]


def test_rules_see_earlier_rules_and_report_in_one_pass(frame):
    df = frame([(1,), (2,), (3,)], "x long")
    rules = [
        {"column": "x", "operator": "==", "value": 1, "action": "set_value", "new_value": 3},
        {"column": "x", "operator": "==", "value": 3, "action": "delete_row"},
        {"column": "x", "operator": "is_not_null", "action": "set_null"},
    ]
    assert rows_of(transform.apply_rules(df, rules)) == [(None,)]
    assert [r.affected for r in transform.rule_impact(df, rules).orderBy("rule_no").collect()] == [1, 2, 1]
    dry = transform.rule_impact(df, rules, dry_run=True).orderBy("rule_no").collect()
    assert [r.affected for r in dry] == [1, 1, 3]


def test_rules_reject_operators_and_skip_columns_and_actions(frame):
    df = frame([(1,)], "x long")
    with pytest.raises(ValueError, match="~"):
        transform.apply_rules(df, [{"column": "x", "operator": "~", "action": "set_null"}])
    with pytest.warns(UserWarning, match="no column"):
        transform.apply_rules(df, [{"column": "y", "operator": "==", "value": 1, "action": "set_null"}])
    with pytest.warns(UserWarning, match="unknown action"):
        kept = transform.apply_rules(df, [{"column": "x", "operator": "==", "value": 1, "action": "explode"}])
    assert rows_of(kept) == [(1,)]


def test_convert_unit_clips_and_keeps_null(frame):
    df = frame([(3600.0,), (100.0,), (900000.0,), (None,)], "s double")
    got = transform.convert_unit(df, "s", "h", 3600, clip_min=1, clip_max=24)
    assert rows_of(got, "h") == [(1.0,), (1.0,), (24.0,), (None,)]
    assert rows_of(transform.convert_unit(got, "s", "h", overwrite=False)) == rows_of(got)
    assert transform.convert_unit(got, "s", "h", multiplier=2).where("s = 100").collect()[0].h == 200.0


@pytest.mark.parametrize("method, fill", [("mean", 3), ("median", 2), ("mode", 2)])
def test_fill_methods_on_integers(frame, method, fill):
    df = frame([(2,), (2,), (5,), (5,), (1,), (None,)], "x long")
    filled = transform.fill_nulls(df, "x", method=method)
    assert filled.dtypes == [("x", "bigint")]
    assert sorted(r.x for r in filled.collect()) == sorted([2, 2, 5, 5, 1, fill])


def test_fill_value_and_unknown_method(frame):
    df = frame([("a",), (None,)], "s string")
    assert rows_of(transform.fill_nulls(df, "s", "z")) == [("a",), ("z",)]
    with pytest.raises(ValueError):
        transform.fill_nulls(df, "s", method="guess")


def test_lines_that_do_not_parse_are_counted(spark, tmp_path):
    from tenura.sources.files import land_csv_tables

    (tmp_path / "raw_train_v1.csv").write_text("msno,is_churn\na,1\nb,x\nc,0\nd,1,extra\n")
    landed, counts = land_csv_tables(spark, str(tmp_path), ["raw_train_v1.csv"], str(tmp_path / "out"))
    assert [tuple(r) for r in counts.collect()] == [("raw_train_v1", 4, 2)]
    assert sorted(map(tuple, landed["raw_train_v1"].collect())) == [("a", 1), ("b", None), ("c", 0), ("d", 1)]


def test_latest_version_of_one_column(spark):
    from tenura.operators.merge import merge_prefer_latest

    v1 = spark.createDataFrame([("a", 1), ("b", 1), ("b", None), ("c", 5), ("c", 3)], "msno string, is_churn long")
    v2 = spark.createDataFrame([("a", 0), ("d", None), ("d", 2), ("a", 4)], "msno string, is_churn long")
    got = merge_prefer_latest(v1, v2)
    assert sorted(map(tuple, got.collect())) == [("a", 0), ("b", None), ("c", 3), ("d", None)]
    wide = merge_prefer_latest(*[df.withColumn("more", df["is_churn"]) for df in (v1, v2)]).drop("more")
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, got.collect()))
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
