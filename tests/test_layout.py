from __future__ import annotations

import uuid
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.storage import _activity
from checks.world import World
from tenura.functions.months import MONTH, in_months, months_met
from tenura.operators import features
from tenura.plans.export import OUTPUTS, export_run
from tenura.plans.preprocess import preprocess
from tenura.session import _roots, materialize, scratch_dir, stages
from tenura.sources import layout
from tests.conftest import LOG_SCHEMA, SF_SMALL, rows_of
from tests.test_plans import plan, shuffled  # noqa: F401


def usage(spark, rows):
    return spark.createDataFrame([(u, d, 1, 2, 3, 4, 5, 6, 60.0) for u, d in rows], LOG_SCHEMA)


def windows(spark, rows):
    return spark.createDataFrame(rows, "user_id long, log_start_date date, log_end_date date, membership_period long")


def test_months_of_spans(spark):
    spans = windows(
        spark,
        [
            (1, date(2016, 1, 31), date(2016, 2, 1), 1), (2, date(2016, 11, 30), date(2017, 1, 2), 33),
            (3, date(2016, 5, 5), date(2016, 5, 5), 0), (4, None, date(2016, 7, 1), None), (5, date(2016, 9, 2), date(2016, 8, 1), -3),
        ],
    )
    got = [r[0] for r in months_met(spans, "log_start_date", "log_end_date").orderBy(MONTH).collect()]
    assert got == [201601, 201611, 201612, 201701]


def test_usage_round_trip_with_nulls(spark, tmp_path):
    rows = usage(spark, [(1, date(2016, 1, 5)), (1, None), (None, date(2016, 2, 1)), (None, None), (1, date(2016, 1, 5))])
    back = layout.read_by_month(spark, layout.write_by_month(rows, str(tmp_path / "u")))
    assert rows_of(back.drop(MONTH)) == rows_of(rows)
    assert {p.name for p in (tmp_path / "u").glob("usage_month=*")} == {
        "usage_month=201601", "usage_month=201602", "usage_month=__HIVE_DEFAULT_PARTITION__"
    }
    empty = layout.read_by_month(spark, layout.write_by_month(rows, str(tmp_path / "e"))).where("false")
    assert features.logs_in_membership(empty, windows(spark, [(1, date(2016, 1, 1), date(2016, 2, 1), 31)])).count() == 0


def test_only_months_of_memberships_are_opened(spark, tmp_path):
    days = [(u, date(2016, m, d)) for u in range(20) for m in range(1, 13) for d in (1, 15)]
    path = layout.write_by_month(usage(spark, days), str(tmp_path / "u"))
    logs = layout.read_by_month(spark, path)
    spans = windows(spark, [(3, date(2016, 3, 10), date(2016, 5, 2), 53), (4, date(2016, 4, 1), date(2016, 4, 16), 15)])
    want = rows_of(features.logs_in_membership(usage(spark, days), spans))
    for month in (1, 2, 6, 7, 8, 9, 10, 11, 12):
        for file in Path(path, f"usage_month=2016{month:02d}").glob("*.parquet"):
            file.write_bytes(b"no parquet")
    found = features.logs_in_membership(logs, spans)
    assert rows_of(found) == want and len(want) == 6
    assert found.count() == 6  # a plan with fewer columns prunes as well


@pytest.mark.parametrize(
    "build",
    [
        lambda w, logs: features.logs_in_membership(logs, w.last_txn),
        lambda w, logs: features.user_logs_features(w.last_txn, features.logs_in_membership(logs, w.last_txn)),
        lambda w, logs: features.feature_table(w.members5, w.seq, logs),
    ],
)
def test_scan_of_usage_waits_for_the_months(spark, shuffled, build):  # noqa: F811
    world = World(spark, SF_SMALL)
    scans = [line for line in plan(build(world, world.monthly)).splitlines() if "FileScan" in line and MONTH in line]
    assert scans and all("dynamicpruningexpression" in line for line in scans)


def test_joins_of_users_need_no_exchange(spark, shuffled, tmp_path):  # noqa: F811
    world = World(spark, SF_SMALL)
    order = {"seq": ("sequence_group_id", "sequence_id"), "logs": ("date",)}
    saved = layout.save_by_user(
        {"seq": world.seq, "logs": world.logs, "members": world.members}, f"t{uuid.uuid4().hex}_", str(tmp_path / "t"), order
    )
    assert not saved.hot
    text = plan(saved.each(_activity))
    assert "Exchange" not in text and "SortMergeJoin" in text
    hot = layout.save_by_user(
        {"seq": world.seq, "logs": world.logs, "members": world.members}, f"t{uuid.uuid4().hex}_", str(tmp_path / "h"), order, hot_rows=5
    )
    assert hot.hot and 0 < hot.ordinary("seq").count() < world.seq.count()
    for name in ("seq", "logs", "members"):
        assert rows_of(hot.table(name)) == rows_of(saved.table(name))
    assert rows_of(hot.each(_activity)) == rows_of(saved.each(_activity))
    users = [set(r[0] for r in hot.ordinary(n).select("user_id").distinct().collect()) for n in ("seq", "logs", "members")]
    apart = [set(r[0] for r in spark.table(f"{hot.prefix}{n}_hot").select("user_id").distinct().collect()) for n in ("seq", "logs", "members")]
    assert all(not (u & set().union(*apart)) for u in users)
    hot.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(hot.prefix)]


def test_tables_by_user_keep_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, None), (1, None)] + [(7, i) for i in range(40)], "user_id long, x long")
    for n, hot_rows in enumerate((None, 10)):
        saved = layout.save_by_user({"t": df, "none": df.limit(0)}, f"t{uuid.uuid4().hex}_", str(tmp_path / str(n)), buckets=3, hot_rows=hot_rows)
        assert rows_of(saved.table("t")) == rows_of(df) and saved.table("none").count() == 0
        assert saved.hot == (hot_rows is not None)


def test_stages_that_nothing_reads_are_deleted(spark):
    with stages(spark) as outer:
        with stages(spark) as held:
            one = materialize(spark.range(10), "one")
            two = materialize(one.where("id > 3"), "two")
            three = materialize(spark.range(3), "three")
            result = two.join(three, "id", "left")
            assert len(held.paths) == 3
            kept = held.release(result)
        assert outer.paths == kept and len(kept) == 2
        assert result.count() == 6
        with pytest.raises(Exception, match="[Pp]ath|exist"):
            one.count()
        assert outer.release() == []


def folders(spark):
    return {p.name for p in Path(scratch_dir(spark)).iterdir()}


def test_preprocess_leaves_only_what_its_results_read(spark):
    raw, before = World(spark, SF_SMALL).raw_tables, folders(spark)
    tables = preprocess(raw)
    left = folders(spark) - before
    read = {Path(root).name for df in tables.values() for root in _roots(df)}
    assert left and left <= read
    assert tables["transactions_seq"].count() == tables["transactions_merge"].count() > 0


def test_export_leaves_nothing_behind(spark, tmp_path):
    raw, before = World(spark, SF_SMALL).raw_tables, folders(spark)
    out = export_run(raw, str(tmp_path), f"t{uuid.uuid4().hex}_", buckets=3)
    assert folders(spark) == before
    tables = preprocess(raw)
    for name in OUTPUTS:
        got = out.tables()[name]
        assert rows_of(got.drop(MONTH)) == rows_of(tables[name]), name
    assert rows_of(spark.read.parquet(out.reports["date_report"])) == rows_of(tables["date_report"])
    bad = {**raw, "raw_transactions_v1": raw["raw_transactions_v1"].withColumn("transaction_date", F.lit(20161399))}
    report = {(r.table_name, r.column_name): r for r in preprocess(bad)["date_report"].collect()}
    wrong = report["raw_transactions_v1", "transaction_date"]
    assert wrong.bad == wrong.total > 0 and report["raw_transactions_v2", "transaction_date"].bad == 0


def test_rows_without_a_span_in_their_month(spark):
    rows = usage(spark, [(1, date(2016, 1, 5)), (1, date(2016, 3, 5))]).withColumn(MONTH, F.lit(201601))
    none = windows(spark, [(1, date(2016, 1, 1), date(2016, 1, 1), 0)])
    assert in_months(rows, none, "log_start_date", "log_end_date").count() == 0
