"""Queries for stored layouts, the export of the pipeline, and samples (inventory A, C, F, G)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.features_and_reports import _ML, _USAGE, _d
from checks.registry import check
from checks.tables_and_cohort import LOGS
from checks.world import World, survivors
from tenura.functions import placement, sampling
from tenura.operators import cohort, features, reports
from tenura.plans.export import Exported, export_run
from tenura.session import materialize
from tenura.sources import layout, tables

check(
    "usage_by_month",
    f"{LOGS} b:usage_month",
    lambda w: w.monthly,
    "SELECT *, year(date) * 100 + month(date) AS usage_month FROM ul",
    "ul",
)
check(
    "logs_in_membership_by_month",
    f"{LOGS} d:total_hours b:days_before_expire,membership_period",
    lambda w: features.logs_in_membership(w.monthly, w.last_txn),
    "SELECT * FROM fl",
    "fl",
)
check(
    "user_logs_features_by_month",
    f"b:user_id {_d(features.LOG_FEATURES)}",
    lambda w: features.user_logs_features(w.last_txn, features.logs_in_membership(w.monthly, w.last_txn)),
    "SELECT * FROM f_logs",
    "f_logs",
)
check(
    "ml_features_by_month",
    _ML,
    lambda w: features.feature_table(w.members5, w.seq, w.monthly),
    "SELECT * FROM ml",
    "ml",
)


def _saved(w: World, hot_rows: int | None = 1_000_000) -> layout.UserTables:
    """Payments in sequence, usage and members in buckets."""
    tables = {"seq": w.seq, "logs": w.logs, "members": w.members}
    order = {"seq": ("sequence_group_id", "sequence_id"), "logs": ("date",)}
    return layout.save_by_user(tables, f"t{uuid.uuid4().hex}_", w.folder("by-user"), order, hot_rows=hot_rows)


def _activity(t: dict[str, DataFrame]) -> DataFrame:
    """Per member: payments, last expiry, days and seconds of usage."""
    paid = t["seq"].groupBy("user_id").agg(F.count(F.lit(1)).alias("n_paid"), F.max("membership_expire_date").alias("last_expire"))
    used = t["logs"].groupBy("user_id").agg(F.count(F.lit(1)).alias("n_days"), F.sum("total_secs").alias("secs"))
    return t["members"].select("user_id").join(paid, "user_id", "left").join(used, "user_id", "left")


_ACTIVITY = """SELECT m.user_id, n_paid, last_expire, n_days, secs FROM mem m
    LEFT JOIN (SELECT user_id, COUNT(*) AS n_paid, MAX(membership_expire_date) AS last_expire FROM seq GROUP BY 1) p USING (user_id)
    LEFT JOIN (SELECT user_id, COUNT(*) AS n_days, SUM(total_secs) AS secs FROM ul GROUP BY 1) u USING (user_id)"""
for _name, _hot in (("tables_by_user", 1_000_000), ("tables_by_user_hot", 12)):
    check(
        _name,
        "b:user_id,n_paid t:last_expire b:n_days d:secs",
        lambda w, hot=_hot: _saved(w, hot).each(_activity),
        _ACTIVITY,
        "mem", "seq", "ul",
    )


def _exported(w: World) -> Exported:
    return export_run(w.raw_tables, w.folder("export"), f"t{uuid.uuid4().hex}_", buckets=8)


check(
    "export_tables",
    "s:table_name b:user_id,n_rows",
    lambda w: survivors(_exported(w).tables()),
    """SELECT table_name, i.id AS user_id, COUNT(*) AS n_rows FROM (
      SELECT 'train_merge' AS table_name, user_id FROM train UNION ALL SELECT 'transactions_merge', user_id FROM tx
      UNION ALL SELECT 'transactions_seq', user_id FROM tx UNION ALL SELECT 'user_logs_merge', user_id FROM ul
      UNION ALL SELECT 'members_merge', user_id FROM raw_members) r JOIN ids i USING (user_id)
    WHERE user_id IN (SELECT user_id FROM cohort) AND user_id NOT IN (SELECT user_id FROM broken) GROUP BY 1, 2
    UNION ALL SELECT 'user_id_map', id, 1 FROM ids""",
    "train", "tx", "ul", "raw_members", "ids", "cohort", "broken",
)
check(
    "export_training_table",
    _ML,
    lambda w: _exported(w).training_table(),
    """SELECT i.id AS user_id, ml.* EXCLUDE (user_id) FROM ml JOIN ids i ON ml.user_id = i.user_id
    WHERE ml.user_id IN (SELECT user_id FROM cohort) AND ml.user_id NOT IN (SELECT user_id FROM broken)""",
    "ml", "ids", "cohort", "broken",
)


def _export_report(w: World) -> DataFrame:
    return w.spark.read.parquet(_exported(w).reports["date_report"])


check(
    "export_date_report",
    "s:table_name,column_name b:total,unset,bad t:min_date,max_date",
    _export_report,
    """SELECT table_name, column_name, COUNT(*) AS total, CAST(0 AS BIGINT) AS unset, CAST(0 AS BIGINT) AS bad, MIN(d) AS min_date,
      MAX(d) AS max_date FROM (
      SELECT if(user_id % 2 = 0, 'raw_transactions_v1', 'raw_transactions_v2') AS table_name, 'transaction_date' AS column_name,
        transaction_date AS d FROM tx
      UNION ALL SELECT if(user_id % 2 = 0, 'raw_transactions_v1', 'raw_transactions_v2'), 'membership_expire_date',
        membership_expire_date FROM tx
      UNION ALL SELECT if(user_id % 2 = 0, 'raw_user_logs_v1', 'raw_user_logs_v2'), 'date', date FROM ul
        WHERE user_id IN (SELECT user_id FROM raw_members)
      UNION ALL SELECT 'raw_members_v3', 'registration_init_time', registration_init_time FROM mem) x GROUP BY 1, 2""",
    "tx", "ul", "mem", "raw_members",
)


# --- samples: their size, that their rows are rows of the table, and that they repeat in another layout ---

_SAMPLE = "b:n_rows,n_users,n_found,n_again"
_LOG_KEY = ("user_id", "date")


def _sample_facts(sample: DataFrame, again: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    sample = materialize(sample, "facts")
    found = sample.join(rows.select(*key).distinct(), list(key), "left_semi").agg(F.count(F.lit(1)).alias("n_found"))
    same = sample.intersectAll(again).agg(F.count(F.lit(1)).alias("n_again"))
    size = sample.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(*key).alias("n_users"))
    return size.crossJoin(F.broadcast(found)).crossJoin(F.broadcast(same))


def _sampled_logs(w: World, size: int, cell_rows: int = sampling.CELL_ROWS) -> DataFrame:
    sample = sampling.exact_sample(w.logs, size, _LOG_KEY, cell_rows=cell_rows)
    return _sample_facts(sample, sampling.exact_sample(w.logs.repartition(5), size, _LOG_KEY), w.logs, _LOG_KEY)


for _name, _cell in (("exact_sample", sampling.CELL_ROWS), ("exact_sample_rounds", 1)):
    check(
        _name,
        _SAMPLE,
        lambda w, cell=_cell: _sampled_logs(w, 250, cell),
        "SELECT n AS n_rows, n AS n_users, n AS n_found, n AS n_again FROM (SELECT least(COUNT(*), 250) AS n FROM ul) x",
        "ul",
    )
check(
    "exact_sample_of_all",
    LOGS,
    lambda w: sampling.exact_sample(w.logs, 10**9, _LOG_KEY),
    "SELECT * FROM ul",
    "ul",
)
check(
    "table_sample",
    _SAMPLE,
    lambda w: _sample_facts(
        tables.table_sample(w.raw_members, 7, ["user_id"]), tables.table_sample(w.raw_members.repartition(3), 7, ["user_id"]),
        w.raw_members, ["user_id"],
    ),
    "SELECT n AS n_rows, n AS n_users, n AS n_found, n AS n_again FROM (SELECT least(COUNT(*), 7) AS n FROM raw_members) x",
    "raw_members",
)
_REMOVED = """SELECT DISTINCT table_name, user_id FROM rows4 WHERE user_id IN (SELECT user_id FROM pairs)"""


def _removed(w: World, size: int) -> DataFrame:
    return cohort.removed_samples(w.tables, cohort.drop_same_day_duplicates(w.tables, w.tx), size)


check("filter_impact_removed_keys", "s:table_name b:user_id", lambda w: _removed(w, 10**9), _REMOVED, "rows4", "pairs")
check(
    "filter_impact_removed_sample",
    "s:table_name b:n_keys",
    lambda w: _removed(w, 5).groupBy("table_name").agg(F.countDistinct("user_id").alias("n_keys")),
    f"SELECT table_name, least(COUNT(*), 5) AS n_keys FROM ({_REMOVED}) x GROUP BY 1",
    "rows4", "pairs",
)
check(
    "clip_distribution_sample",
    "b:count,null_count,outside",
    lambda w: reports.clip_distribution(w.logs, "total_secs", 0, 86400, sample_size=300, sample_key=_LOG_KEY)["regions"]
    .where("region = 'overall'")
    .select("count", "null_count", ((F.col("min") < 0) | (F.col("max") > 1e9)).cast("int").alias("outside")),
    "SELECT least(COUNT(*), 300) AS count, 0 AS null_count, 0 AS outside FROM ul",
    "ul",
)
check(
    "correlation_pairs_sample",
    "s:col_a,col_b b:n_rows,sane",
    lambda w: reports.correlation_pairs(w.logs, null_handling="fillzero", sample_size=300, sample_key=_LOG_KEY).select(
        "col_a", "col_b", "n_rows", (F.abs("r") <= 1 + 1e-9).cast("int").alias("sane")
    ),
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, least(COUNT(*), 300) AS n_rows, 1 AS sane FROM ul"
        for i, a in enumerate(_USAGE) for b in _USAGE[i + 1 :]
    ),
    "ul",
)

check(
    "column_medians",
    "s:column_name d:fraction,value",
    lambda w: placement.column_percentiles(w.ml, features.FEATURES, [0.5, 0.9]),
    """SELECT column_name, unnest([0.5, 0.9]) AS fraction, unnest(quantile_cont(v, [0.5, 0.9])) AS value
    FROM (UNPIVOT (SELECT COLUMNS(* EXCLUDE (user_id, is_churn))::DOUBLE FROM ml) ON COLUMNS(*) INTO NAME column_name VALUE v) u
    GROUP BY 1""",
    "ml",
)
check(
    "usage_medians_by_user",
    "b:user_id d:fraction,value",
    lambda w: placement.exact_percentiles(w.logs, "total_secs", [0.25, 0.5], "user_id"),
    """SELECT user_id, unnest([0.25, 0.5]) AS fraction, unnest(quantile_cont(total_secs, [0.25, 0.5])) AS value
    FROM ul WHERE total_secs IS NOT NULL GROUP BY 1""",
    "ul",
)
