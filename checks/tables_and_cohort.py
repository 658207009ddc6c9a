"""Queries for sources, merges, keys, cohort filters, transforms and sequences (inventory A to E)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import check
from checks.world import World, survivors
from tenura.functions.asof import as_of
from tenura.operators import cohort, keys, membership, merge, sequence, transform
from tenura.sources import files, tables

TX = (
    "b:user_id,payment_method_id,payment_plan_days,plan_list_price,actual_amount_paid,is_auto_renew "
    "t:transaction_date,membership_expire_date b:is_cancel"
)
SEQ = f"{TX} b:sequence_group_id,sequence_id,before_transaction_term,before_membership_expire_term,is_churn"
LOGS = "b:user_id t:date b:num_25,num_50,num_75,num_985,num_100,num_unq d:total_secs"
MEMBERS = "b:user_id,city,bd,gender,registered_via t:registration_init_time"
ROWS4 = "s:table_name b:user_id,n_rows"

# --- A: sources, sinks, table shaping ---


def _csv_round_trip(w: World) -> DataFrame:
    raw = {n: w.raw_tables[n] for n in ("raw_transactions_v1", "raw_transactions_v2")}
    folder = w.folder("csv")
    files.write_csv_tables(raw, folder)
    read = files.read_csv_tables(w.spark, folder, [f"{n}.csv" for n in raw])
    return merge.merge_concat(*[read[n] for n in raw])


_RAW_TX = """
    SELECT c.c_name AS msno, tx.* EXCLUDE (user_id, transaction_date, membership_expire_date),
      CAST(strftime(transaction_date, '%Y%m%d') AS BIGINT) AS transaction_date,
      CAST(strftime(membership_expire_date, '%Y%m%d') AS BIGINT) AS membership_expire_date
    FROM tx JOIN customer c ON tx.user_id = c.c_custkey
"""
check(
    "read_csv_tables",
    "s:msno b:payment_method_id,payment_plan_days,plan_list_price,actual_amount_paid,is_auto_renew,"
    "transaction_date,membership_expire_date,is_cancel",
    _csv_round_trip,
    _RAW_TX,
    "tx",
)


def _landed(w: World) -> DataFrame:
    """Both label extracts through CSV with every tenth line broken, and what the count says of it."""
    broken = F.when(F.col("is_churn") == 1, F.lit("yes")).otherwise(F.col("is_churn").cast("string"))
    raw = {n: w.raw_tables[n].withColumn("is_churn", broken) for n in ("raw_train_v1", "raw_train_v2")}
    folder = w.folder("csv")
    files.write_csv_tables(raw, folder)
    landed, counts = files.land_csv_tables(w.spark, folder, [f"{n}.csv" for n in raw], w.folder("landed"))
    sums = [
        df.agg(F.lit(n).alias("table_name"), F.count("is_churn").alias("n_known"), F.countDistinct("msno").alias("n_users"))
        for n, df in landed.items()
    ]
    return counts.join(sums[0].unionByName(sums[1]), "table_name")


check(
    "land_csv_tables",
    "s:table_name b:n_rows,n_corrupt,n_known,n_users",
    _landed,
    """SELECT name AS table_name, COUNT(*) AS n_rows, SUM(is_churn) AS n_corrupt, COUNT(*) - SUM(is_churn) AS n_known,
      COUNT(DISTINCT user_id) AS n_users
    FROM (SELECT 'raw_train_v1' AS name, * FROM tv1 UNION ALL SELECT 'raw_train_v2', * FROM tv2) x GROUP BY 1""",
    "tv1", "tv2",
)


def _parquet_round_trip(w: World) -> DataFrame:
    paths = files.write_parquet_tables({"user_logs": w.logs}, w.folder("parquet"))
    return w.spark.read.parquet(paths["user_logs"])


check("write_parquet_tables", LOGS, _parquet_round_trip, "SELECT * FROM ul", "ul")


def _members_csv(w: World) -> DataFrame:
    paths = files.write_csv_tables({"members": w.raw_members}, w.folder("csv"), include_header=False)
    return w.spark.read.schema(w.raw_members.schema).csv(paths["members"])


check(
    "write_csv_tables",
    "s:msno b:user_id,city,bd s:gender b:registered_via,registration_init_time",
    _members_csv,
    "SELECT * FROM raw_members",
    "raw_members",
)


def _copied(w: World) -> DataFrame:
    folder = w.folder("tables")
    name = "members_copy_" + folder.rsplit("-", 1)[-1]
    copies = tables.copy_tables({"members": w.raw_members}, {"members": name}, overwrite=True, location=folder)
    return copies[name]


check(
    "copy_tables",
    "s:msno b:user_id,city,bd s:gender b:registered_via,registration_init_time",
    _copied,
    "SELECT * FROM raw_members",
    "raw_members",
)


def _renamed(w: World) -> DataFrame:
    given = {"train": w.tv1, "train_v1": w.tv2, "transactions": w.tx, "user_logs": w.logs}
    return survivors(tables.rename_versioned(given, ["train", "transactions", "user_logs", "absent"]))


check(
    "rename_versioned",
    ROWS4,
    _renamed,
    """SELECT table_name, user_id, COUNT(*) AS n_rows FROM (
      SELECT 'train' AS table_name, user_id FROM tv1 UNION ALL SELECT 'train_v1', user_id FROM tv2
      UNION ALL SELECT 'transactions_v1', user_id FROM tx UNION ALL SELECT 'user_logs_v1', user_id FROM ul) x
    GROUP BY 1, 2""",
    "tv1", "tv2", "tx", "ul",
)


def _renamed_in_catalog(w: World) -> DataFrame:
    folder = w.folder("tables")
    name = "members_renamed_" + folder.rsplit("-", 1)[-1]
    tables.copy_tables({"members": w.raw_members}, {"members": name}, overwrite=True, location=folder)
    if not tables.rename_catalog_table(w.spark, name) or w.spark.catalog.tableExists(name):
        raise ValueError(f"table {name} was not renamed")
    return w.spark.table(f"{name}_v1")


check(
    "rename_catalog_table",
    "s:msno b:user_id,city,bd s:gender b:registered_via,registration_init_time",
    _renamed_in_catalog,
    "SELECT * FROM raw_members",
    "raw_members",
)


def _rekeyed(w: World) -> DataFrame:
    given = {"train": w.named(w.tv1), "transactions": w.named(w.tx), "members": w.raw_members}
    renamed = tables.rename_key_column(given)
    return survivors({n: df.select(F.col("user_id").cast("string")) for n, df in renamed.items()})


check(
    "rename_key_column",
    "s:table_name,user_id b:n_rows",
    _rekeyed,
    """SELECT table_name, user_id, COUNT(*) AS n_rows FROM (
      SELECT 'train' AS table_name, c_name AS user_id FROM tv1 JOIN customer ON user_id = c_custkey
      UNION ALL SELECT 'transactions', c_name FROM tx JOIN customer ON user_id = c_custkey
      UNION ALL SELECT 'members', CAST(user_id AS VARCHAR) FROM raw_members) x GROUP BY 1, 2""",
    "tv1", "tx", "raw_members",
)
check(
    "add_column",
    "b:user_id,is_churn,weight s:source d:score",
    lambda w: tables.add_column(
        tables.add_column(
            tables.add_column(tables.add_column(w.tv1, "weight", "bigint", "is_churn * 10 + 1"), "source", "string", "'v1'"),
            "score", "double",
        ),
        "weight", "bigint", "0", overwrite=False,
    ),
    "SELECT user_id, is_churn, is_churn * 10 + 1 AS weight, 'v1' AS source, CAST(NULL AS DOUBLE) AS score FROM tv1",
    "tv1",
)
check(
    "table_profile",
    "s:table_name b:row_count,column_count,column_no s:column_name,column_type",
    lambda w: tables.table_profile({"train": w.tv1, "user_logs": w.logs}),
    """SELECT t.table_name, n AS row_count, column_count, column_no, column_name, column_type FROM (
      VALUES ('train', 2, 1, 'user_id', 'bigint'), ('train', 2, 2, 'is_churn', 'bigint'),
        ('user_logs', 9, 1, 'user_id', 'bigint'), ('user_logs', 9, 2, 'date', 'date'),
        ('user_logs', 9, 3, 'num_25', 'bigint'), ('user_logs', 9, 4, 'num_50', 'bigint'),
        ('user_logs', 9, 5, 'num_75', 'bigint'), ('user_logs', 9, 6, 'num_985', 'bigint'),
        ('user_logs', 9, 7, 'num_100', 'bigint'), ('user_logs', 9, 8, 'num_unq', 'bigint'),
        ('user_logs', 9, 9, 'total_secs', 'double')) t(table_name, column_count, column_no, column_name, column_type)
      JOIN (SELECT 'train' AS table_name, COUNT(*) AS n FROM tv1 UNION ALL SELECT 'user_logs', COUNT(*) FROM ul) c
        ON t.table_name = c.table_name""",
    "tv1", "ul",
)

# --- B: version merge and surrogate keys ---

check(
    "merge_prefer_latest",
    "b:user_id,is_churn",
    lambda w: merge.merge_prefer_latest(w.tv1, w.tv2, "user_id"),
    "SELECT * FROM train",
    "train",
)
check(
    "merge_concat",
    TX,
    lambda w: merge.merge_concat(w.tx.where("user_id % 2 = 0"), w.tx.where("user_id % 2 = 1")),
    "SELECT * FROM tx WHERE user_id % 2 = 0 UNION ALL SELECT * FROM tx WHERE user_id % 2 = 1",
    "tx",
)


def _merged_rows(w: World) -> DataFrame:
    given = {n: df for n, df in w.raw_tables.items() if n != "raw_user_logs_v2"}
    merged = merge.merge_versions(
        given, ["raw_train", "raw_transactions", "raw_user_logs", "raw_members"], drop_sources=True
    )
    return survivors(merged, "msno")


check(
    "merge_single_version",
    "s:table_name,msno b:n_rows",
    _merged_rows,
    """SELECT table_name, c_name AS msno, COUNT(*) AS n_rows FROM (
      SELECT 'train_merge' AS table_name, user_id FROM train UNION ALL SELECT 'transactions_merge', user_id FROM tx
      UNION ALL SELECT 'user_logs_merge', user_id FROM ul WHERE user_id % 2 = 0
      UNION ALL SELECT 'members_merge', user_id FROM raw_members) x JOIN customer ON x.user_id = c_custkey
    GROUP BY 1, 2""",
    "train", "tx", "ul", "raw_members",
)


def _key_sources(w: World) -> dict[str, DataFrame]:
    return {"transactions": w.named(w.tx), "user_logs": w.named(w.logs), "train": w.named(w.train)}


_IDS = """
    SELECT msno, row_number() OVER (ORDER BY msno) - 1 AS user_id FROM (
      SELECT c_name AS msno FROM customer WHERE c_custkey IN (SELECT user_id FROM tx)
        OR c_custkey IN (SELECT user_id FROM ul) OR c_custkey IN (SELECT user_id FROM train)) x
"""
check("build_id_map", "s:msno b:user_id", lambda w: keys.build_id_map(_key_sources(w)), _IDS, "tx", "ul", "train")


def _mapped(w: World) -> DataFrame:
    given = _key_sources(w)
    known = keys.build_id_map({n: given[n] for n in ("user_logs", "train")})
    return survivors(keys.apply_id_map(given, known), "msno")


_MAP2 = """
    m AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name) - 1 AS msno FROM customer
      WHERE c_custkey IN (SELECT user_id FROM ul) OR c_custkey IN (SELECT user_id FROM train))
"""
check(
    "apply_id_map",
    "s:table_name b:msno,n_rows",
    _mapped,
    f"""WITH {_MAP2} SELECT table_name, msno, COUNT(*) AS n_rows FROM (
      SELECT 'transactions' AS table_name, user_id FROM tx UNION ALL SELECT 'user_logs', user_id FROM ul
      UNION ALL SELECT 'train', user_id FROM train) x JOIN m ON x.user_id = m.c_custkey GROUP BY 1, 2""",
    "tx", "ul", "train",
)


def _losses(w: World) -> DataFrame:
    given = _key_sources(w)
    return keys.id_map_losses(given, keys.build_id_map({"train": given["train"]}))


check(
    "apply_id_map_losses",
    "s:table_name b:row_count,lost_rows",
    _losses,
    """SELECT table_name, COUNT(*) AS row_count,
      SUM(CASE WHEN user_id NOT IN (SELECT user_id FROM train) THEN 1 ELSE 0 END) AS lost_rows FROM (
      SELECT 'transactions' AS table_name, user_id FROM tx UNION ALL SELECT 'user_logs', user_id FROM ul
      UNION ALL SELECT 'train', user_id FROM train) x GROUP BY 1""",
    "tx", "ul", "train",
)

# --- C: cohort filters ---


def _filter(name: str, apply, rule: str, *needs: str) -> None:
    check(
        name,
        ROWS4,
        lambda w: survivors(apply(w)),
        f"SELECT table_name, user_id, COUNT(*) AS n_rows FROM rows4 WHERE {rule} GROUP BY 1, 2",
        "rows4",
        *needs,
    )


_filter(
    "keep_common_users",
    lambda w: cohort.keep_common_users(w.tables),
    """user_id IN (SELECT user_id FROM train INTERSECT SELECT user_id FROM tx INTERSECT SELECT user_id FROM ul
      INTERSECT SELECT user_id FROM raw_members)""",
)
_filter(
    "keep_users_in", lambda w: cohort.keep_users_in(w.tables, w.tv1), "user_id IN (SELECT user_id FROM tv1)", "tv1"
)
_filter(
    "keep_churn_transition",
    lambda w: cohort.keep_churn_transition(w.tables, w.tv1, w.tv2),
    """user_id IN (SELECT a.user_id FROM tv1 a JOIN tv2 b ON a.user_id = b.user_id
      WHERE a.is_churn = 0 AND b.is_churn IN (0, 1))""",
    "tv1", "tv2",
)
check(
    "keep_churn_transition_labels",
    "b:v2_churn,user_count",
    lambda w: cohort.transition_label_counts(cohort.transition_users(w.tv1, w.tv2)),
    """SELECT b.is_churn AS v2_churn, COUNT(*) AS user_count FROM tv1 a JOIN tv2 b ON a.user_id = b.user_id
      WHERE a.is_churn = 0 AND b.is_churn IN (0, 1) GROUP BY 1""",
    "tv1", "tv2",
)
_filter(
    "drop_same_day_duplicates",
    lambda w: cohort.drop_same_day_duplicates(w.tables, w.tx),
    "user_id NOT IN (SELECT user_id FROM pairs)",
    "pairs",
)
_filter(
    "drop_null_usage_users",
    lambda w: cohort.drop_null_usage_users(w.tables, w.usage),
    "user_id NOT IN (SELECT user_id FROM usage WHERE total_secs IS NULL)",
    "usage",
)
_filter(
    "drop_expire_year_out_of_range",
    lambda w: cohort.drop_expire_year_out_of_range(w.tables, w.tx),
    """user_id NOT IN (SELECT user_id FROM tx WHERE year(membership_expire_date) < 2015
      OR year(membership_expire_date) > 2017)""",
)
_OUTSIDE = """(is_cancel = 0 AND (actual_plan_days < 1 OR actual_plan_days > 410))
      OR (is_cancel = 1 AND (actual_plan_days < -31 OR actual_plan_days > 410))"""
_filter(
    "drop_plan_days_out_of_range",
    lambda w: cohort.drop_plan_days_out_of_range(w.tables, w.seq),
    f"user_id NOT IN (SELECT user_id FROM seq WHERE {_OUTSIDE})",
    "seq",
)
check(
    "drop_plan_days_out_of_range_counts",
    "b:is_cancel,below_min,above_max,total_out",
    lambda w: cohort.plan_days_out_of_range_counts(w.seq),
    f"""SELECT is_cancel, SUM(CASE WHEN is_cancel = 0 AND actual_plan_days < 1 THEN 1
        WHEN is_cancel = 1 AND actual_plan_days < -31 THEN 1 ELSE 0 END) AS below_min,
      SUM(CASE WHEN actual_plan_days > 410 THEN 1 ELSE 0 END) AS above_max, COUNT(*) AS total_out
    FROM seq WHERE {_OUTSIDE} GROUP BY 1""",
    "seq",
)
_filter(
    "drop_cancel_before_prev_txn",
    lambda w: cohort.drop_cancel_before_prev_txn(w.tables, w.seq),
    "user_id NOT IN (SELECT user_id FROM c8)",
    "c8",
)
_filter(
    "drop_cancel_before_prev2_expire",
    lambda w: cohort.drop_cancel_before_prev2_expire(w.tables, w.seq),
    "user_id NOT IN (SELECT user_id FROM c9)",
    "c9",
)
_filter(
    "drop_consecutive_cancels",
    lambda w: cohort.drop_consecutive_cancels(w.tables, w.seq),
    "user_id NOT IN (SELECT user_id FROM c10)",
    "c10",
)
check(
    "filter_impact",
    "s:table_name b:rows_before,rows_after,rows_removed,users_before,users_after,users_removed d:pct_users_removed",
    lambda w: cohort.filter_impact(w.tables, cohort.drop_same_day_duplicates(w.tables, w.tx)),
    """SELECT table_name, COUNT(*) AS rows_before, SUM(kept) AS rows_after, COUNT(*) - SUM(kept) AS rows_removed,
      COUNT(DISTINCT user_id) AS users_before, COUNT(DISTINCT CASE WHEN kept = 1 THEN user_id END) AS users_after,
      COUNT(DISTINCT CASE WHEN kept = 0 THEN user_id END) AS users_removed,
      100.0 * COUNT(DISTINCT CASE WHEN kept = 0 THEN user_id END) / COUNT(DISTINCT user_id) AS pct_users_removed
    FROM (SELECT *, CASE WHEN user_id IN (SELECT user_id FROM pairs) THEN 0 ELSE 1 END AS kept FROM rows4) x
    GROUP BY 1""",
    "rows4", "pairs",
)


def _flags(w: World) -> DataFrame:
    return cohort.exclusion_flags(cohort.with_previous(w.seq), cohort.null_usage_users(w.usage))


check(
    "exclusion_flags",
    "b:user_id,first_failed_step",
    _flags,
    "SELECT user_id, step AS first_failed_step FROM broken",
    "broken",
)
check(
    "exclusion_counts",
    "b:first_failed_step s:step_name b:user_count",
    lambda w: cohort.exclusion_counts(_flags(w)),
    """SELECT step AS first_failed_step, CASE step WHEN 1 THEN 'same_day_duplicates' WHEN 2 THEN 'null_usage'
      WHEN 3 THEN 'expire_year_out_of_range' WHEN 4 THEN 'plan_days_out_of_range' WHEN 5 THEN 'cancel_before_prev_txn'
      WHEN 6 THEN 'cancel_before_prev2_expire' ELSE 'consecutive_cancels' END AS step_name, COUNT(*) AS user_count
    FROM broken GROUP BY 1, 2""",
    "broken",
)

# --- D: column transforms ---

check(
    "encode_gender",
    "s:msno b:user_id,city,bd,gender,registered_via,registration_init_time",
    lambda w: transform.encode_gender(w.raw_members),
    """SELECT * REPLACE (CASE WHEN gender IS NULL THEN -1 WHEN gender = 'male' THEN 0 WHEN gender = 'female' THEN 1
      ELSE -1 END AS gender) FROM raw_members""",
    "raw_members",
)
check(
    "encode_gender_distribution",
    "b:gender,row_count",
    lambda w: transform.value_distribution(transform.encode_gender(w.raw_members), "gender"),
    "SELECT gender, COUNT(*) AS row_count FROM mem GROUP BY 1",
    "mem",
)
check("parse_int_dates", MEMBERS, lambda w: w.members, "SELECT * FROM mem", "mem")
check(
    "parse_int_dates_report",
    "s:column_name b:total,unset,bad t:min_date,max_date",
    lambda w: transform.int_date_report(w.raw_members),
    """SELECT 'registration_init_time' AS column_name, COUNT(*) AS total,
      SUM(CASE WHEN registration_init_time IS NULL OR registration_init_time = 0 THEN 1 ELSE 0 END) AS unset,
      SUM(CASE WHEN try_strptime(CAST(registration_init_time AS VARCHAR), '%Y%m%d') IS NULL THEN 1 ELSE 0 END) AS bad,
      MIN(try_strptime(CAST(registration_init_time AS VARCHAR), '%Y%m%d')) AS min_date,
      MAX(try_strptime(CAST(registration_init_time AS VARCHAR), '%Y%m%d')) AS max_date FROM raw_members""",
    "raw_members",
)
check("nullify_out_of_range", LOGS, lambda w: w.usage, "SELECT * FROM usage", "usage")
check(
    "nullify_out_of_range_stats",
    "b:total,non_null,null_cnt d:min_val,max_val,avg_val",
    lambda w: transform.range_stats(w.usage, "total_secs"),
    """SELECT COUNT(*) AS total, COUNT(total_secs) AS non_null, COUNT(*) - COUNT(total_secs) AS null_cnt,
      MIN(total_secs) AS min_val, MAX(total_secs) AS max_val, AVG(total_secs) AS avg_val FROM usage""",
    "usage",
)
RULES = [
    {"column": "total_secs", "operator": ">", "value": 86400, "action": "set_value", "new_value": 86400},
    {"column": "total_secs", "operator": "<", "value": 300, "action": "delete_row"},
    {"column": "num_25", "operator": "==", "value": 0, "action": "set_null"},
    {"column": "num_50", "operator": "in", "value": [2, 3], "action": "set_value", "new_value": 9},
    {"column": "num_75", "operator": "not_between", "value": [0, 4], "action": "set_null"},
    {"column": "num_100", "operator": "!=", "value": 1, "action": "set_value", "new_value": 7},
    {"column": "num_25", "operator": "is_null", "action": "set_value", "new_value": -1},
    {"column": "num_985", "operator": "between", "value": [3, 5], "action": "delete_row"},
    {"column": "num_unq", "operator": "<=", "value": 1, "action": "set_null"},
    {"column": "num_unq", "operator": "is_not_null", "action": "set_value", "new_value": 5},
    {"column": "num_50", "operator": "not_in", "value": [0, 1, 9], "action": "delete_row"},
    {"column": "num_985", "operator": ">=", "value": 2, "action": "set_null"},
]
_RULED = """
    r1 AS (SELECT * REPLACE (CASE WHEN total_secs > 86400 THEN 86400 ELSE total_secs END AS total_secs) FROM ul),
    r2 AS (SELECT * FROM r1 WHERE NOT total_secs < 300),
    r3 AS (SELECT * REPLACE (CASE WHEN num_25 = 0 THEN NULL ELSE num_25 END AS num_25) FROM r2),
    r4 AS (SELECT * REPLACE (CASE WHEN num_50 IN (2, 3) THEN 9 ELSE num_50 END AS num_50) FROM r3),
    r5 AS (SELECT * REPLACE (CASE WHEN num_75 NOT BETWEEN 0 AND 4 THEN NULL ELSE num_75 END AS num_75) FROM r4),
    r6 AS (SELECT * REPLACE (CASE WHEN num_100 <> 1 THEN 7 ELSE num_100 END AS num_100) FROM r5),
    r7 AS (SELECT * REPLACE (CASE WHEN num_25 IS NULL THEN -1 ELSE num_25 END AS num_25) FROM r6),
    r8 AS (SELECT * FROM r7 WHERE NOT COALESCE(num_985 BETWEEN 3 AND 5, FALSE)),
    r9 AS (SELECT * REPLACE (CASE WHEN num_unq <= 1 THEN NULL ELSE num_unq END AS num_unq) FROM r8),
    r10 AS (SELECT * REPLACE (CASE WHEN num_unq IS NOT NULL THEN 5 ELSE num_unq END AS num_unq) FROM r9),
    r11 AS (SELECT * FROM r10 WHERE NOT COALESCE(num_50 NOT IN (0, 1, 9), FALSE)),
    r12 AS (SELECT * REPLACE (CASE WHEN num_985 >= 2 THEN NULL ELSE num_985 END AS num_985) FROM r11)
"""
_RULE_TEXTS = (
    ("ul", "total_secs > 86400"), ("r1", "total_secs < 300"), ("r2", "num_25 = 0"), ("r3", "num_50 IN (2, 3)"),
    ("r4", "num_75 NOT BETWEEN 0 AND 4"), ("r5", "num_100 <> 1"), ("r6", "num_25 IS NULL"),
    ("r7", "num_985 BETWEEN 3 AND 5"), ("r8", "num_unq <= 1"), ("r9", "num_unq IS NOT NULL"),
    ("r10", "num_50 NOT IN (0, 1, 9)"), ("r11", "num_985 >= 2"),
)


def _impact_sql(before) -> str:
    parts = [
        f"SELECT {n} AS rule_no, '{RULES[n - 1]['column']}' AS column_name, '{RULES[n - 1]['action']}' AS action, "
        f"COUNT(*) AS affected, 100.0 * COUNT(*) / (SELECT COUNT(*) FROM ul) AS pct_affected "
        f"FROM {before(table)} WHERE {condition}"
        for n, (table, condition) in enumerate(_RULE_TEXTS, start=1)
    ]
    return " UNION ALL ".join(parts)


check("apply_rules", LOGS, lambda w: transform.apply_rules(w.logs, RULES), f"WITH {_RULED} SELECT * FROM r12", "ul")
check(
    "apply_rules_impact",
    "b:rule_no s:column_name,action b:affected d:pct_affected",
    lambda w: transform.rule_impact(w.logs, RULES),
    f"WITH {_RULED} " + _impact_sql(lambda table: table),
    "ul",
)
check(
    "apply_rules_dry_run",
    "b:rule_no s:column_name,action b:affected d:pct_affected",
    lambda w: transform.rule_impact(w.logs, RULES, dry_run=True),
    _impact_sql(lambda table: "ul"),
    "ul",
)


def _converted(w: World) -> DataFrame:
    return transform.convert_unit(w.usage, "total_secs", "total_hours", 3600, clip_min=1, clip_max=20)


_HOURS = """
    SELECT *, CASE WHEN total_secs IS NULL THEN NULL WHEN total_secs / 3600 < 1 THEN 1
      WHEN total_secs / 3600 > 20 THEN 20 ELSE total_secs / 3600 END AS total_hours FROM usage
"""
check("convert_unit", f"{LOGS} d:total_hours", _converted, _HOURS, "usage")
check(
    "convert_unit_report",
    "b:total,source_non_null,target_non_null,clipped_min,clipped_max "
    "d:source_avg,source_min,source_max,target_avg,target_min,target_max,target_median",
    lambda w: transform.conversion_report(_converted(w), "total_secs", "total_hours", 1, 20),
    f"""SELECT COUNT(*) AS total, COUNT(total_secs) AS source_non_null, COUNT(total_hours) AS target_non_null,
      SUM(CASE WHEN total_hours = 1 THEN 1 ELSE 0 END) AS clipped_min,
      SUM(CASE WHEN total_hours = 20 THEN 1 ELSE 0 END) AS clipped_max, AVG(total_secs) AS source_avg,
      MIN(total_secs) AS source_min, MAX(total_secs) AS source_max, AVG(total_hours) AS target_avg,
      MIN(total_hours) AS target_min, MAX(total_hours) AS target_max,
      quantile_cont(total_hours, 0.5) AS target_median FROM ({_HOURS}) x""",
    "usage",
)
check(
    "fill_nulls",
    LOGS,
    lambda w: transform.fill_nulls(w.usage, "total_secs", 0),
    "SELECT * REPLACE (COALESCE(total_secs, 0) AS total_secs) FROM usage",
    "usage",
)
for _method, _value in (
    ("mean", "(SELECT AVG(total_secs) FROM usage)"),
    ("median", "(SELECT quantile_cont(total_secs, 0.5) FROM usage)"),
    (
        "mode",
        "(SELECT total_secs FROM usage WHERE total_secs IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)",
    ),
):
    check(
        f"fill_nulls_{_method}",
        LOGS,
        lambda w, m=_method: transform.fill_nulls(w.usage, "total_secs", method=m),
        f"SELECT * REPLACE (COALESCE(total_secs, {_value}) AS total_secs) FROM usage",
        "usage",
    )
check(
    "add_plan_days_diff",
    f"{SEQ} b:actual_plan_days,plan_days_diff",
    lambda w: transform.add_plan_days_diff(w.seq),
    "SELECT *, payment_plan_days - actual_plan_days AS plan_days_diff FROM seq",
    "seq",
)
_DIFF = """COUNT(*) AS row_count, SUM(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS positive_cnt,
      SUM(CASE WHEN d = 0 THEN 1 ELSE 0 END) AS zero_cnt, SUM(CASE WHEN d < 0 THEN 1 ELSE 0 END) AS negative_cnt,
      ROUND(AVG(d), 2) AS avg_diff, MIN(d) AS min_diff, MAX(d) AS max_diff
    FROM (SELECT is_cancel, payment_plan_days - actual_plan_days AS d FROM seq) x"""
check(
    "add_plan_days_diff_stats",
    "b:is_cancel,row_count,positive_cnt,zero_cnt,negative_cnt d:avg_diff b:min_diff,max_diff",
    lambda w: transform.plan_days_diff_stats(w.seq),
    f"SELECT is_cancel, {_DIFF} GROUP BY 1 UNION ALL SELECT NULL, {_DIFF}",
    "seq",
)

# --- E: sessionization and membership lookup ---

check(
    "sessionize_transactions", SEQ, lambda w: sequence.sessionize_transactions(w.tx), "SELECT * FROM seq", "seq"
)
check(
    "add_actual_plan_days",
    f"{SEQ} b:actual_plan_days",
    lambda w: sequence.add_actual_plan_days(sequence.sessionize_transactions(w.tx)),
    "SELECT * FROM seq",
    "seq",
)
check(
    "add_actual_plan_days_stats",
    "b:total_rows d:avg_actual,avg_payment b:diff_count,min_actual,max_actual",
    lambda w: sequence.actual_plan_days_stats(w.seq),
    """SELECT COUNT(*) AS total_rows, AVG(actual_plan_days) AS avg_actual, AVG(payment_plan_days) AS avg_payment,
      SUM(CASE WHEN actual_plan_days <> payment_plan_days THEN 1 ELSE 0 END) AS diff_count,
      MIN(actual_plan_days) AS min_actual, MAX(actual_plan_days) AS max_actual FROM seq""",
    "seq",
)
check(
    "add_actual_plan_days_largest",
    "b:user_id t:transaction_date,membership_expire_date b:payment_plan_days,actual_plan_days,diff",
    lambda w: sequence.largest_plan_days_differences(w.seq, 20),
    """SELECT user_id, transaction_date, membership_expire_date, payment_plan_days, actual_plan_days,
      actual_plan_days - payment_plan_days AS diff FROM seq WHERE actual_plan_days <> payment_plan_days
    ORDER BY ABS(actual_plan_days - payment_plan_days) DESC, 1, 2, 3, 4 LIMIT 20""",
    "seq",
)
check(
    "membership_seq_info",
    f"{MEMBERS} t:last_expire b:membership_seq_group_id,membership_seq_id",
    lambda w: membership.membership_seq_info(w.members_last, w.seq),
    "SELECT * FROM members3",
    "members3",
)
check(
    "membership_durations",
    f"{MEMBERS} t:last_expire b:membership_seq_group_id,membership_seq_id,previous_membership_duration,"
    "previous_membership_seq_duration",
    lambda w: membership.membership_durations(membership.membership_seq_info(w.members_last, w.seq), w.seq),
    """SELECT m.*, m.last_expire - a.transaction_date AS previous_membership_duration,
      m.last_expire - b.transaction_date AS previous_membership_seq_duration
    FROM members3 m LEFT JOIN seq a ON m.user_id = a.user_id AND m.membership_seq_group_id = a.sequence_group_id
        AND m.membership_seq_id = a.sequence_id
      LEFT JOIN seq b ON m.user_id = b.user_id AND m.membership_seq_group_id = b.sequence_group_id
        AND b.sequence_id = 0""",
    "members3", "seq",
)
check(
    "last_txn_in_window",
    f"{MEMBERS} t:last_expire_date b:last_seq_id,p_tx_id,pp_tx_id",
    lambda w: membership.last_txn_in_window(w.members, w.seq),
    "SELECT * FROM members5",
    "members5",
)
check(
    "attach_label",
    f"{MEMBERS} b:is_churn",
    lambda w: membership.attach_label(w.members, w.train),
    "SELECT * FROM members5",
    "members5",
)


def _payment_at_usage(w: World) -> DataFrame:
    paid = w.seq.withColumnRenamed("transaction_date", "date")
    carried = {"payment_plan_days": "plan_days", "membership_expire_date": "expires", "sequence_group_id": "group_id"}
    return as_of(w.logs.select("user_id", "date"), paid, "user_id", "date", carried, ("sequence_group_id", "sequence_id"))


check(
    "payment_as_of_usage",
    "b:user_id t:date b:plan_days t:expires b:group_id",
    _payment_at_usage,
    """SELECT ul.user_id, ul.date, p.payment_plan_days AS plan_days, p.membership_expire_date AS expires,
      p.sequence_group_id AS group_id
    FROM ul ASOF LEFT JOIN (
      SELECT user_id, transaction_date AS date, unnest(max({'g': sequence_group_id, 's': sequence_id,
        'payment_plan_days': payment_plan_days, 'membership_expire_date': membership_expire_date,
        'sequence_group_id': sequence_group_id})) FROM seq GROUP BY 1, 2) p
      ON ul.user_id = p.user_id AND ul.date >= p.date""",
    "ul", "seq",
)
