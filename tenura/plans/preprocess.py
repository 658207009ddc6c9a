"""From raw extracts to the filtered, sequenced tables the features are built on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions.ordered import HOT_ROWS, ordered
from tenura.operators import cohort
from tenura.operators.keys import apply_id_map, number_keys
from tenura.operators.membership import REFERENCE_WINDOW, attach_label, last_txn_in_window
from tenura.operators.merge import merge_versions
from tenura.operators.sequence import SESSION_COLUMNS, plan_days_steps, session_steps, transaction_order
from tenura.operators.transform import (
    add_plan_days_diff,
    convert_unit,
    encode_gender,
    int_date_reports,
    nullify_out_of_range,
    parse_int_dates,
)
from tenura.session import materialize, stages
from tenura.sources.tables import rename_key_column

BASE_NAMES = ("raw_train", "raw_transactions", "raw_user_logs", "raw_members")
PREVIOUS_COLUMNS = ("prev_transaction_date", "prev_is_cancel", "prev_expire_date", "prev_prev_expire_date")


@dataclass(frozen=True)
class PreprocessSettings:
    """Thresholds of the pipeline."""

    v1_label: int = 0
    v2_labels: tuple[int, ...] = (0, 1)
    min_txn_count: int = 2
    usage_bounds: tuple[float, float] = (0, 86400)
    expire_years: tuple[int, int] = (2015, 2017)
    gap_days: int = 30
    cutoff_date: str = "2017-03-31"
    plan_days_bounds: Mapping[int, tuple[int, int]] = field(
        default_factory=lambda: dict(cohort.PIPELINE_PLAN_DAYS_BOUNDS)
    )
    reference_window: tuple[str, str] = REFERENCE_WINDOW
    hot_rows: int | None = HOT_ROWS


def sequence_table(
    transactions: DataFrame,
    gap_days: int = 30,
    cutoff_date: str = "2017-03-31",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Sequence, plan day and look-back columns together: one exchange and one sort for all of them."""

    def steps(rows):
        return cohort.anomaly_steps(plan_days_steps(session_steps(rows, gap_days, cutoff_date)))

    rows = ordered(transactions, "user_id", transaction_order(transactions), steps, hot_rows=hot_rows)
    kept = [c for c in transactions.columns if c not in SESSION_COLUMNS]
    return add_plan_days_diff(rows.select(*kept, *SESSION_COLUMNS, "actual_plan_days", *PREVIOUS_COLUMNS))


def exclude(
    transactions: DataFrame, null_usage: DataFrame, settings: PreprocessSettings = PreprocessSettings()
) -> tuple[DataFrame, DataFrame]:
    """Sequence table with its look-back columns, and the first exclusion rule each user breaks.

    Both are stored, as they are read again for the final tables.
    """
    seq = materialize(
        sequence_table(transactions, settings.gap_days, settings.cutoff_date, settings.hot_rows), "seq"
    )
    flags = cohort.exclusion_flags(
        seq, null_usage, settings.plan_days_bounds, settings.min_txn_count, *settings.expire_years
    )
    return seq, materialize(flags, "flags")


def preprocess(
    tables: Mapping[str, DataFrame], settings: PreprocessSettings = PreprocessSettings()
) -> dict[str, DataFrame]:
    """Run the whole pipeline on raw tables ``raw_<name>_v<n>`` keyed by ``msno``.

    Returns ``train_merge``, ``transactions_merge``, ``user_logs_merge``, ``members_merge``,
    ``transactions_seq``, ``user_id_map``, ``exclusion_counts`` and ``date_report``, which counts the integer dates of the
    raw tables that are no date. Both raw train versions are needed for the label transition.

    What decides about a user is found first, so that the large usage table is scanned once for its
    keys and times and joined once, to the users that remain. Of the tables stored on the way, those that no result reads are
    deleted at the end.
    """
    missing = [n for n in ("raw_train_v1", "raw_train_v2") if n not in tables]
    if missing:
        raise ValueError(f"missing tables: {missing}")
    with stages(tables["raw_train_v1"].sparkSession) as stored:
        result = _preprocessed(tables, settings)
        stored.release(*result.values())
    return result


def _preprocessed(tables: Mapping[str, DataFrame], settings: PreprocessSettings) -> dict[str, DataFrame]:
    merged = merge_versions(tables, BASE_NAMES)
    names = [f"{base.removeprefix('raw_')}_merge" for base in BASE_NAMES]
    targets = {name: merged[name] for name in names}

    # One scan per table: its users, and whether their usage has NULL or impossible times.
    low, high = settings.usage_bounds
    usable = F.coalesce(F.col("total_secs").between(low, high), F.lit(False))
    presence = materialize(
        cohort.table_presence(targets, "msno", {"user_logs_merge": ~usable}), "presence"
    )
    id_map = number_keys(presence)
    moved = cohort.transition_users(
        tables["raw_train_v1"], tables["raw_train_v2"], settings.v1_label, settings.v2_labels, key="msno"
    )
    candidates = materialize(
        id_map.join(presence.where("in_all"), "msno").join(moved.select("msno"), "msno", "left_semi"), "candidates"
    )

    def typed(name: str, users: DataFrame) -> DataFrame:
        mapped = apply_id_map({name: targets[name]}, users.select("msno", "user_id"))
        return rename_key_column({name: parse_int_dates(mapped[name])})[name]

    null_usage = candidates.where("flag_user_logs_merge").select("user_id")
    transactions = typed("transactions_merge", candidates)
    seq, flags = exclude(transactions, null_usage, settings)
    users = materialize(candidates.join(flags, "user_id", "left_anti"), "users")

    seq = seq.drop(*PREVIOUS_COLUMNS).join(flags, "user_id", "left_anti")
    train = typed("train_merge", users)
    members = last_txn_in_window(
        encode_gender(typed("members_merge", users)), seq, settings.reference_window
    )
    logs = nullify_out_of_range(typed("user_logs_merge", users), "total_secs", low, high)
    return {
        "train_merge": train,
        # The sequence table holds the same payments with more columns.
        "transactions_merge": seq.select(*transactions.columns),
        "user_logs_merge": convert_unit(logs, "total_secs", "total_hours", divisor=3600),
        "members_merge": attach_label(members, train),
        "transactions_seq": seq,
        "user_id_map": id_map,
        "exclusion_counts": cohort.exclusion_counts(flags),
        "date_report": int_date_reports(tables),
    }
