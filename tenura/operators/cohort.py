"""Filters that keep or drop whole users across a set of tables.

Every rule yields a set of users with one row each; the tables are then joined to it by semi or anti
join on the key. Keys are non-null from ``build_id_map`` on, so an anti join equals ``NOT IN``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.bins import percent
from tenura.functions.ordered import HOT_ROWS, Lag, ordered
from tenura.functions.sampling import SEED, exact_sample
from tenura.operators.sequence import transaction_order
from tenura.session import materialize

Tables = Mapping[str, DataFrame]

# Bounds of actual plan days per cancel flag: the defaults, and the ones the pipeline uses.
PLAN_DAYS_BOUNDS = {0: (1, 410), 1: (-31, 410)}
PIPELINE_PLAN_DAYS_BOUNDS = {0: (1, 410), 1: (-410, 0)}


def keep_users(tables: Tables, users: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Rows of the given users in every table that has the key."""
    chosen = users.select(key)
    return {n: df.join(chosen, key, "left_semi") if key in df.columns else df for n, df in tables.items()}


def drop_users(tables: Tables, users: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Rows of all other users in every table that has the key."""
    dropped = users.select(key)
    return {n: df.join(dropped, key, "left_anti") if key in df.columns else df for n, df in tables.items()}


def _drop_found(tables: Tables, users: DataFrame, key: str) -> dict[str, DataFrame]:
    """``drop_users`` of users that are dear to find: stored first, so no table's join finds them again."""
    return drop_users(tables, materialize(users.select(key), "dropped"), key)


def table_presence(tables: Tables, key: str = "user_id", flags: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per user: ``in_all``, and for each table named in ``flags`` whether any of its rows meets
    the condition (``flag_<table>``).

    One bit per table, in as many words as it takes, combined per user: one exchange of pre-reduced rows instead of a chain of
    intersections, and one scan for everything asked about the users.
    """
    keyed = {n: df for n, df in tables.items() if key in df.columns}
    if len(keyed) < 2:
        raise ValueError("common users need at least two tables with the key")
    flags = flags or {}
    words = range(-(-len(keyed) // 62))
    complete = [F.bit_or(f"_bits_{w}") == (1 << min(62, len(keyed) - 62 * w)) - 1 for w in words]
    marked = [
        df.select(
            key,
            *[F.lit(1 << n % 62 if n // 62 == w else 0).cast("long").alias(f"_bits_{w}") for w in words],
            *[(flags[f] if f == name else F.lit(None).cast("boolean")).alias(f"flag_{f}") for f in flags],
        )
        for n, (name, df) in enumerate(keyed.items())
    ]
    seen = reduce(DataFrame.union, marked).groupBy(key).agg(
        reduce(lambda x, y: x & y, complete).alias("in_all"),
        *[F.coalesce(F.bool_or(f"flag_{f}"), F.lit(False)).alias(f"flag_{f}") for f in flags],
    )
    return seen.where(F.col(key).isNotNull())


def common_users(tables: Tables, key: str = "user_id") -> DataFrame:
    """Users present in all tables."""
    return table_presence(tables, key).where("in_all").select(key)


def keep_common_users(tables: Tables, key: str = "user_id", require_nonempty: bool = False) -> dict[str, DataFrame]:
    """Keep users present in all tables; ``require_nonempty`` runs the check that there are any."""
    users = common_users(tables, key)
    if require_nonempty and users.isEmpty():
        raise ValueError("the tables have no user in common")
    return keep_users(tables, users, key)


def keep_users_in(tables: Tables, reference: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Keep users present in a reference table."""
    return keep_users(tables, reference.where(F.col(key).isNotNull()).select(key).distinct(), key)


def transition_users(
    v1: DataFrame, v2: DataFrame, v1_label: int = 0, v2_labels: Sequence[int] = (0, 1), key: str = "user_id"
) -> DataFrame:
    """Users labelled ``v1_label`` first and one of ``v2_labels`` later, with the later label."""
    before = v1.where(F.col("is_churn") == v1_label).select(key)
    after = v2.where(F.col("is_churn").isin(list(v2_labels))).select(key, F.col("is_churn").alias("v2_churn"))
    return before.join(after, key)


def transition_label_counts(users: DataFrame) -> DataFrame:
    """Users per later label among ``transition_users``."""
    return users.groupBy("v2_churn").agg(F.count(F.lit(1)).alias("user_count"))


def keep_churn_transition(
    tables: Tables,
    v1: DataFrame,
    v2: DataFrame,
    v1_label: int = 0,
    v2_labels: Sequence[int] = (0, 1),
    key: str = "user_id",
) -> dict[str, DataFrame]:
    """Keep the users of ``transition_users``."""
    return keep_users(tables, transition_users(v1, v2, v1_label, v2_labels, key).select(key).distinct(), key)


def same_day_duplicates(
    transactions: DataFrame, min_txn_count: int = 2, date_col: str = "transaction_date", key: str = "user_id"
) -> DataFrame:
    """(user, date) pairs with at least ``min_txn_count`` non-cancel payments, and the count."""
    counts = transactions.where(F.col("is_cancel") == 0).groupBy(key, date_col)
    return counts.agg(F.count(F.lit(1)).alias("txn_count")).where(F.col("txn_count") >= min_txn_count)


def same_day_duplicate_users(
    transactions: DataFrame, min_txn_count: int = 2, date_col: str = "transaction_date", key: str = "user_id"
) -> DataFrame:
    return same_day_duplicates(transactions, min_txn_count, date_col, key).select(key).distinct()


def null_usage_users(logs: DataFrame, key: str = "user_id", column: str = "total_secs") -> DataFrame:
    return logs.where(F.col(column).isNull()).select(key).distinct()


def expire_year_outside(min_year: int, max_year: int) -> Column:
    year = F.year("membership_expire_date")
    return (year < min_year) | (year > max_year)


def expire_year_out_of_range_users(
    transactions: DataFrame, min_year: int = 2015, max_year: int = 2017, key: str = "user_id"
) -> DataFrame:
    return transactions.where(expire_year_outside(min_year, max_year)).select(key).distinct()


def _below(bounds: Mapping[int, tuple[int, int]]) -> Column:
    days, cancel = F.col("actual_plan_days"), F.col("is_cancel")
    return reduce(Column.__or__, [(cancel == flag) & (days < low) for flag, (low, _) in bounds.items()])


def _above(bounds: Mapping[int, tuple[int, int]]) -> Column:
    days, cancel = F.col("actual_plan_days"), F.col("is_cancel")
    return reduce(Column.__or__, [(cancel == flag) & (days > high) for flag, (_, high) in bounds.items()])


def plan_days_outside(bounds: Mapping[int, tuple[int, int]]) -> Column:
    return _below(bounds) | _above(bounds)


def plan_days_out_of_range_users(
    seq: DataFrame, bounds: Mapping[int, tuple[int, int]] = PLAN_DAYS_BOUNDS, key: str = "user_id"
) -> DataFrame:
    return seq.where(plan_days_outside(bounds)).select(key).distinct()


def plan_days_out_of_range_counts(
    seq: DataFrame, bounds: Mapping[int, tuple[int, int]] = PLAN_DAYS_BOUNDS
) -> DataFrame:
    """Rows below and above the bounds per cancel flag."""
    return (
        seq.where(plan_days_outside(bounds))
        .groupBy("is_cancel")
        .agg(
            F.count_if(_below(bounds)).alias("below_min"),
            F.count_if(_above(bounds)).alias("above_max"),
            F.count(F.lit(1)).alias("total_out"),
        )
    )


def anomaly_steps(rows):
    """What the cancel rules look back at: the previous payment and the expiry two payments back."""
    return rows.add(
        prev_transaction_date=Lag("transaction_date"),
        prev_is_cancel=Lag("is_cancel"),
        prev_expire_date=Lag("membership_expire_date"),
        prev_prev_expire_date=Lag("membership_expire_date", 2),
    )


def cancels_before_prev_txn() -> Column:
    return (F.col("is_cancel") == 1) & (F.col("membership_expire_date") < F.col("prev_transaction_date"))


def cancels_before_prev2_expire() -> Column:
    return (F.col("is_cancel") == 1) & (F.col("membership_expire_date") < F.col("prev_prev_expire_date"))


def cancels_in_a_row() -> Column:
    return (F.col("is_cancel") == 1) & (F.col("prev_is_cancel") == 1)


def with_previous(seq: DataFrame, key: str = "user_id", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Payments with the columns of ``anomaly_steps``."""
    return ordered(seq, key, transaction_order(seq), anomaly_steps, hot_rows=hot_rows)


def cancel_before_prev_txn_users(seq: DataFrame, key: str = "user_id") -> DataFrame:
    return with_previous(seq, key).where(cancels_before_prev_txn()).select(key).distinct()


def cancel_before_prev2_expire_users(seq: DataFrame, key: str = "user_id") -> DataFrame:
    return with_previous(seq, key).where(cancels_before_prev2_expire()).select(key).distinct()


def consecutive_cancel_users(seq: DataFrame, key: str = "user_id") -> DataFrame:
    return with_previous(seq, key).where(cancels_in_a_row()).select(key).distinct()


def drop_same_day_duplicates(
    tables: Tables,
    transactions: DataFrame,
    min_txn_count: int = 2,
    date_col: str = "transaction_date",
    key: str = "user_id",
) -> dict[str, DataFrame]:
    """Drop users with several non-cancel payments on one date."""
    return _drop_found(tables, same_day_duplicate_users(transactions, min_txn_count, date_col, key), key)


def drop_null_usage_users(tables: Tables, logs: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Drop users with any NULL listening time; run after ``nullify_out_of_range``."""
    return _drop_found(tables, null_usage_users(logs, key), key)


def drop_expire_year_out_of_range(
    tables: Tables, transactions: DataFrame, min_year: int = 2015, max_year: int = 2017, key: str = "user_id"
) -> dict[str, DataFrame]:
    """Drop users with any expiry outside the years given."""
    return _drop_found(tables, expire_year_out_of_range_users(transactions, min_year, max_year, key), key)


def drop_plan_days_out_of_range(
    tables: Tables,
    seq: DataFrame,
    bounds: Mapping[int, tuple[int, int]] = PLAN_DAYS_BOUNDS,
    key: str = "user_id",
) -> dict[str, DataFrame]:
    """Drop users with actual plan days outside the bounds of the payment's cancel flag."""
    return _drop_found(tables, plan_days_out_of_range_users(seq, bounds, key), key)


def drop_cancel_before_prev_txn(tables: Tables, seq: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Drop users with a cancel that expires before the previous payment date."""
    return _drop_found(tables, cancel_before_prev_txn_users(seq, key), key)


def drop_cancel_before_prev2_expire(tables: Tables, seq: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Drop users with a cancel that expires before the expiry two payments back."""
    return _drop_found(tables, cancel_before_prev2_expire_users(seq, key), key)


def drop_consecutive_cancels(tables: Tables, seq: DataFrame, key: str = "user_id") -> dict[str, DataFrame]:
    """Drop users with two cancels in a row."""
    return _drop_found(tables, consecutive_cancel_users(seq, key), key)


def filter_impact(before: Tables, after: Tables, key: str = "user_id") -> DataFrame:
    """Rows and users per table before and after a filter, and what it removed.

    Nothing is changed, so this is also the preview of a filter.
    """

    def sizes(name: str, df: DataFrame, stage: str) -> DataFrame:
        per_user = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        return per_user.agg(
            F.lit(name).alias("table_name"),
            F.lit(stage).alias("stage"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
            F.count(key).alias("users"),
        )

    rows = [sizes(n, df, "before") for n, df in before.items()] + [sizes(n, after[n], "after") for n in before]
    staged = reduce(DataFrame.unionByName, rows).groupBy("table_name")

    def pick(stage, column):
        return F.max(F.when(F.col("stage") == stage, F.col(column)))

    return staged.agg(
        pick("before", "rows").alias("rows_before"),
        pick("after", "rows").alias("rows_after"),
        (pick("before", "rows") - pick("after", "rows")).alias("rows_removed"),
        pick("before", "users").alias("users_before"),
        pick("after", "users").alias("users_after"),
        (pick("before", "users") - pick("after", "users")).alias("users_removed"),
        percent(pick("before", "users") - pick("after", "users"), pick("before", "users")).alias("pct_users_removed"),
    )


def removed_keys(before: DataFrame, after: DataFrame, key: str = "user_id") -> DataFrame:
    """The keys a filter removed from a table."""
    return before.select(key).distinct().join(after.select(key), key, "left_anti")


def removed_sample(before: DataFrame, after: DataFrame, size: int = 5, key: str = "user_id", seed: int = SEED) -> DataFrame:
    """Some of the keys a filter removed from a table, the same on every run."""
    return exact_sample(removed_keys(before, after, key), size, [key], seed)


def removed_samples(before: Tables, after: Tables, size: int = 5, key: str = "user_id", seed: int = SEED) -> DataFrame:
    """``removed_sample`` of every table, with its ``table_name``."""
    samples = [
        removed_sample(df, after[name], size, key, seed).select(F.lit(name).alias("table_name"), key) for name, df in before.items()
    ]
    return reduce(DataFrame.union, samples)


# The exclusion rules in the order they are applied (fixed step numbers and names).
EXCLUSION_STEPS = (
    "same_day_duplicates", "null_usage", "expire_year_out_of_range", "plan_days_out_of_range",
    "cancel_before_prev_txn", "cancel_before_prev2_expire", "consecutive_cancels",
)


def exclusion_flags(
    seq: DataFrame,
    null_usage: DataFrame,
    bounds: Mapping[int, tuple[int, int]] = PIPELINE_PLAN_DAYS_BOUNDS,
    min_txn_count: int = 2,
    min_year: int = 2015,
    max_year: int = 2017,
    key: str = "user_id",
) -> DataFrame:
    """The first exclusion rule each user breaks: ``(key, first_failed_step)``, steps from 1.

    Each rule looks at one user's rows only and removes whole users, so all rules can be judged at
    once on the unfiltered tables and one anti join per table replaces seven. ``seq`` needs the
    columns of ``anomaly_steps`` and ``actual_plan_days``; ``null_usage`` are the users of
    ``null_usage_users``.
    """
    rules = (
        expire_year_outside(min_year, max_year),
        plan_days_outside(bounds),
        cancels_before_prev_txn(),
        cancels_before_prev2_expire(),
        cancels_in_a_row(),
    )
    # In the order of the steps, so the first rule that holds is the lowest step.
    step = reduce(lambda acc, n_rule: acc.when(n_rule[1], n_rule[0]), enumerate(rules, start=3), F)
    found = [
        same_day_duplicate_users(seq, min_txn_count, key=key).select(key, F.lit(1).alias("step")),
        null_usage.select(key, F.lit(2).alias("step")),
        seq.select(key, step.alias("step")).where(F.col("step").isNotNull()),
    ]
    return reduce(DataFrame.union, found).groupBy(key).agg(F.min("step").alias("first_failed_step"))


def exclusion_counts(flags: DataFrame) -> DataFrame:
    """Users each step removes when the steps run one after another."""
    names = F.array(*[F.lit(name) for name in EXCLUSION_STEPS])
    return flags.groupBy("first_failed_step").agg(
        F.element_at(names, F.first("first_failed_step")).alias("step_name"), F.count(F.lit(1)).alias("user_count")
    )
