"""Payment histories as membership sequences: ordering, grouping and the gap columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.ordered import HOT_ROWS, Lag, Lead, RunMax, RunSum, ordered

# The two dates order a user's payments; the other payment columns only break ties.
ORDER_DATES = ("transaction_date", "membership_expire_date")
TIE_BREAKERS = (
    "payment_method_id", "payment_plan_days", "plan_list_price", "actual_amount_paid", "is_auto_renew", "is_cancel",
)


def transaction_order(df: DataFrame) -> tuple[str, ...]:
    """Total order of one user's payments; equal ones go by the position they were given, if any."""
    return (*ORDER_DATES, *[c for c in (*TIE_BREAKERS, "sequence_group_id", "sequence_id") if c in df.columns])


def days_between(end: str | Column, start: str | Column) -> Column:
    return F.datediff(end, start).cast("long")


def session_steps(rows, gap_days: int, cutoff_date: str):
    """Group and position columns; a group ends where the next payment is over ``gap_days`` late."""
    rows = rows.derive(_one=F.lit(1)).add(
        _prev_txn=Lag("transaction_date"), _prev_exp=Lag("membership_expire_date"), _at=RunSum("_one")
    )
    # The first payment is known by its place: dates may be NULL.
    first = F.col("_at") == 1
    rows = rows.derive(_new=F.when(first | (F.datediff("transaction_date", "_prev_exp") > gap_days), 1).otherwise(0))
    rows = rows.derive(_starts=F.when(F.col("_new") == 1, F.col("_at")))
    rows = rows.add(_groups=RunSum("_new"), _start=RunMax("_starts"), _next_new=Lead("_new"))
    rows = rows.derive(_ends=F.coalesce(F.col("_next_new") == 1, F.lit(True)))
    open_ended = F.date_add("membership_expire_date", gap_days) > F.lit(cutoff_date).cast("date")
    return rows.derive(
        sequence_group_id=(F.col("_groups") - 1).cast("long"),
        sequence_id=(F.col("_at") - F.col("_start")).cast("long"),
        before_transaction_term=F.when(first, F.lit(-1)).otherwise(days_between("transaction_date", "_prev_txn")).cast(
            "long"
        ),
        before_membership_expire_term=F.when(first, F.lit(-1))
        .otherwise(days_between("transaction_date", "_prev_exp"))
        .cast("long"),
        is_churn=F.when(~F.col("_ends"), 0).when(open_ended, -1).otherwise(1).cast("long"),
    )


def plan_days_steps(rows):
    """Days a payment really adds, measured from the previous expiry while it still runs."""
    rows = rows.add(_prev_exp=Lag("membership_expire_date"))
    fresh = F.col("_prev_exp").isNull() | (F.col("transaction_date") > F.col("_prev_exp"))
    return rows.derive(
        actual_plan_days=days_between(
            "membership_expire_date", F.when(fresh, F.col("transaction_date")).otherwise(F.col("_prev_exp"))
        )
    )


SESSION_COLUMNS = (
    "sequence_group_id", "sequence_id", "before_transaction_term", "before_membership_expire_term", "is_churn",
)


def sessionize_transactions(
    transactions: DataFrame,
    gap_days: int = 30,
    cutoff_date: str = "2017-03-31",
    user: str = "user_id",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Number each user's payments in groups without a break longer than ``gap_days``.

    Group and position start at 0. The two terms are -1 on a user's first payment. ``is_churn`` is 0
    inside a group; on its last payment -1 if the grace period reaches past the cutoff, else 1.
    """
    result = ordered(
        transactions,
        user,
        transaction_order(transactions),
        lambda rows: session_steps(rows, gap_days, cutoff_date),
        hot_rows=hot_rows,
    )
    kept = [c for c in transactions.columns if c not in SESSION_COLUMNS]
    return result.select(*kept, *SESSION_COLUMNS)


def add_actual_plan_days(seq: DataFrame, user: str = "user_id", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Expiry minus payment date on a first or late payment, else expiry minus previous expiry."""
    kept = [c for c in seq.columns if c != "actual_plan_days"]
    result = ordered(seq, user, transaction_order(seq), plan_days_steps, hot_rows=hot_rows)
    return result.select(*kept, "actual_plan_days")


def actual_plan_days_stats(seq: DataFrame) -> DataFrame:
    """Means of actual and paid days, range, and rows where they differ."""
    differs = F.col("actual_plan_days") != F.col("payment_plan_days")
    return seq.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.avg("actual_plan_days").alias("avg_actual"),
        F.avg("payment_plan_days").alias("avg_payment"),
        F.count_if(differs).alias("diff_count"),
        F.min("actual_plan_days").alias("min_actual"),
        F.max("actual_plan_days").alias("max_actual"),
    )


def largest_plan_days_differences(seq: DataFrame, size: int = 10) -> DataFrame:
    """Payments whose actual days are furthest from the paid days."""
    diff = F.col("actual_plan_days") - F.col("payment_plan_days")
    return (
        seq.where(diff != 0)
        .select(
            "user_id", "transaction_date", "membership_expire_date", "payment_plan_days", "actual_plan_days",
            diff.alias("diff"),
        )
        .orderBy(F.desc(F.abs("diff")), "user_id", "transaction_date", "membership_expire_date", "payment_plan_days")
        .limit(size)
    )


def cluster_by_user(df: DataFrame, user: str = "user_id") -> DataFrame:
    """Lay rows out by user and order for writing; a hot user spreads over several files."""
    order = (user, *transaction_order(df)) if "transaction_date" in df.columns else (user, "date")
    return df.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
