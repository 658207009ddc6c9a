"""Day-by-day tables and the simple per-user summaries around a reference date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.ordered import HOT_ROWS, Lead, RunLast, RunMax, ordered
from tenura.operators.features import PLAYS, SECONDS_PER_HOUR
from tenura.operators.sequence import transaction_order


def _day(value: str | Column) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def dense_daily_grid(
    logs: DataFrame,
    start: str,
    end: str,
    base_date: str | None = None,
    columns: Sequence[str] | None = None,
    user: str = "user_id",
) -> DataFrame:
    """Every user on every day from ``start`` to ``end``; days without a row hold 0, NULLs of a row stay.

    ``date_idx`` counts days from ``base_date`` (default ``start``). Days are unfolded in the tasks
    that hold the users and joined on (user, day); nothing is collected.
    """
    columns = list(columns) if columns else [c for c in logs.columns if c not in (user, "date")]
    days = F.sequence(_day(start), _day(end))
    grid = logs.select(user).distinct().select(user, F.explode(days).alias("date"))
    inside = logs.where(F.col("date").between(_day(start), _day(end))).select(
        user, "date", *columns, F.lit(True).alias("_recorded")
    )
    filled = {c: F.when(F.col("_recorded"), F.col(c)).otherwise(F.lit(0).cast(logs.schema[c].dataType)) for c in columns}
    index = F.datediff("date", _day(base_date or start))
    return (
        grid.join(inside, [user, "date"], "left")
        .select(user, "date", *[value.alias(c) for c, value in filled.items()])
        .withColumn("date_idx", index)
        .sortWithinPartitions(user, "date_idx")
    )


def daily_logs_with_transactions(logs: DataFrame, transactions: DataFrame, user: str = "user_id") -> DataFrame:
    """Usage rows with the payments of the same user and day, NULL where there is none."""
    paid = transactions.withColumn("date", F.col("transaction_date"))
    return logs.join(paid, [user, "date"], "left")


def ffill_transactions(
    daily: DataFrame,
    columns: Sequence[str],
    stop_at_expiry: bool = False,
    expire_column: str = "membership_expire_date",
    marker: str = "transaction_date",
    user: str = "user_id",
    hot_rows: int | None = HOT_ROWS,
    payments: DataFrame | None = None,
) -> DataFrame:
    """Carry the fields of the last payment (a row where ``marker`` is set) to the rows after it.

    With ``stop_at_expiry`` only to days before the carried expiry. With ``payments``, days before a user's
    first payment in ``daily`` get the fields of the last payment before the user's first day; it is also where
    hot users are looked for. Those payments are rows of the same stream, so ``daily`` is read once.
    """
    carried = list(dict.fromkeys([*columns, expire_column] if stop_at_expiry else columns))
    order = ("date", *[c for c in transaction_order(daily) if c in daily.columns])
    own = F.when(F.col(marker).isNotNull(), F.struct(*carried))

    def steps(rows):
        return rows.derive(_payment=own).add(_last=RunLast("_payment"))

    def steps_with_earlier(rows):
        # Until a user's first day, payments of the other table count; from then on, those of the days.
        rows = rows.add(_begun=RunMax("_is_day"))
        return rows.derive(_payment=F.when(F.col("_is_day") == 1, own).when(F.col("_begun") == 0, own)).add(_last=RunLast("_payment"))

    if payments is None:
        rows = ordered(daily, user, order, steps, hot_rows=hot_rows)
    else:
        days = daily.withColumn("_is_day", F.lit(1))
        known = set(daily.columns)
        earlier = payments.where(F.col(marker).isNotNull()).withColumn("date", F.col(marker)).withColumn("_is_day", F.lit(0))
        stream = days.unionByName(earlier.select(*[c for c in earlier.columns if c in known or c == "_is_day"]), allowMissingColumns=True)
        stream = stream.withColumn("_after", 1 - F.col("_is_day"))
        rows = ordered(stream, user, ("date", "_after", *order[1:]), steps_with_earlier, hot_rows=hot_rows, counted=payments)
        rows = rows.where("_is_day = 1")
    last = F.col("_last")
    if stop_at_expiry:
        last = F.when(F.col("date") < last.getField(expire_column), last)
    filled = {c: last.getField(c) for c in columns}
    return rows.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in daily.columns])


def payment_intervals(
    payments: DataFrame, user: str = "user_id", marker: str = "transaction_date", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Payments that hold for a day or more, with ``valid_from`` and ``valid_to`` (exclusive, NULL for a user's last).

    A payment holds from its day until the day of the next one; of several on one day, the last holds. Rows without a date
    never hold.
    """
    dated = payments.where(F.col(marker).isNotNull()).withColumn("valid_from", F.col(marker))
    order = ("valid_from", *[c for c in transaction_order(payments) if c in payments.columns])
    rows = ordered(dated, user, order, lambda rows: rows.add(valid_to=Lead("valid_from")), hot_rows=hot_rows)
    return rows.where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))


def daily_payments(
    payments: DataFrame,
    start: str,
    end: str,
    columns: Sequence[str],
    stop_at_expiry: bool = False,
    expire_column: str = "membership_expire_date",
    user: str = "user_id",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """For each user and day from ``start`` to ``end`` the ``columns`` of the payment that holds, if one does.

    Intervals are cut to the range before they are unfolded, so a payment makes no more rows than it has days in the
    range, and what held before the first day is there without a lookup. With ``stop_at_expiry`` a payment holds no longer than to
    the day before its expiry. Joins with usage on (user, day) complete a grid.
    """
    held = payment_intervals(payments, user, hot_rows=hot_rows)
    beyond = F.date_add(_day(end), 1)
    ends = [F.coalesce("valid_to", beyond), beyond]
    if stop_at_expiry:
        ends.append(F.coalesce(expire_column, _day(start)))
    cut = held.withColumns({"_a": F.greatest("valid_from", _day(start)), "_b": F.least(*ends)}).where(F.col("_a") < F.col("_b"))
    days = F.sequence("_a", F.date_sub("_b", 1))
    return cut.select(user, F.explode(days).alias("date"), *columns)


def clip_date_floor(df: DataFrame, column: str, floor: str) -> DataFrame:
    """Dates before ``floor`` become ``floor``; NULL stays."""
    return df.withColumn(column, F.when(F.col(column) < _day(floor), _day(floor)).otherwise(F.col(column)))


def recent_activity(
    logs: DataFrame, reference_date: str = "2017-03-01", days: int = 30, until: str | None = None
) -> DataFrame:
    """Rows, hours, mean hours and last day since ``days`` before the reference date.

    There is no upper bound unless ``until`` (exclusive) is given.
    """
    recent = logs.where(F.col("date") >= F.date_sub(_day(reference_date), days))
    if until is not None:
        recent = recent.where(F.col("date") < _day(until))
    return recent.groupBy("user_id").agg(
        F.count(F.lit(1)).alias(f"active_days_{days}d"),
        F.sum("total_hours").alias(f"total_hours_{days}d"),
        F.avg("total_hours").alias(f"avg_hours_{days}d"),
        F.max("date").alias("last_active_date"),
    )


def txn_summary(transactions: DataFrame) -> DataFrame:
    """Payments, mean amount, cancels and last payment date per user."""
    return transactions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.avg("actual_amount_paid").alias("avg_paid"),
        F.count_if(F.col("is_cancel") == 1).alias("cancel_count"),
        F.max("transaction_date").alias("last_txn_date"),
    )


def wide_user_join(labels: DataFrame, members: DataFrame, logs: DataFrame) -> DataFrame:
    """Labels with the profile columns and the total hours of each user."""
    hours = logs.groupBy("user_id").agg(F.sum("total_hours").alias("total_hours"))
    profile = members.drop("is_churn") if "is_churn" in members.columns else members
    return labels.join(profile, "user_id", "left").join(hours, "user_id", "left")


def usage_window_features(
    logs: DataFrame,
    reference_date: str = "2017-03-01",
    windows: Sequence[int] = (7, 14, 30, 90),
    trend_days: int = 14,
) -> DataFrame:
    """Usage before a reference date: hours and active days per trailing window, change of the daily
    mean between the last two windows of ``trend_days``, share of full plays, days since the last use.

    Usage is first reduced to one row per user and day, which also makes active days a plain count.
    """
    before = logs.where(F.col("date") < _day(reference_date))
    days = before.groupBy("user_id", "date").agg(
        *[F.sum(c).alias(c) for c in PLAYS], F.sum("total_secs").alias("_secs")
    )
    age = F.datediff(_day(reference_date), "date")
    hours = F.coalesce(F.col("_secs"), F.lit(0.0)) / F.lit(SECONDS_PER_HOUR)

    def hours_between(low: int, high: int) -> Column:
        return F.sum(F.when((age > low) & (age <= high), hours).otherwise(0.0))

    plays = sum((F.sum(c) for c in PLAYS[1:]), F.sum(PLAYS[0]))
    trend = (hours_between(0, trend_days) - hours_between(trend_days, 2 * trend_days)) / F.lit(float(trend_days))
    return days.groupBy("user_id").agg(
        *[hours_between(0, n).alias(f"hours_{n}d") for n in windows],
        *[F.count_if(age <= n).alias(f"active_days_{n}d") for n in windows],
        trend.alias("daily_mean_change"),
        (F.sum("num_100").cast("double") / F.nullif(plays.cast("double"), F.lit(0.0))).alias("full_play_share"),
        F.min(age).cast("long").alias("days_since_last_log"),
    )


def payment_pattern_features(transactions: DataFrame, reference_date: str = "2017-03-01") -> DataFrame:
    """Payments before a reference date: mean amount, payments per 30 days since the first, days
    since the last, share of automatic renewals."""
    before = transactions.where(F.col("transaction_date") < _day(reference_date))
    since_first = F.datediff(_day(reference_date), F.min("transaction_date"))
    return before.groupBy("user_id").agg(
        F.avg("actual_amount_paid").alias("avg_paid"),
        (F.count(F.lit(1)) * F.lit(30.0) / since_first).alias("txn_per_month"),
        F.datediff(_day(reference_date), F.max("transaction_date")).cast("long").alias("days_since_last_payment"),
        F.avg(F.col("is_auto_renew").cast("double")).alias("auto_renew_share"),
    )


def sequence_pattern_features(seq: DataFrame) -> DataFrame:
    """Groups, length of the current group, mean days between payments, any past churn per user."""
    term = F.col("before_transaction_term")
    figures = seq.groupBy("user_id").agg(
        F.max(F.struct("sequence_group_id", "sequence_id")).alias("_last"),
        F.avg(F.when(term != -1, term)).alias("avg_transaction_term"),
        F.max(F.when(F.col("is_churn") == 1, 1).otherwise(0)).alias("ever_churned"),
    )
    return figures.select(
        "user_id",
        (F.col("_last.sequence_group_id") + 1).alias("group_count"),
        (F.col("_last.sequence_id") + 1).alias("current_group_length"),
        "avg_transaction_term",
        "ever_churned",
    )
