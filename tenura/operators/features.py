"""Per-user features over the membership that the reference payment started."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.months import MONTH, in_months
from tenura.operators.sequence import days_between
from tenura.session import materialize

PLAYS = ("num_25", "num_50", "num_75", "num_985", "num_100")
USAGE_COUNTS = (*PLAYS, "num_unq")

LOG_AVERAGES = (*[f"{c}_avg" for c in USAGE_COUNTS], "total_hours_avg")
LOG_GAP_TERMS = ("log_term_min", "log_term_max", "log_term_avg", "log_term_median")
EXPIRY_WEEKS = ("week_1", "week_2", "week_3", "week_4")
PLAY_RATIOS = ("num_25_ratio", "num_100_ratio")
LOG_FEATURES = (
    *LOG_AVERAGES, *LOG_GAP_TERMS, "log_days_ratio", "week_day_ratio", "log_acc", "max_ratio", "log_std",
    *EXPIRY_WEEKS, *PLAY_RATIOS,
)
TRANSACTION_FEATURES = (
    "payment_plan_months", "last_is_cancel", "payment_method_id", "membership_months", "tx_seq_length",
    "cancel_exist", "had_churn",
)
MEMBER_FEATURES = ("registration_dur", "actual_plan_months")
FEATURES = (*LOG_FEATURES, *TRANSACTION_FEATURES, *MEMBER_FEATURES)

DAYS_PER_MONTH = 30.0
SECONDS_PER_HOUR = 3600.0
# Keeps the share of the last week defined when both weeks are silent.
SILENCE = 1e-7

# Weekdays by Spark's numbering (Sunday is 1): the documented Monday to Friday, and Tuesday to
# Saturday, which is what the same text selects where Sunday is 0.
WEEKDAYS = {"documented": (2, 6), "as_executed": (3, 7)}

# Positions of a payment group that one task reads together (see membership_history).
POSITIONS_PER_BUCKET = 10_000


def months(days: Column) -> Column:
    return days.cast("double") / F.lit(DAYS_PER_MONTH)


def _with_window(members: DataFrame) -> DataFrame:
    return members.where(F.col("last_expire_date").isNotNull())


def user_last_txn(members: DataFrame, seq: DataFrame) -> DataFrame:
    """The reference payment of each member and the usage window it opens."""
    payment = seq.select(
        "user_id",
        F.col("sequence_group_id").alias("last_seq_id"),
        F.col("sequence_id").alias("p_tx_id"),
        F.col("transaction_date").alias("last_txn_date"),
        "payment_plan_days",
        F.col("is_cancel").alias("last_is_cancel"),
        "payment_method_id",
    )
    return (
        _with_window(members)
        .select("user_id", "last_expire_date", "last_seq_id", "p_tx_id", "pp_tx_id", "is_churn")
        .join(payment, ["user_id", "last_seq_id", "p_tx_id"])
        .select(
            "user_id", "last_expire_date", "last_seq_id", "p_tx_id", "pp_tx_id", "is_churn", "last_txn_date",
            "payment_plan_days", "last_is_cancel", "payment_method_id",
            days_between("last_expire_date", "last_txn_date").alias("membership_period"),
            F.col("last_txn_date").alias("log_start_date"),
            F.col("last_expire_date").alias("log_end_date"),
        )
    )


def _bucket(position: Column) -> Column:
    """First position of the bucket a position falls into."""
    return position - position % POSITIONS_PER_BUCKET


def _prefix_rows(members: DataFrame, seq: DataFrame, last: Column, payment_columns: tuple[str, ...]) -> DataFrame:
    """Each member with the payments of its group at positions 0 to ``last``.

    Positions are cut into buckets that take part in the join key: a group of millions of payments is
    read by many tasks, an ordinary one by a single one. Payments are merged, never broadcast, whatever size Spark takes
    their files to unpack to.
    """
    last_bucket = _bucket(F.greatest(last, F.lit(0)))
    asked = members.withColumn(
        "_bucket", F.explode(F.sequence(F.lit(0).cast("long"), last_bucket, F.lit(POSITIONS_PER_BUCKET).cast("long")))
    )
    paid = seq.select(
        F.col("user_id").alias("_user"),
        F.col("sequence_group_id").alias("_group"),
        F.col("sequence_id").alias("_pos"),
        _bucket(F.col("sequence_id")).alias("_pbucket"),
        *[F.col(c).alias(f"_{c}") for c in payment_columns],
    )
    return asked.join(
        paid.hint("merge"),
        (F.col("user_id") == F.col("_user"))
        & (F.col("last_seq_id") == F.col("_group"))
        & (F.col("_bucket") == F.col("_pbucket"))
        & (F.col("_pos") <= last),
        "left",
    )


def _history(earlier: Column) -> list[Column]:
    """Aggregates over the payments before the reference payment."""
    return [
        F.count_if(earlier).alias("tx_seq_length"),
        F.coalesce(F.max(F.when(earlier & (F.col("_is_cancel") == 1), 1)), F.lit(0)).alias("cancel_exist"),
        days_between(
            F.max(F.when(earlier, F.col("_membership_expire_date"))),
            F.min(F.when(earlier, F.col("_transaction_date"))),
        ).alias("membership_duration"),
    ]


def membership_history(members: DataFrame, seq: DataFrame) -> DataFrame:
    """Payments of the group before the reference payment: count, any cancel, span in days."""
    base = _with_window(members).select("user_id", "last_seq_id", "p_tx_id")
    rows = _prefix_rows(
        base, seq, F.col("p_tx_id") - 1, ("is_cancel", "transaction_date", "membership_expire_date")
    )
    # One row per member, so the user alone groups, and the joins on the user need no exchange after.
    history = rows.groupBy("user_id").agg(
        F.max("last_seq_id").alias("last_seq_id"), *_history(F.col("_pos") < F.col("p_tx_id"))
    )
    return history.withColumn("had_churn", F.when(F.col("last_seq_id") > 0, 1).otherwise(0))


def daily_usage(logs: DataFrame) -> DataFrame:
    """Usage summed per user and day, with ``n_rows`` the rows behind it.

    Reduces a user of any size to one row per calendar day before the first exchange; all usage
    features are the same on it.
    """
    rows = F.col("n_rows") if "n_rows" in logs.columns else F.lit(1)
    carried = [c for c in ("days_before_expire", "membership_period") if c in logs.columns]
    return logs.groupBy("user_id", *carried, "date").agg(
        *[F.sum(c).alias(c) for c in (*USAGE_COUNTS, "total_secs")], F.sum(rows).cast("long").alias("n_rows")
    )


def logs_in_membership(logs: DataFrame, last_txn: DataFrame) -> DataFrame:
    """Usage rows from the reference payment up to the day before the expiry.

    The window is unfolded into its days and joined on (user, day): an equi join whose key is as fine
    as the usage itself, and the same one ``daily_usage`` leaves its output partitioned by. Of usage stored by month
    (``sources.layout``), only the months that a window meets are read.

    The days are sorted and merged, never broadcast: Spark takes an unfolded table to be as large as the one before, and a
    stored window of a few MB is then sent to the driver and all tasks with every day of every membership.
    """
    if MONTH in logs.columns:
        logs = in_months(logs, last_txn, "log_start_date", "log_end_date")
    days = F.sequence("log_start_date", F.date_sub("log_end_date", 1))
    window = last_txn.where(F.col("log_start_date") < F.col("log_end_date")).select(
        "user_id", "log_end_date", "membership_period", F.explode(days).alias("date")
    )
    optional = [c for c in ("n_rows",) if c in logs.columns]
    return logs.join(window.hint("merge"), ["user_id", "date"]).select(
        "user_id", "date", *USAGE_COUNTS, "total_secs",
        (F.col("total_secs") / F.lit(SECONDS_PER_HOUR)).alias("total_hours"),
        days_between("log_end_date", "date").alias("days_before_expire"),
        "membership_period",
        *optional,
    )


def usage_profile(filtered: DataFrame, weekday_mode: str = "documented") -> DataFrame:
    """All usage features of the users with usage, out of the rows of ``logs_in_membership``.

    One chain: per day, then per week, then per user. After the daily step a user has at most one row
    per calendar day, so the only window and the gap lists are bounded by the membership's length.
    Columns not asked for are pruned, which is how the single feature blocks are made.
    """
    first_day, last_day = WEEKDAYS[weekday_mode]
    hours = F.col("total_secs") / F.lit(SECONDS_PER_HOUR)
    left, period = F.col("days_before_expire"), F.col("membership_period")
    by_date = Window.partitionBy("user_id").orderBy("date")

    def hours_if(condition: Column) -> Column:
        return F.sum(F.when(condition, hours).otherwise(0.0))

    days = daily_usage(filtered).withColumn("_gap", F.datediff("date", F.lag("date").over(by_date)).cast("long"))
    weeks = days.groupBy("user_id", "membership_period", F.trunc("date", "week").alias("_week")).agg(
        *[F.sum(c).alias(c) for c in (*USAGE_COUNTS, "total_secs", "n_rows")],
        F.count(F.lit(1)).alias("_days"),
        F.sum(hours).alias("_hours"),
        hours_if(F.dayofweek("date").between(first_day, last_day)).alias("_weekday_hours"),
        hours_if(left >= period - 7).alias("_first_hours"),
        *[hours_if(left.between(7 * n, 7 * n + 6)).alias(f"week_{n + 1}") for n in range(4)],
        hours_if(left < 7).alias("_last_hours"),
        F.max(left).alias("_first_left"),
        F.min(left).alias("_last_left"),
        F.collect_list("_gap").alias("_gaps"),
    )
    user = weeks.groupBy("user_id", "membership_period").agg(
        *[F.sum(c).alias(c) for c in (*USAGE_COUNTS, "total_secs", "n_rows")],
        F.sum("_days").alias("_days"),
        F.sum("_first_hours").alias("_first_hours"),
        F.sum("_last_hours").alias("_last_hours"),
        *[F.sum(c).alias(c) for c in EXPIRY_WEEKS],
        F.max("_hours").alias("_max_hours"),
        F.avg(F.when(F.col("_hours") > 0, F.col("_weekday_hours") / F.col("_hours"))).alias("week_day_ratio"),
        F.coalesce(F.stddev_samp("_hours"), F.lit(0.0)).alias("log_std"),
        F.max("_first_left").alias("_first_left"),
        F.min("_last_left").alias("_last_left"),
        F.flatten(F.collect_list("_gaps")).alias("_gaps"),
    )
    # Gaps between days, plus the two at the edges; further rows of one day are gaps of 0, counted
    # rather than listed.
    user = user.withColumns(
        {
            "_gaps": F.sort_array(F.concat("_gaps", F.array(period - F.col("_first_left"), F.col("_last_left")))),
            "_zeros": F.col("n_rows") - F.col("_days"),
        }
    )
    count = F.col("n_rows") + 1

    def nth_gap(n: Column) -> Column:
        return F.when(n < F.col("_zeros"), F.lit(0).cast("long")).otherwise(
            F.element_at("_gaps", (n - F.col("_zeros") + 1).cast("int"))
        )

    per_day = F.nullif(period.cast("double"), F.lit(0.0))
    plays = F.nullif(sum((F.col(c) for c in PLAYS[1:]), F.col(PLAYS[0])).cast("double"), F.lit(0.0))
    median = (nth_gap(F.floor((count - 1) / 2)) + nth_gap(F.ceil((count - 1) / 2))).cast("double") / 2
    return user.select(
        "user_id",
        "membership_period",
        *[(F.col(c).cast("double") / per_day).alias(f"{c}_avg") for c in USAGE_COUNTS],
        (hours / per_day).alias("total_hours_avg"),
        months(nth_gap(F.lit(0))).alias("log_term_min"),
        months(nth_gap(count - 1)).alias("log_term_max"),
        months(period.cast("double") / count).alias("log_term_avg"),
        months(median).alias("log_term_median"),
        (F.col("_days").cast("double") / per_day).alias("log_days_ratio"),
        "week_day_ratio",
        (F.col("_last_hours") / (F.col("_first_hours") + F.col("_last_hours") + F.lit(SILENCE))).alias("log_acc"),
        F.when(F.col("_max_hours") > 0, F.col("_last_hours") / F.col("_max_hours")).otherwise(0.0).alias("max_ratio"),
        "log_std",
        *EXPIRY_WEEKS,
        *[(F.col(c).cast("double") / plays).alias(f"{c}_ratio") for c in ("num_25", "num_100")],
    )


def log_averages(filtered: DataFrame) -> DataFrame:
    """Seven usage sums per day of the membership."""
    return usage_profile(filtered).select("user_id", "membership_period", *LOG_AVERAGES)


def log_gap_terms(filtered: DataFrame, last_txn: DataFrame) -> DataFrame:
    """Least, largest, mean and median days without usage, edges included, in months.

    Users without usage get the whole membership period.
    """
    found = usage_profile(filtered).select("user_id", *LOG_GAP_TERMS)
    whole = months(F.col("membership_period"))
    return (
        last_txn.select("user_id", "membership_period")
        .join(found, "user_id", "left")
        .select("user_id", *[F.coalesce(F.col(c), whole).alias(c) for c in LOG_GAP_TERMS])
    )


def log_days_ratio(filtered: DataFrame) -> DataFrame:
    """Share of the membership's days with usage."""
    return usage_profile(filtered).select("user_id", "log_days_ratio")


def weekday_ratio(filtered: DataFrame, weekday_mode: str = "documented") -> DataFrame:
    """Mean over weeks of the weekday share of the hours; silent weeks do not count."""
    return usage_profile(filtered, weekday_mode).select("user_id", "week_day_ratio")


def listening_acceleration(filtered: DataFrame) -> DataFrame:
    """Last week's share of the first and last week's hours."""
    return usage_profile(filtered).select("user_id", "log_acc")


def max_week_ratio(filtered: DataFrame) -> DataFrame:
    """Last week's hours over the best week's, 0 without any."""
    return usage_profile(filtered).select("user_id", "max_ratio")


def weekly_std(filtered: DataFrame) -> DataFrame:
    """Sample deviation of the weekly hours, 0 for a single week."""
    return usage_profile(filtered).select("user_id", "log_std")


def expiry_week_buckets(filtered: DataFrame) -> DataFrame:
    """Hours in each of the last four weeks before the expiry."""
    return usage_profile(filtered).select("user_id", *EXPIRY_WEEKS)


def play_ratios(filtered: DataFrame) -> DataFrame:
    """Shares of early skips and of full plays among all plays."""
    return usage_profile(filtered).select("user_id", *PLAY_RATIOS)


def null_policy(df: DataFrame, columns: tuple[str, ...], fill: float | None = 0.0) -> DataFrame:
    """Fill NULLs of the columns with a default, or keep them when ``fill`` is None."""
    if fill is None:
        return df
    kinds = {field.name: field.dataType for field in df.schema.fields}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(fill).cast(kinds[c])) for c in columns})


def _complete(users: DataFrame, profile: DataFrame, fill: float | None) -> DataFrame:
    """Usage features of all users in ``users``, which has ``user_id`` and ``membership_period``."""
    whole = months(F.col("membership_period"))
    joined = users.join(profile.drop("membership_period").hint("merge"), "user_id", "left")
    joined = joined.withColumns({c: F.coalesce(F.col(c), whole) for c in LOG_GAP_TERMS})
    return null_policy(joined, tuple(c for c in LOG_FEATURES if c not in LOG_GAP_TERMS), fill)


def user_logs_features(
    last_txn: DataFrame,
    filtered: DataFrame,
    weekday_mode: str = "documented",
    fill: float | None = 0.0,
) -> DataFrame:
    """The 22 usage features of every user of ``last_txn``; users without usage get ``fill``."""
    users = last_txn.select("user_id", "membership_period")
    return _complete(users, usage_profile(filtered, weekday_mode), fill).select("user_id", *LOG_FEATURES)


def _plan_months(last_is_cancel: Column, own: Column, previous: Column) -> Column:
    return months(F.when((last_is_cancel == 1) & previous.isNotNull(), previous).otherwise(own))


def _actual_months(is_cancel: Column, expire: Column, own: Column, previous: Column) -> Column:
    start = F.when((is_cancel == 1) & previous.isNotNull(), previous).otherwise(own)
    return months(F.datediff(expire, start))


def transactions_features(last_txn: DataFrame, history: DataFrame, seq: DataFrame) -> DataFrame:
    """Seven payment features; after a cancel the plan length is that of the payment before."""
    previous = seq.select(
        "user_id",
        F.col("sequence_group_id").alias("last_seq_id"),
        F.col("sequence_id").alias("pp_tx_id"),
        F.col("payment_plan_days").alias("_previous_plan"),
    )
    joined = last_txn.join(history.drop("last_seq_id"), "user_id", "left").join(
        previous, ["user_id", "last_seq_id", "pp_tx_id"], "left"
    )
    zero = F.lit(0)
    return joined.select(
        "user_id",
        _plan_months(F.col("last_is_cancel"), F.col("payment_plan_days"), F.col("_previous_plan")).alias(
            "payment_plan_months"
        ),
        "last_is_cancel",
        "payment_method_id",
        months(F.coalesce("membership_duration", zero)).alias("membership_months"),
        F.coalesce("tx_seq_length", zero).alias("tx_seq_length"),
        F.coalesce("cancel_exist", zero).alias("cancel_exist"),
        "had_churn",
    )


def registration_days(members: DataFrame, floor: str = "2015-01-01", column: str = "registration_init_time") -> DataFrame:
    """Members with ``registration_days``: days from ``floor`` to the registration, 0 for earlier ones, NULL where unknown."""
    days = F.datediff(column, F.lit(floor).cast("date"))
    return members.withColumn("registration_days", F.when(days < 0, 0).otherwise(days).cast("long"))


def clip_usage_hours(logs: DataFrame, low: float = 0.0, high: float = 24.0) -> DataFrame:
    """Usage with its time held between ``low`` and ``high`` hours, in ``total_secs`` and ``total_hours``.

    For use before the features, all of which follow from ``total_secs``. NULL stays.
    """
    bounds = [F.lit(hours * SECONDS_PER_HOUR) for hours in (low, high)]
    seconds = F.when(F.col("total_secs").isNotNull(), F.least(F.greatest("total_secs", bounds[0]), bounds[1]))
    return logs.withColumn("total_secs", seconds).withColumn("total_hours", F.col("total_secs") / F.lit(SECONDS_PER_HOUR))


def members_features(members: DataFrame, seq: DataFrame) -> DataFrame:
    """Months since registration and months the reference payment really covers."""
    payment = seq.select(
        "user_id",
        F.col("sequence_group_id").alias("last_seq_id"),
        F.col("sequence_id").alias("p_tx_id"),
        F.col("is_cancel").alias("_cancel"),
        F.col("transaction_date").alias("_paid"),
        F.col("membership_expire_date").alias("_expire"),
    )
    previous = seq.select(
        "user_id",
        F.col("sequence_group_id").alias("last_seq_id"),
        F.col("sequence_id").alias("pp_tx_id"),
        F.col("transaction_date").alias("_previous_paid"),
    )
    base = _with_window(members).select(
        "user_id", "last_expire_date", "registration_init_time", "last_seq_id", "p_tx_id", "pp_tx_id"
    )
    joined = base.join(payment, ["user_id", "last_seq_id", "p_tx_id"]).join(
        previous, ["user_id", "last_seq_id", "pp_tx_id"], "left"
    )
    return joined.select(
        "user_id",
        months(F.datediff("last_expire_date", "registration_init_time")).alias("registration_dur"),
        _actual_months(F.col("_cancel"), F.col("_expire"), F.col("_paid"), F.col("_previous_paid")).alias(
            "actual_plan_months"
        ),
    )


def ml_features(
    members: DataFrame, logs_features: DataFrame, txn_features: DataFrame, mem_features: DataFrame
) -> DataFrame:
    """Members with a last expiry: id, label and 31 features."""
    return (
        _with_window(members)
        .select("user_id", "is_churn")
        .join(logs_features, "user_id", "left")
        .join(txn_features, "user_id", "left")
        .join(mem_features, "user_id", "left")
        .select("user_id", "is_churn", *FEATURES)
    )


SNAPSHOT_PAYMENT = (
    "is_cancel", "transaction_date", "membership_expire_date", "payment_plan_days", "payment_method_id",
)


def payment_snapshot(members: DataFrame, seq: DataFrame) -> DataFrame:
    """Reference payment (``own_*``), the payment before (``previous_*``) and the history before it, in
    one pass over ``seq``.

    Replaces the four lookups and one prefix join of the single operators by one bucketed join and
    one aggregation of plain columns.
    """
    carried = ("is_churn", "registration_init_time", "last_expire_date", "last_seq_id")
    base = _with_window(members).select("user_id", *carried, "p_tx_id", "pp_tx_id")
    rows = _prefix_rows(base, seq, F.col("p_tx_id"), SNAPSHOT_PAYMENT)
    pos = F.col("_pos")

    def picked(prefix: str, position: str) -> list[Column]:
        return [F.max(F.when(pos == F.col(position), F.col(f"_{c}"))).alias(f"{prefix}_{c}") for c in SNAPSHOT_PAYMENT]

    snapshot = rows.groupBy("user_id").agg(
        *[F.max(c).alias(c) for c in carried],
        F.bool_or(pos == F.col("p_tx_id")).alias("found"),
        *picked("own", "p_tx_id"),
        *picked("previous", "pp_tx_id"),
        *_history(pos < F.col("p_tx_id")),
    )
    return snapshot.withColumns(
        {
            "found": F.coalesce("found", F.lit(False)),
            "membership_period": days_between("last_expire_date", "own_transaction_date"),
        }
    )


def feature_table(
    members: DataFrame,
    seq: DataFrame,
    logs: DataFrame,
    weekday_mode: str = "documented",
    fill: float | None = 0.0,
) -> DataFrame:
    """``ml_features`` straight from members, payments and usage.

    The same table as composing the single operators, with the payments exchanged once. The snapshot, one row per
    member, is stored first: its first and last day bound the scan of the usage, its months those of usage stored by
    month, and its users are all whose usage is summed and exchanged by day.

    No table with a row per user is broadcast, at any size: stored in a few bytes a user, it is many times as large in the
    memory of the driver.
    """
    snapshot = materialize(payment_snapshot(members, seq), "snapshot")
    found = F.col("found")
    window = snapshot.where(found).select(
        "user_id",
        F.col("own_transaction_date").alias("log_start_date"),
        F.col("last_expire_date").alias("log_end_date"),
        "membership_period",
    )
    bounds = window.agg(F.min("log_start_date").alias("low"), F.max("log_end_date").alias("high")).first()
    inside = (F.col("date") >= F.lit(bounds["low"])) & (F.col("date") < F.lit(bounds["high"]))
    used = in_months(logs, window, "log_start_date", "log_end_date") if MONTH in logs.columns else logs
    used = used.where(inside).join(window.select("user_id").hint("merge"), "user_id", "left_semi")
    profile = usage_profile(logs_in_membership(daily_usage(used), window), weekday_mode)
    features = _complete(snapshot, profile, None)

    def filled(name: str) -> Column:
        if fill is None or name in LOG_GAP_TERMS:
            return F.col(name)
        return F.when(found, F.coalesce(F.col(name), F.lit(fill))).alias(name)

    own_cancel, own_paid = F.col("own_is_cancel"), F.col("own_transaction_date")
    zero = F.lit(0)
    payments = {
        "payment_plan_months": _plan_months(
            own_cancel, F.col("own_payment_plan_days"), F.col("previous_payment_plan_days")
        ),
        "last_is_cancel": own_cancel,
        "payment_method_id": F.col("own_payment_method_id"),
        "membership_months": months(F.coalesce("membership_duration", zero)),
        "tx_seq_length": F.col("tx_seq_length"),
        "cancel_exist": F.col("cancel_exist"),
        "had_churn": F.when(F.col("last_seq_id") > 0, 1).otherwise(0),
        "registration_dur": months(F.datediff("last_expire_date", "registration_init_time")),
        "actual_plan_months": _actual_months(
            own_cancel, F.col("own_membership_expire_date"), own_paid, F.col("previous_transaction_date")
        ),
    }
    # A member whose reference payment is missing keeps its row with NULL features.
    return features.select(
        "user_id",
        "is_churn",
        *[filled(name) for name in LOG_FEATURES],
        *[F.when(found, value).alias(name) for name, value in payments.items()],
    )
