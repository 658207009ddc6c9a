"""Looking up the membership a profile refers to in its payment sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.ordered import HOT_ROWS, RunLast, ordered
from tenura.functions.packing import Packing, day, position
from tenura.operators.sequence import days_between

REFERENCE_WINDOW = ("2017-03-01", "2017-03-31")


def _without(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def membership_seq_info(members: DataFrame, seq: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Group and position of the payment that set ``members.last_expire``.

    The latest payment with that expiry; if it is a cancel, the latest non-cancel dated on or before it, where there is
    one. Payments are one ordered stream per user in which each carries the last non-cancel up to the end of its day; the
    members then meet the stream where it lies, so payments are exchanged once, by user, and hot users are sliced.
    """
    place = ("transaction_date", "sequence_id", "sequence_group_id", "is_cancel")
    payments = seq.select("user_id", "membership_expire_date", *place).withColumn(
        "_own", F.when(F.col("is_cancel") == 0, F.struct("sequence_group_id", "sequence_id"))
    )
    # Within a day cancels come last, behind every non-cancel that they may fall back on.
    order = ("transaction_date", "is_cancel", "sequence_id", "sequence_group_id")
    stream = ordered(payments, "user_id", order, lambda rows: rows.add(_back=RunLast("_own")), hot_rows=hot_rows, counted=seq)
    asked = members.where(F.col("last_expire").isNotNull()).select(F.col("user_id").alias("_user"), "last_expire")
    # Equal expiries as a range, so that the user alone is the join key and the stream stays in place.
    same_expiry = (F.col("membership_expire_date") <= F.col("last_expire")) & (F.col("membership_expire_date") >= F.col("last_expire"))
    latest = Window.partitionBy("user_id").orderBy(*[F.col(c).desc_nulls_last() for c in place])
    hits = stream.join(asked, (F.col("user_id") == F.col("_user")) & same_expiry)
    hits = hits.withColumn("_nth", F.row_number().over(latest)).where("_nth = 1")
    moved = (F.col("is_cancel") == 1) & F.col("_back").isNotNull() & F.col("transaction_date").isNotNull()
    found = hits.select(
        "user_id",
        F.when(moved, F.col("_back.sequence_group_id")).otherwise(F.col("sequence_group_id")).alias("membership_seq_group_id"),
        F.when(moved, F.col("_back.sequence_id")).otherwise(F.col("sequence_id")).alias("membership_seq_id"),
    )
    base = _without(members, "membership_seq_group_id", "membership_seq_id")
    return base.join(found, "user_id", "left")


def membership_durations(members: DataFrame, seq: DataFrame) -> DataFrame:
    """Days from the matched payment, and from its group's first payment, to ``last_expire``."""
    located = members.where(F.col("membership_seq_group_id").isNotNull()).select(
        "user_id",
        "last_expire",
        F.col("membership_seq_group_id").alias("sequence_group_id"),
        F.col("membership_seq_id").alias("_matched"),
    )
    # One lookup for both payments: two rows per user, or one where they are the same.
    wanted = located.withColumn("sequence_id", F.explode(F.array_distinct(F.array("_matched", F.lit(0).cast("long")))))
    found = wanted.join(
        seq.select("user_id", "sequence_group_id", "sequence_id", "transaction_date"),
        ["user_id", "sequence_group_id", "sequence_id"],
    )
    starts = found.groupBy("user_id", "last_expire").agg(
        F.max(F.when(F.col("sequence_id") == F.col("_matched"), F.col("transaction_date"))).alias("_own"),
        F.max(F.when(F.col("sequence_id") == 0, F.col("transaction_date"))).alias("_first"),
    )
    durations = starts.where(F.col("_own").isNotNull() & F.col("_first").isNotNull()).select(
        "user_id",
        days_between("last_expire", "_own").alias("previous_membership_duration"),
        days_between("last_expire", "_first").alias("previous_membership_seq_duration"),
    )
    base = _without(members, "previous_membership_duration", "previous_membership_seq_duration")
    return base.join(durations, "user_id", "left")


def last_txn_lookup(seq: DataFrame, window: tuple[str, str] = REFERENCE_WINDOW) -> DataFrame:
    """Per user the payment that sets the last expiry inside the window.

    Per group the payment with the latest expiry in the window counts, unless a later cancel also
    expires in it; per user the latest such expiry, then the highest group. Only aggregations, so
    every step reduces before its exchange. Positions are contiguous from 0, so the previous payment
    of the group is the position before.
    """
    start, end = (F.lit(edge).cast("date") for edge in window)
    inside = seq.where(F.col("membership_expire_date").between(start, end))
    # Dates and positions as numbers, whose largest is found by hashing.
    top = Packing(day("membership_expire_date"), day("transaction_date"), position("sequence_id"))
    cancel = Packing(day("transaction_date"), position("sequence_id"), day("membership_expire_date"))
    at = Packing(day("transaction_date"), position("sequence_id"))
    best = Packing(day("last_expire_date"), position("last_seq_id"), position("p_tx_id"))
    per_group = inside.groupBy("user_id", "sequence_group_id").agg(
        F.max(top.pack()).alias("_top"), F.max(F.when(F.col("is_cancel") == 1, cancel.pack())).alias("_cancel")
    )
    one, two = top.unpack(F.col("_top")), cancel.unpack(F.col("_cancel"))
    per_group = per_group.select(
        "user_id", "sequence_group_id", "_cancel", *[v.alias(f"t_{n}") for n, v in one.items()],
        *[v.alias(f"c_{n}") for n, v in two.items()],
    )
    moments = [at.pack(transaction_date=f"{x}_transaction_date", sequence_id=f"{x}_sequence_id") for x in "ct"]
    overridden = F.col("_cancel").isNotNull() & (moments[0] > moments[1])

    def effective(column: str) -> Column:
        return F.when(overridden, F.col(f"c_{column}")).otherwise(F.col(f"t_{column}"))

    packed = best.pack(
        last_expire_date=effective("membership_expire_date"), last_seq_id="sequence_group_id", p_tx_id=effective("sequence_id")
    )
    last = per_group.groupBy("user_id").agg(F.max(packed).alias("_best"))
    last = last.select("user_id", *[v.alias(n) for n, v in best.unpack(F.col("_best")).items()])
    return last.withColumn("pp_tx_id", F.when(F.col("p_tx_id") > 0, F.col("p_tx_id") - 1))


def last_txn_in_window(
    members: DataFrame, seq: DataFrame, window: tuple[str, str] = REFERENCE_WINDOW
) -> DataFrame:
    """Members with ``last_txn_lookup`` attached; NULL for users without an expiry in the window.

    Both sides have a row per user and are merged: the files of the members are small, the members unpacked are not.
    """
    base = _without(members, "last_expire_date", "last_seq_id", "p_tx_id", "pp_tx_id")
    return base.join(last_txn_lookup(seq, window).hint("merge"), "user_id", "left")


def attach_label(members: DataFrame, labels: DataFrame, key: str = "user_id") -> DataFrame:
    """Copy the label onto members, NULL where there is none; of several labels the largest."""
    one_each = labels.groupBy(key).agg(F.max("is_churn").cast("long").alias("is_churn"))
    return _without(members, "is_churn").join(one_each.hint("merge"), key, "left")
