"""Labelled value buckets, distributions over them, and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed bucket edges: (label, bound, bound included). A value takes the first bucket whose upper
# bound it does not exceed; the last bucket has no bound.
PLAN_DAYS_BUCKETS = (
    ("< -30", -30, False), ("[-30, -7)", -7, False), ("[-7, -1)", -1, False), ("[-1, 0)", 0, False),
    ("0", 0, True), ("(0, 7]", 7, True), ("(7, 30]", 30, True), ("(30, 31]", 31, True),
    ("(31, 60]", 60, True), ("(60, 90]", 90, True), ("(90, 180]", 180, True), ("(180, 365]", 365, True),
    ("> 365", None, False),
)
CANCEL_PLAN_DAYS_BUCKETS = (
    ("< -31", -31, False), ("[-31, -30)", -30, False), ("[-30, -7)", -7, False), ("[-7, -1)", -1, False),
    ("[-1, 0)", 0, False), ("0", 0, True), ("(0, 7]", 7, True), ("(7, 30]", 30, True), ("(30, 31]", 31, True),
    ("(31, 90]", 90, True), ("(90, 180]", 180, True), ("(180, 365]", 365, True), ("> 365", None, False),
)
CANCEL_WIDE_BUCKETS = (
    ("< -365", -365, False), ("[-365, -180)", -180, False), ("[-180, -90)", -90, False), ("[-90, -31)", -31, False),
    ("[-31, 0)", 0, False), ("0", 0, True), ("(0, 30]", 30, True), ("(30, 90]", 90, True),
    ("(90, 180]", 180, True), ("(180, 365]", 365, True), ("> 365", None, False),
)
DAY_GAP_BUCKETS = (
    ("1-7", 7, True), ("8-30", 30, True), ("31-90", 90, True), ("91-180", 180, True), ("181-365", 365, True),
    ("> 365", None, False),
)
STREAK_PLAN_DAYS_BUCKETS = (
    ("negative", 0, False), ("0", 0, True), ("1-7", 7, True), ("8-30", 30, True), ("31-60", 60, True),
    ("61+", None, False),
)
SIGN_BUCKETS = (("negative", 0, False), ("zero", 0, True), ("positive", None, False))


def bucket_number(value: Column, buckets: Sequence[tuple]) -> Column:
    """Position of the bucket of ``value``, from 1. NULL goes to the last one, like a CASE with ELSE."""
    chosen = None
    for number, (_, bound, included) in enumerate(buckets[:-1], start=1):
        fits = value <= bound if included else value < bound
        chosen = F.when(fits, number) if chosen is None else chosen.when(fits, number)
    return chosen.otherwise(len(buckets))


def bucket_label(number: Column, buckets: Sequence[tuple]) -> Column:
    """Label of a bucket position."""
    return F.element_at(F.array(*[F.lit(label) for label, _, _ in buckets]), number)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; NULL when the whole is 0."""
    return F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def distribution(df: DataFrame, columns: dict[str, Column], user: str = "user_id") -> DataFrame:
    """Rows and users per combination of ``columns``, with their share of all rows and users.

    Rows are first counted per (user, combination), so one exchange carries partial counts only and
    serves the counts, the distinct users and the totals.
    """
    names = list(columns)
    per_user = (
        df.select(F.col(user).alias("_user"), *[c.alias(n) for n, c in columns.items()])
        .groupBy("_user", *names)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    cells = per_user.groupBy(*names).agg(
        F.sum("_rows").alias("row_count"), F.count(F.col("_user")).alias("user_count")
    )
    totals = per_user.agg(
        F.sum("_rows").alias("_all_rows"), F.countDistinct("_user").alias("_all_users")
    )
    return cells.crossJoin(F.broadcast(totals)).select(
        *names,
        "row_count",
        "user_count",
        percent(F.col("row_count"), F.col("_all_rows")).alias("pct_rows"),
        percent(F.col("user_count"), F.col("_all_users")).alias("pct_users"),
    )


def bucket_distribution(df: DataFrame, column: str, buckets: Sequence[tuple], user: str = "user_id") -> DataFrame:
    """``distribution`` over ordered buckets, with ``bucket_no`` to sort by and its label."""
    cells = distribution(df, {"bucket_no": bucket_number(F.col(column), buckets)}, user)
    return cells.select(
        "bucket_no",
        bucket_label(F.col("bucket_no"), buckets).alias("bucket"),
        "row_count",
        "user_count",
        "pct_rows",
        "pct_users",
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the smallest and the largest value; the last bin is closed.

    One equal value everywhere gets a range of one around it. Empty bins are kept.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_x"))
    same = F.col("_lo") == F.col("_hi")
    span = values.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi")).where(F.col("_lo").isNotNull())
    span = span.select(
        F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
        F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
    )
    number = F.least(
        F.floor((F.col("_x") - F.col("lo")) * F.lit(float(bins)) / (F.col("hi") - F.col("lo"))), F.lit(bins - 1)
    ).cast("int")
    counts = (
        values.crossJoin(F.broadcast(span)).groupBy(number.alias("bin_no")).agg(F.count(F.lit(1)).alias("_n"))
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    edges = span.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin_no"), "lo", "hi")
    return edges.join(counts, "bin_no", "left").select(
        "bin_no",
        (F.col("lo") + F.col("bin_no") * width).alias("lower"),
        (F.col("lo") + (F.col("bin_no") + 1) * width).alias("upper"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("count"),
    )
