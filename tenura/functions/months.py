"""Calendar months as partitions of a table, and reading only those that a set of spans meets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Partition column of tables stored by month: year times 100 plus month, NULL for a NULL date.
MONTH = "usage_month"


def month_of(day: Column | str) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def months_met(spans: DataFrame, start: str, end: str) -> DataFrame:
    """The distinct months, as column ``MONTH``, that meet a span from ``start`` to the day before ``end``."""
    firsts = F.sequence(F.trunc(start, "month"), F.trunc(F.date_sub(end, 1), "month"), F.expr("interval 1 month"))
    met = spans.where(F.col(start) < F.col(end)).select(F.explode(firsts).alias("_first"))
    return met.select(month_of("_first").alias(MONTH)).distinct()


def in_months(rows: DataFrame, spans: DataFrame, start: str, end: str) -> DataFrame:
    """The rows whose month meets a span. On a table stored by month, the other months' files are not opened.

    The months are sent to all tasks: the calendar bounds them, 12 for each year between the first and the last span,
    whatever the number of spans. The scan waits for them and prunes its partitions.
    """
    return rows.join(F.broadcast(months_met(spans, start, end)), MONTH, "left_semi")
