"""Column transforms with the figures that describe what they changed."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tenura.functions.bins import percent
from tenura.functions.placement import exact_median
from tenura.sources.schemas import DATE_COLUMNS

# Fixed code of each gender text.
GENDER_CODES = {"male": 0, "female": 1}
GENDER_UNKNOWN = -1


def encode_gender(
    df: DataFrame,
    column: str = "gender",
    codes: Mapping[str, int] = GENDER_CODES,
    unknown: int = GENDER_UNKNOWN,
) -> DataFrame:
    """Replace a text column by integer codes; NULL and other texts become ``unknown``."""
    encoded = reduce(lambda acc, kv: acc.when(F.col(column) == kv[0], kv[1]), codes.items(), F)
    return df.withColumn(column, encoded.otherwise(unknown).cast("int"))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def _is_unset(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == 0)


def _parsed(column: str) -> Column:
    return F.when(~_is_unset(column), F.try_to_date(F.col(column).cast("string"), "yyyyMMdd"))


def _int_date_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if f.name.lower() in names and isinstance(f.dataType, IntegralType)]


def parse_int_dates(df: DataFrame, names: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Turn 8-digit integers into dates in the named columns; 0 and NULL become NULL.

    Columns of another type, dates among them, are left alone. A value that is no date becomes NULL
    and is counted by ``int_date_report``.
    """
    return df.withColumns({column: _parsed(column) for column in _int_date_columns(df, names)})


def int_date_report(df: DataFrame, names: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Per column ``parse_int_dates`` converts: rows, unset values, bad values, first and last date."""
    columns = _int_date_columns(df, names)
    if not columns:
        raise ValueError("no integer date column to report on")
    figures = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.struct(
                F.count_if(_is_unset(c)).alias("unset"),
                F.count_if(~_is_unset(c) & _parsed(c).isNull()).alias("bad"),
                F.min(_parsed(c)).alias("min_date"),
                F.max(_parsed(c)).alias("max_date"),
            ).alias(f"_{c}")
            for c in columns
        ],
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("f")) for c in columns])
    return figures.select("total", F.inline(rows)).select("column_name", "total", "f.*")


def int_date_reports(tables: Mapping[str, DataFrame], names: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """``int_date_report`` of every table that has such a column, with its ``table_name``; one scan of each."""
    reports = [
        int_date_report(df, names).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
        if _int_date_columns(df, names)
    ]
    if not reports:
        raise ValueError("no integer date column to report on")
    return reduce(DataFrame.unionByName, reports)


def nullify_out_of_range(
    df: DataFrame, column: str, min_val: float | None = None, max_val: float | None = None
) -> DataFrame:
    """Values below ``min_val`` or above ``max_val`` become NULL; a missing bound does not apply."""
    value = F.col(column)
    kept = F.lit(True)
    if min_val is not None:
        kept = kept & (value >= min_val)
    if max_val is not None:
        kept = kept & (value <= max_val)
    return df.withColumn(column, F.when(kept, value))


def range_stats(df: DataFrame, column: str) -> DataFrame:
    """Total, non-null and NULL counts with minimum, maximum and mean of a column."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(column).alias("non_null"),
        F.count_if(F.col(column).isNull()).alias("null_cnt"),
        F.min(column).alias("min_val"),
        F.max(column).alias("max_val"),
        F.avg(column).alias("avg_val"),
    )


# Rule operators: condition on a column given the rule's value.
CONDITIONS: dict[str, Callable[[Column, Any], Column]] = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
    "not_in": lambda c, v: ~c.isin(list(v)),
    "is_null": lambda c, v: c.isNull(),
    "is_not_null": lambda c, v: c.isNotNull(),
    "between": lambda c, v: c.between(v[0], v[1]),
    "not_between": lambda c, v: ~c.between(v[0], v[1]),
}
ACTIONS = ("set_null", "set_value", "delete_row")


def _fold_rules(df: DataFrame, rules: Sequence[Mapping[str, Any]], change: bool) -> tuple[DataFrame, list[int]]:
    """Columns ``_hit<i>`` per applicable rule and ``_alive``, all in one projection chain.

    Later rules see what earlier ones changed, unless ``change`` is False.
    """
    state = df.withColumn("_alive", F.lit(True))
    numbers = []
    for number, rule in enumerate(rules, start=1):
        column, action = rule["column"], rule["action"]
        if column not in df.columns:
            warnings.warn(f"rule {number}: no column {column}, skipped", stacklevel=3)
            continue
        if rule["operator"] not in CONDITIONS:
            raise ValueError(f"unknown operator: {rule['operator']}")
        met = CONDITIONS[rule["operator"]](F.col(column), rule.get("value"))
        hit = F.col(f"_hit{number}")
        state = state.withColumn(f"_hit{number}", F.col("_alive") & F.coalesce(met, F.lit(False)))
        numbers.append(number)
        if action not in ACTIONS:
            warnings.warn(f"rule {number}: unknown action {action}, skipped", stacklevel=3)
        elif not change:
            continue
        elif action == "delete_row":
            state = state.withColumn("_alive", F.col("_alive") & ~hit)
        else:
            new = F.lit(rule["new_value"] if action == "set_value" else None).cast(df.schema[column].dataType)
            state = state.withColumn(column, F.when(hit, new).otherwise(F.col(column)))
    return state, numbers


def apply_rules(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Apply rules in order: ``{column, operator, value, action, new_value}``.

    A row is touched only where the condition is true; an unknown (NULL) condition leaves it alone.
    """
    state, _ = _fold_rules(df, rules, change=True)
    return state.where("_alive").select(*df.columns)


def rule_impact(df: DataFrame, rules: Sequence[Mapping[str, Any]], dry_run: bool = False) -> DataFrame:
    """Rows each rule affects, and their share of all rows, in one pass.

    ``dry_run`` counts every rule on the unchanged table.
    """
    state, numbers = _fold_rules(df, rules, change=not dry_run)
    if not numbers:
        raise ValueError("no rule applies to this table")
    counts = state.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(f"_hit{n}").alias(f"_n{n}") for n in numbers]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule_no"),
                F.lit(rules[n - 1]["column"]).alias("column_name"),
                F.lit(rules[n - 1]["operator"]).alias("operator"),
                F.lit(rules[n - 1]["action"]).alias("action"),
                F.col(f"_n{n}").alias("affected"),
            )
            for n in numbers
        ]
    )
    return counts.select("total", F.inline(rows)).select(
        "rule_no",
        "column_name",
        "operator",
        "action",
        "affected",
        percent(F.col("affected"), F.col("total")).alias("pct_affected"),
    )


def convert_unit(
    df: DataFrame,
    source: str,
    target: str,
    divisor: float = 1.0,
    multiplier: float = 1.0,
    clip_min: float | None = None,
    clip_max: float | None = None,
    overwrite: bool = True,
) -> DataFrame:
    """Add ``source * multiplier / divisor`` as a double, clipped to the bounds given; NULL stays."""
    if target in df.columns and not overwrite:
        return df
    value = F.col(source).cast("double") * F.lit(float(multiplier)) / F.lit(float(divisor))
    clipped = value
    if clip_max is not None:
        clipped = F.when(value > clip_max, float(clip_max)).otherwise(clipped)
    if clip_min is not None:
        clipped = F.when(value < clip_min, float(clip_min)).otherwise(clipped)
    kept = [column for column in df.columns if column != target]
    return df.select(*kept, clipped.alias(target))


def conversion_report(
    df: DataFrame, source: str, target: str, clip_min: float | None = None, clip_max: float | None = None
) -> DataFrame:
    """Mean and range of source and target, target median, and values sitting on each clip bound."""

    def at_bound(bound):
        return F.count_if(F.col(target) == bound) if bound is not None else F.lit(None).cast("long")

    figures = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(source).alias("source_non_null"),
        F.avg(source).alias("source_avg"),
        F.min(source).cast("double").alias("source_min"),
        F.max(source).cast("double").alias("source_max"),
        F.count(target).alias("target_non_null"),
        F.avg(target).alias("target_avg"),
        F.min(target).alias("target_min"),
        F.max(target).alias("target_max"),
        at_bound(clip_min).alias("clipped_min"),
        at_bound(clip_max).alias("clipped_max"),
    )
    return figures.crossJoin(F.broadcast(exact_median(df, target, "target_median")))


def column_mode(df: DataFrame, column: str, name: str = "mode") -> DataFrame:
    """One row with the most frequent value; the smallest of several."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), F.asc(column)).limit(1).agg(F.max(column).alias(name))


def fill_nulls(df: DataFrame, column: str, value: Any = None, method: str = "value") -> DataFrame:
    """Fill NULLs with a constant, or the column's mean, exact median or mode."""
    kind = df.schema[column].dataType
    if method == "value":
        return df.withColumn(column, F.coalesce(F.col(column), F.lit(value).cast(kind)))
    if method == "mean":
        fill = df.agg(F.avg(column).alias("_fill"))
    elif method == "median":
        fill = exact_median(df, column, "_fill")
    elif method == "mode":
        fill = column_mode(df, column, "_fill")
    else:
        raise ValueError(f"unknown fill method: {method}")
    if method != "mode" and isinstance(kind, IntegralType):
        fill = fill.select(F.round("_fill").alias("_fill"))
    filled = df.crossJoin(F.broadcast(fill))
    return filled.withColumn(column, F.coalesce(F.col(column), F.col("_fill").cast(kind))).select(*df.columns)


def add_plan_days_diff(seq: DataFrame) -> DataFrame:
    """Paid days minus actual days."""
    return seq.withColumn("plan_days_diff", F.col("payment_plan_days") - F.col("actual_plan_days"))


def plan_days_diff_stats(seq: DataFrame) -> DataFrame:
    """Sign counts, mean and range of ``plan_days_diff``: one row per cancel flag and one overall
    (``is_cancel`` NULL)."""
    diff = F.col("plan_days_diff")

    # A few rows: the two flag values, summed again for the overall row.
    per_flag = seq.groupBy("is_cancel").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(diff > 0).alias("positive_cnt"),
        F.count_if(diff == 0).alias("zero_cnt"),
        F.count_if(diff < 0).alias("negative_cnt"),
        F.sum(diff).alias("_sum"),
        F.count(diff).alias("_n"),
        F.min(diff).alias("min_diff"),
        F.max(diff).alias("max_diff"),
    )
    overall = per_flag.agg(
        F.lit(None).cast("long").alias("is_cancel"),
        *[F.sum(c).alias(c) for c in ("row_count", "positive_cnt", "zero_cnt", "negative_cnt", "_sum", "_n")],
        F.min("min_diff").alias("min_diff"),
        F.max("max_diff").alias("max_diff"),
    )
    both = per_flag.unionByName(overall)
    return both.select(
        "is_cancel",
        "row_count",
        "positive_cnt",
        "zero_cnt",
        "negative_cnt",
        F.round(F.col("_sum") / F.col("_n"), 2).alias("avg_diff"),
        "min_diff",
        "max_diff",
    )
