"""Dense positions and exact percentiles over a globally sorted column, without a single task.

Rows are range-partitioned and sorted, then stored together with their place (partition number and
row number inside it). Row counts per partition, at most one row per shuffle partition, give the
offsets that turn places into global positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.session import materialize

# monotonically_increasing_id(): partition number above bit 33, row number below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def placed(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Sort ``df`` across the cluster and store each row's partition ``_part`` and row ``_nth`` in it."""
    order = [F.col(c).asc_nulls_last() for c in columns]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), label)
    return stored.withColumns(
        {"_part": F.shiftright("_at", _ROW_BITS), "_nth": F.col("_at").bitwiseAND(F.lit(_ROW_MASK))}
    ).drop("_at")


def dense_index(keys: DataFrame, column: str, name: str) -> DataFrame:
    """Number distinct non-null keys 0, 1, 2, ... in key order."""
    places = placed(keys.select(column), [column], "dense-index")
    sizes = places.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return places.join(F.broadcast(offsets), "_part").select(column, (F.col("_offset") + F.col("_nth")).alias(name))


def exact_percentiles(
    df: DataFrame, column: str, fractions: Sequence[float], group: str | None = None, weight: str | None = None
) -> DataFrame:
    """Exact linearly interpolated percentiles of ``column`` as rows ``([group], fraction, value)``.

    The value domain may be as large as the table: equal values are counted first, the counts are
    range-partitioned, and only the partitions holding a wanted rank are read again. Groups may be few and large or many:
    the wanted ranks are a table that the places are joined with. ``weight`` says how often a row counts.
    """
    groups = [group] if group else []
    counts = df.where(F.col(column).isNotNull()).groupBy(*groups, column).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("_n")
    )
    places = placed(counts, [*groups, column], "percentiles")
    parts = places.groupBy(*groups, "_part").agg(F.sum("_n").alias("_size"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    wanted = parts.select(
        *groups,
        "_part",
        "_size",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(whole).alias("_total"),
    )
    # In a step of its own: unfolded rows must not enter the sums above.
    wanted = wanted.withColumn("fraction", F.explode(F.array(*[F.lit(float(p)) for p in fractions])))
    wanted = (
        wanted.withColumn("_rank", F.col("fraction") * (F.col("_total") - 1))
        .select("*", F.explode(F.array(F.floor("_rank"), F.ceil("_rank"))).alias("_seek"))
        .where((F.col("_before") <= F.col("_seek")) & (F.col("_seek") < F.col("_before") + F.col("_size")))
        .select(*groups, "fraction", "_rank", "_part", (F.col("_seek") - F.col("_before")).alias("_seek"))
        .distinct()
    )
    # At most two rows per group and fraction; whether that is little enough to broadcast is for the planner to see.
    hit = wanted.select(*groups, "_part").distinct()
    cell = [*groups, "_part"]
    up_to = Window.partitionBy(*cell).orderBy("_nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = places.join(hit, cell, "left_semi").withColumn("_upto", F.sum("_n").over(up_to))
    found = inside.join(wanted, cell).where(
        (F.col("_seek") < F.col("_upto")) & (F.col("_seek") >= F.col("_upto") - F.col("_n"))
    )
    value = F.col(column).cast("double")
    share = F.first(F.col("_rank") - F.floor("_rank"))
    return found.groupBy(*groups, "fraction").agg(
        (F.min(value) + (F.max(value) - F.min(value)) * share).alias("value")
    )


def column_percentiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """Exact percentiles of many columns by one sort: ``column_name``, ``fraction``, ``value``.

    Rows are unfolded into (column, value) and counted inside the tasks before anything moves. Columns without values have no row.
    """
    named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])
    values = df.select(F.inline(named)).where(F.col("x").isNotNull())
    counts = values.groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("_times"))
    return exact_percentiles(counts, "x", fractions, "column_name", weight="_times")


def exact_median(df: DataFrame, column: str, name: str = "median") -> DataFrame:
    """One row holding the exact median (NULL when there is no value)."""
    return exact_percentiles(df, column, [0.5]).agg(F.max("value").alias(name))
