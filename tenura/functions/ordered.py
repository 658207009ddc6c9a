"""Ordered per-key columns that stay balanced when one key owns a large share of the rows.

``Window.partitionBy(user)`` sends each user to one task, which is right for nearly every user and
wrong for a user that holds a third of the table. ``ordered`` therefore looks for keys above
``hot_rows`` rows first, with one pre-aggregated count over the key column:

* none, the usual case: the plain window, one exchange and one sort;
* some: their rows are sorted across the cluster by key and order, so that a hot key, and even a pile
  of equal rows, is cut into slices of ordinary size. Windows run inside a slice, each slice is
  reduced to one summary row per key, and what earlier or later slices contribute is carried over on
  the summaries, whose number per key is bounded by the number of slices. All other keys keep the
  plain window.

Both paths give the same values. Hot keys stay a stored table of any length that rows are joined with;
their number is not limited and they are never collected. NULL order values come last.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.placement import placed
from tenura.session import materialize

HOT_ROWS = 1_000_000

_BEFORE = (Window.unboundedPreceding, -1)


@dataclass(frozen=True)
class Lag:
    """Value ``offset`` rows earlier (1 or 2)."""

    column: str
    offset: int = 1

    def plain(self, spec):
        return F.lag(self.column, self.offset).over(spec)

    def local(self, spec):
        return {f"l{n}": F.lag(self.column, n).over(spec) for n in range(1, self.offset + 1)}

    def summary(self, at):
        parts = {"t1": F.max_by(F.col(self.column), F.col("_row"))}
        if self.offset == 2:
            parts["t2"] = F.max_by(at("l1"), F.col("_row"))
        return parts

    def carry(self, at, chunks):
        parts = {"p1": F.lag(at("t1"), 1).over(chunks)}
        if self.offset == 2:
            parts["p2"] = F.when(F.lag("_rows", 1).over(chunks) >= 2, F.lag(at("t2"), 1).over(chunks)).otherwise(
                F.lag(at("t1"), 2).over(chunks)
            )
        return parts

    def merge(self, at):
        row = F.col("_row")
        if self.offset == 1:
            return F.when(row > 1, at("l1")).otherwise(at("p1"))
        return F.when(row > 2, at("l2")).when(row == 2, at("p1")).otherwise(at("p2"))


@dataclass(frozen=True)
class Lead:
    """Value one row later."""

    column: str

    def plain(self, spec):
        return F.lead(self.column, 1).over(spec)

    def local(self, spec):
        return {"n": F.lead(self.column, 1).over(spec)}

    def summary(self, at):
        return {"h": F.min_by(F.col(self.column), F.col("_row"))}

    def carry(self, at, chunks):
        return {"x": F.lead(at("h"), 1).over(chunks)}

    def merge(self, at):
        return F.when(F.col("_row") < F.col("_rows"), at("n")).otherwise(at("x"))


@dataclass(frozen=True)
class RunSum:
    """Sum of the rows up to and including this one."""

    column: str

    def plain(self, spec):
        return F.sum(self.column).over(_running(spec))

    def local(self, spec):
        return {"s": F.sum(self.column).over(_running(spec))}

    def summary(self, at):
        return {"t": F.sum(self.column)}

    def carry(self, at, chunks):
        return {"b": F.coalesce(F.sum(at("t")).over(chunks.rowsBetween(*_BEFORE)), F.lit(0))}

    def merge(self, at):
        return at("s") + at("b")


@dataclass(frozen=True)
class RunMax:
    """Largest value up to and including this row."""

    column: str

    def plain(self, spec):
        return F.max(self.column).over(_running(spec))

    def local(self, spec):
        return {"m": F.max(self.column).over(_running(spec))}

    def summary(self, at):
        return {"t": F.max(self.column)}

    def carry(self, at, chunks):
        return {"b": F.max(at("t")).over(chunks.rowsBetween(*_BEFORE))}

    def merge(self, at):
        return F.greatest(at("m"), at("b"))


@dataclass(frozen=True)
class RunLast:
    """Last non-null value up to and including this row."""

    column: str

    def plain(self, spec):
        return F.last(self.column, ignorenulls=True).over(_running(spec))

    def local(self, spec):
        return {"v": F.last(self.column, ignorenulls=True).over(_running(spec))}

    def summary(self, at):
        return {"t": F.max_by(F.col(self.column), F.when(F.col(self.column).isNotNull(), F.col("_row")))}

    def carry(self, at, chunks):
        return {"b": F.last(at("t"), ignorenulls=True).over(chunks.rowsBetween(*_BEFORE))}

    def merge(self, at):
        return F.coalesce(at("v"), at("b"))


Step = Lag | Lead | RunSum | RunMax | RunLast


def _running(spec):
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


@dataclass(frozen=True)
class PlainRows:
    """Rows whose keys are small enough for an ordinary window."""

    df: DataFrame
    key: tuple[str, ...]
    order: tuple[str, ...]

    def derive(self, **columns: Column) -> PlainRows:
        return replace(self, df=self.df.withColumns(columns))

    def add(self, **steps: Step) -> PlainRows:
        spec = Window.partitionBy(*self.key).orderBy(*[F.col(c).asc_nulls_last() for c in self.order])
        return replace(self, df=self.df.withColumns({name: step.plain(spec) for name, step in steps.items()}))


@dataclass(frozen=True)
class SlicedRows:
    """Rows of hot keys in stored slices: ``_slice`` and the row number ``_row`` inside it."""

    df: DataFrame
    key: tuple[str, ...]

    def derive(self, **columns: Column) -> SlicedRows:
        return replace(self, df=self.df.withColumns(columns))

    def add(self, **steps: Step) -> SlicedRows:
        cells = (*self.key, "_slice")
        inside = Window.partitionBy(*cells).orderBy("_row")
        slices = Window.partitionBy(*self.key).orderBy("_slice")

        def at(name):
            return lambda part: F.col(f"_{name}_{part}")

        # A slice of one key starts anywhere in its partition; count from 1 within the key.
        local = {"_row": F.row_number().over(inside)}
        for name, step in steps.items():
            local.update({f"_{name}_{part}": column for part, column in step.local(inside).items()})
        rows = self.df.withColumns(local)

        summed = [F.max("_row").alias("_rows")]
        for name, step in steps.items():
            summed += [column.alias(f"_{name}_{part}") for part, column in step.summary(at(name)).items()]
        summary = rows.groupBy(*cells).agg(*summed)

        carried = [F.col(cell).alias(f"_cell{i}") for i, cell in enumerate(cells)] + [F.col("_rows")]
        for name, step in steps.items():
            carried += [column.alias(f"_{name}_{part}") for part, column in step.carry(at(name), slices).items()]
        carry = summary.select(*carried)

        same_cell = [F.col(cell).eqNullSafe(F.col(f"_cell{i}")) for i, cell in enumerate(cells)]
        kept = [f"_{name}_{part}" for name, step in steps.items() for part in step.local(inside)]
        joined = rows.select(*[c for c in self.df.columns if c not in steps], *kept).join(carry, same_cell, "inner")
        out = joined.select(
            *[F.col(c) for c in self.df.columns if c not in steps], *[s.merge(at(n)).alias(n) for n, s in steps.items()]
        )
        # Stored, because the next step reads it twice again.
        return replace(self, df=materialize(out, "slices"))


def _sliced(df: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> SlicedRows:
    """Sort rows across the cluster and store them with their slice and place.

    The number of the stored input row breaks ties between equal rows, so copies spread too.
    """
    stored = materialize(df, "hot-rows").withColumn("_copy", F.monotonically_increasing_id())
    places = placed(stored, (*key, *order, "_copy"), "slices")
    return SlicedRows(places.withColumnsRenamed({"_part": "_slice", "_nth": "_row"}).drop("_copy"), key)


def hot_keys(df: DataFrame, key: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys above ``hot_rows`` rows, all of them, stored."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    return materialize(counts.select(*key), "hot-keys")


def ordered(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    build: Callable[[PlainRows | SlicedRows], PlainRows | SlicedRows],
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ordered columns to ``df`` through ``build``, which chains ``add`` and ``derive`` calls.

    ``order`` must be total up to equal rows. ``hot_rows=None`` skips the look for hot keys, for
    inputs already bounded per key. ``counted`` is a table to count keys on in place of ``df``: the one
    that makes keys hot, where ``df`` itself is dear to compute. Rows with a NULL key are never taken for hot.
    """
    key = (key,) if isinstance(key, str) else tuple(key)
    order = tuple(order)
    if hot_rows is None:
        return build(PlainRows(df, key, order)).df
    hot = hot_keys(df if counted is None else counted, key, hot_rows)
    if hot.isEmpty():
        return build(PlainRows(df, key, order)).df
    plain = build(PlainRows(df.join(hot, list(key), "left_anti"), key, order)).df
    sliced = build(_sliced(df.join(hot, list(key), "left_semi"), key, order)).df
    return plain.unionByName(sliced.select(*plain.columns))
