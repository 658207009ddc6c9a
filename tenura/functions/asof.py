"""Backward as-of join: for each asking row the last row of its key at or before a time.

Both sides become one stream, ordered by key and time, in which the rows carry themselves forward to the asking rows behind
them. One exchange and one sort, no range condition, no group that is gathered: a key of any size is sliced by ``ordered``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions.ordered import HOT_ROWS, RunLast, ordered


def as_of(
    asked: DataFrame,
    rows: DataFrame,
    key: str | Sequence[str],
    time: str,
    carried: Mapping[str, str],
    order: Sequence[str] = (),
    strict: bool = False,
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``asked`` with columns of the last of ``rows`` at or before its ``time``, NULL where there is none.

    ``carried`` maps columns of ``rows`` to their new names. Of rows with one time the last by ``order``, columns of ``rows``,
    NULLs first, counts. ``strict`` looks only before the time. Every asking row is returned once; one with a NULL key or time
    finds nothing, and rows with a NULL key or time are never found. Asking columns that have a new name are replaced.
    ``counted`` is a table to look for hot keys in, where the two are dear to compute.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = list(carried.values())
    kept = [c for c in asked.columns if c not in names]
    same = {c: f"_k{i}" for i, c in enumerate(keys)}
    # The tie-breaking columns are compared as given; asking rows have none and stand before or behind them all.
    first, last = (0, 1) if strict else (1, 0)
    usable = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, time)])
    row = F.struct(*[F.col(c).alias(n) for c, n in carried.items()])
    questions = asked.select(
        *[F.col(c).alias(k) for c, k in same.items()], F.col(time).alias("_time"), F.lit(first).alias("_turn"),
        *[F.lit(None).cast(rows.schema[c].dataType).alias(f"_o{i}") for i, c in enumerate(order)],
        F.struct(*kept).alias("_asked"), F.lit(None).cast(rows.select(row.alias("s")).schema["s"].dataType).alias("_answer"),
        usable.alias("_able"),
    )
    answers = rows.where(usable).select(
        *[F.col(c).alias(k) for c, k in same.items()], F.col(time).alias("_time"), F.lit(last).alias("_turn"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        F.lit(None).cast(questions.schema["_asked"].dataType).alias("_asked"),
        row.alias("_answer"), F.lit(True).alias("_able"),
    )
    stream = answers.unionByName(questions)
    # NULLs of the tie-breaking columns come first here, while ``ordered`` puts them last.
    turns = [x for i in range(len(order)) for x in (f"_known{i}", f"_o{i}")]
    stream = stream.withColumns({f"_known{i}": F.col(f"_o{i}").isNotNull() for i in range(len(order))})
    found = ordered(
        stream, list(same.values()), ["_time", "_turn", *turns], lambda s: s.add(_met=RunLast("_answer")), hot_rows=hot_rows,
        counted=None if counted is None else counted.select(*[F.col(c).alias(k) for c, k in same.items()]),
    )
    met = F.when(F.col("_able"), F.col("_met"))
    return found.where(F.col("_asked").isNotNull()).select(
        *[F.col(f"_asked.{c}").alias(c) for c in kept], *[met[n].alias(n) for n in names]
    )
