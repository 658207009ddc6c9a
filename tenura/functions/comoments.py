"""Co-moments of all pairs of columns in one pass.

The state of a set of rows is, for each pair of columns, how many rows have both, the means of both over those rows, the sums of
squared deviations from them, the sum of products of deviations, and both ranges. Two states merge into that of all
their rows, without the loss of precision that sums of raw products have. A task reads its rows as Arrow batches, makes
a state of each batch by matrix products and merges it into its own; it returns one row per pair, whatever the number of
rows. The states of the tasks are stored and merged by aggregation: first the means, then what the means differ by.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.session import materialize

STATE = (
    "i int, j int, n_rows long, n long, mean_x double, mean_y double, dev_x double, dev_y double, dev_xy double, "
    "min_x double, max_x double, min_y double, max_y double"
)


@dataclass
class State:
    """Square arrays over columns: entry ``[i, j]`` is about column ``i`` in the rows that have ``i`` and ``j``."""

    rows: int
    n: np.ndarray
    mean: np.ndarray
    dev: np.ndarray
    both: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray, known: np.ndarray) -> State:
        """State of the rows of a block; ``known`` says where there is a value."""
        width = values.shape[1]
        low, high = np.full((width, width), np.inf), np.full((width, width), -np.inf)
        # Columns that are known in the same rows share the ranges of all columns over those rows.
        patterns: dict[bytes, list[int]] = {}
        for column in range(width):
            patterns.setdefault(np.packbits(known[:, column]).tobytes(), []).append(column)
        for same in patterns.values():
            rows = known[:, same[0]]
            if rows.any():
                held, there = values[rows], known[rows]
                low[:, same] = np.where(there, held, np.inf).min(axis=0)[:, None]
                high[:, same] = np.where(there, held, -np.inf).max(axis=0)[:, None]
        if not np.isfinite(values[known]).all():
            return cls(len(values), *_pair_by_pair(values, known), low, high)
        own = np.maximum(known.sum(axis=0), 1)
        shift = np.where(known, values, 0.0).sum(axis=0) / own
        around, there = np.where(known, values - shift, 0.0), known.astype(float)
        n, sums = there.T @ there, around.T @ there
        safe = np.maximum(n, 1.0)
        return cls(
            len(values), n, np.where(n > 0, sums / safe + shift[:, None], 0.0),
            np.maximum((around * around).T @ there - sums * sums / safe, 0.0), around.T @ around - sums * sums.T / safe, low, high,
        )

    def merged(self, other: State) -> State:
        """State of the rows of both."""
        n = self.n + other.n
        safe = np.maximum(n, 1.0)
        apart = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * other.n / safe
        return State(
            self.rows + other.rows, n, (self.n * self.mean + other.n * other.mean) / safe, self.dev + other.dev + apart**2 * weight,
            self.both + other.both + apart * apart.T * weight, np.minimum(self.low, other.low), np.maximum(self.high, other.high),
        )

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        i, j = np.triu_indices(len(self.n))
        none = self.n[i, j] == 0
        columns = [
            i, j, np.full(len(i), self.rows), self.n[i, j], self.mean[i, j], self.mean[j, i], self.dev[i, j], self.dev[j, i],
            self.both[i, j],
        ]
        ranges = [self.low[i, j], self.high[i, j], self.low[j, i], self.high[j, i]]
        arrays = [pa.array(c).cast(f.type) for c, f in zip(columns, schema)]
        arrays += [pa.array(c, mask=none, type=pa.float64()) for c in ranges]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _pair_by_pair(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
    """Counts, means and deviations where infinite values or NaN may only touch their own pairs."""
    width = values.shape[1]
    n, mean, dev, both = (np.zeros((width, width)) for _ in range(4))
    with np.errstate(invalid="ignore"):
        for i in range(width):
            for j in range(width):
                rows = known[:, i] & known[:, j]
                if rows.any():
                    x, y = values[rows, i], values[rows, j]
                    n[i, j], mean[i, j] = len(x), x.mean()
                    dev[i, j], both[i, j] = ((x - x.mean()) ** 2).sum(), ((x - x.mean()) * (y - y.mean())).sum()
    return n, mean, dev, both


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("i", pa.int32()), ("j", pa.int32()), ("n_rows", pa.int64()), ("n", pa.int64())]
        + [(c, pa.float64()) for c in ("mean_x", "mean_y", "dev_x", "dev_y", "dev_xy", "min_x", "max_x", "min_y", "max_y")]
    )
    total = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
        values = np.stack([c.fill_null(0.0).to_numpy() for c in batch.columns], axis=1)
        state = State.of(values, known)
        total = state if total is None else total.merged(state)
    if total is not None:
        yield total.batch(schema)


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """State of all rows of ``df`` for each pair of ``columns``, a column with itself included; columns as in ``STATE``.

    ``i`` and ``j`` are places in ``columns`` from 0, with ``i <= j``. Without rows there is no state.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    states = materialize(doubles.mapInArrow(_states, STATE), "co-moments")
    whole = states.groupBy("i", "j").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), _mean("mean_x").alias("mean_x"), _mean("mean_y").alias("mean_y"),
        F.min("min_x").alias("min_x"), F.max("max_x").alias("max_x"), F.min("min_y").alias("min_y"), F.max("max_y").alias("max_y"),
    )
    means = whole.select("i", "j", F.col("mean_x").alias("_x"), F.col("mean_y").alias("_y"))
    away_x, away_y = F.col("mean_x") - F.col("_x"), F.col("mean_y") - F.col("_y")
    known = F.col("n") > 0
    spread = (
        states.where(known)
        .join(means, ["i", "j"])
        .groupBy("i", "j")
        .agg(
            F.sum(F.col("dev_x") + F.col("n") * away_x * away_x).alias("dev_x"),
            F.sum(F.col("dev_y") + F.col("n") * away_y * away_y).alias("dev_y"),
            F.sum(F.col("dev_xy") + F.col("n") * away_x * away_y).alias("dev_xy"),
        )
    )
    return whole.join(spread, ["i", "j"], "left")


def _mean(column: str) -> Column:
    """Mean of the rows of all states."""
    return F.sum(F.col("n") * F.col(column)) / F.nullif(F.sum("n"), F.lit(0).cast("long"))
