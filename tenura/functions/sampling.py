"""Random samples of an exact size, drawn where the rows are.

Each row has a number, the hash of a seed and of its key, and the rows with the ``size`` smallest numbers are the sample: a uniform one, the
same on every run and in any layout. Which number is the last to be in is found by counting rows per leading bits of the
number, a fixed number of cells, then again inside the cell where the count is reached, until that cell is small; only its rows
are sorted. All others are judged by their own number, so no task holds more of the sample than it has read.

Rows with one key have one number. Where a tie of many rows lies at the cut, they are stored and told apart by their place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.session import materialize

SEED = 42
# Leading bits looked at in each round, of 63.
_ROUNDS = (16, 32, 48, 63)
_BITS = 63
CELL_ROWS = 50_000


def _number(seed: int, *key: Column) -> Column:
    """A hash of 63 bits."""
    return F.xxhash64(F.lit(seed), *key).bitwiseAND(F.lit((1 << _BITS) - 1))


def _cut(marked: DataFrame, need: int, cell_rows: int) -> tuple[int, int, int, int] | None:
    """Leading bits, their value at the cut, rows before that cell, and rows in it; None if there are not ``need`` rows."""
    inside, before, held = F.lit(True), 0, 0
    for at, bits in enumerate(_ROUNDS):
        cell = F.shiftrightunsigned("_number", _BITS - bits)
        counts = marked.where(inside).groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
        # At most 65,536 cells, whatever the number of rows.
        up_to = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reached = counts.withColumn("_upto", F.sum("_n").over(up_to)).where(F.col("_upto") >= need - before)
        found = reached.orderBy("_cell").limit(1).collect()
        if not found:
            return None
        value, held = found[0]["_cell"], found[0]["_n"]
        before += found[0]["_upto"] - held
        if held <= cell_rows or at == len(_ROUNDS) - 1:
            return bits, value, before, held
        inside = cell == value
    return None


def exact_sample(
    df: DataFrame, size: int, key: Sequence[str] | None = None, seed: int = SEED, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``size`` rows of ``df`` at random, all of them if there are fewer.

    ``key`` names columns that tell rows apart; with it the sample depends on nothing but keys and seed. Without one the place of
    a row decides, so the same stored table gives the same sample. Rows with one key are drawn together, except at the cut.
    """
    if size <= 0:
        return df.where(F.lit(False))
    if key is None:
        marked = materialize(df.withColumn("_number", _number(seed, F.monotonically_increasing_id())), "sampled")
    else:
        marked = df.withColumn("_number", _number(seed, *[F.col(c) for c in key]))
    found = _cut(marked, size, cell_rows)
    if found is None:
        return marked.drop("_number")
    bits, value, before, held = found
    cell = F.shiftrightunsigned("_number", _BITS - bits)
    sure = marked.where(cell < value).drop("_number")
    rest, need = marked.where(cell == value), size - before
    if held > cell_rows and key is not None:  # many rows of one key
        return sure.unionByName(exact_sample(rest.drop("_number"), need, None, seed, cell_rows))
    # At most ``cell_rows`` rows.
    last = rest.withColumn("_place", _number(seed, F.monotonically_increasing_id())).orderBy("_number", "_place").limit(need)
    return sure.unionByName(last.drop("_number", "_place"))
