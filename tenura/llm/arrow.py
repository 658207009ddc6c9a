"""Arrow batches through Spark tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BATCH_ROWS = 2_000


def slices(batch: pa.RecordBatch, rows: int = BATCH_ROWS):
    """The batch in parts of at most ``rows`` rows, so that results stay small whatever the sender's batch size."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def give_back() -> None:
    """Hand freed memory back to the system: workers outlive their task and sit beside the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def task(run: Callable) -> Callable:
    """A function of an iterator of batches that hands its memory back at the end of a task."""

    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def map_batches(
    df: DataFrame,
    function: Callable,
    schema: str | StructType,
    close: Callable[[], None] | None = None,
    rows: int = BATCH_ROWS,
) -> DataFrame:
    """``df`` through ``function``, which gets a record batch and returns the columns of ``schema`` as a dict.

    A dict from a name to a list or array; every column of the result has the type that ``schema`` states. ``close`` is
    called at the end of each task. ``function`` gets ``rows`` rows at most.
    """
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(struct)

    def run(batches):
        for batch in batches:
            for part in slices(batch, rows):
                columns = function(part)
                arrays = [_typed(columns[field.name], field.type) for field in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
        if close:
            close()

    return df.mapInArrow(task(run), struct)


def _typed(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table has not got, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def keep_rows(df: DataFrame, decide: Callable, needed: str) -> DataFrame:
    """The rows of ``df`` for which ``decide(column) -> bool array`` says so, with all columns as they are."""
    target = to_arrow_schema(df.schema)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                kept = part.filter(pa.array(decide(text_column(part, needed)), type=pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [_typed(column, field.type) for column, field in zip(kept.columns, target)], schema=target
                )

    return df.mapInArrow(task(run), df.schema)
