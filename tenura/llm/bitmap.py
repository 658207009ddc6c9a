"""A bitmap of key hashes: a filter of fixed size that may be sent to every task whatever the number of keys.

It lets all keys of a set pass, and others with the share of bits that are set; an exact join has to follow. More keys
only make it let more pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.arrow import task
from tenura.session import materialize

BITS = 1 << 25  # 4 MB
_BLOCK = 32_768  # bits of one aggregated piece
_SLOTS = 1 << 17  # counters of one merged piece
_FAN = 64  # pieces merged by one task


def bit_of(key: Column, bits: int = BITS) -> Column:
    """Bit number of a long key."""
    return F.pmod(F.shiftright(key, 7), F.lit(bits))


def bits_of(keys: np.ndarray, bits: int = BITS) -> np.ndarray:
    """As :func:`bit_of`, for an array of 64-bit integers."""
    return (keys.view(np.int64) >> np.int64(7)) & np.int64(bits - 1)


def build(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """The bitmap of the long column ``key`` as bytes, OR-ed in the tasks; ``bits / 8`` bytes reach the driver."""
    at = bit_of(F.col(key), bits)
    # Built-in bitmap functions number bits from 1 within pieces of 32,768.
    pieces = (
        keys.where(F.col(key).isNotNull())
        .groupBy(F.floor(at / _BLOCK).cast("long").alias("_piece"))
        .agg(F.bitmap_construct_agg(F.pmod(at, F.lit(_BLOCK))).alias("_bits"))
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in pieces.collect():
        held = np.frombuffer(row["_bits"], dtype=np.uint8)
        first = row["_piece"] * (_BLOCK // 8)
        out[first : first + len(held)] = held
    return out


def holds(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Flags of the keys whose bit is set."""
    at = bits_of(keys, len(bitmap) * 8)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counters of a piece, mostly zero: bits of those above zero, then their values, both compressed."""
    above, packer = counts > 0, zstandard.ZstdCompressor(level=1)
    bits = packer.compress(np.packbits(above).tobytes())
    return len(bits).to_bytes(4, "little") + bits + packer.compress(counts[above].tobytes())


def _unpack_counts(held: bytes) -> np.ndarray:
    reader, end = zstandard.ZstdDecompressor(), 4 + int.from_bytes(held[:4], "little")
    counts = np.unpackbits(np.frombuffer(reader.decompress(held[4:end]), dtype=np.uint8))
    counts[counts > 0] = np.frombuffer(reader.decompress(held[end:]), dtype=np.uint8)
    return counts


def build_frequent(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], least: int) -> np.ndarray:
    """The bitmap of the keys that ``keys_of`` yields ``least`` times or more (255 at most) over all batches of ``df``.

    Each task counts its keys in ``BITS`` counters of one byte that stop at ``least``. A counter that keys share is the sum of
    their counts, so no frequent key is missed. Counters are added piece by piece, ``_FAN`` tasks at a time; what reaches the
    driver has the size of the bitmap.
    """

    def count(batches):
        counts = np.zeros(BITS, dtype=np.uint8)
        for batch in batches:
            for keys in keys_of(batch):
                at, n = np.unique(bits_of(keys), return_counts=True)
                counts[at] = np.minimum(counts[at] + n, least)
        part = TaskContext.get().partitionId()
        for piece in range(BITS // _SLOTS):
            held = counts[piece * _SLOTS : (piece + 1) * _SLOTS]
            if held.any():
                yield pa.RecordBatch.from_pydict({"piece": [piece], "part": [part], "held": [_pack_counts(held)]}, target)

    def add(group: pa.Table) -> pa.Table:
        counts = np.zeros(_SLOTS, dtype=np.uint8)
        for held in group["held"]:
            own = _unpack_counts(held.as_py())
            counts = np.minimum(counts.astype(np.uint16) + own, least).astype(np.uint8)
        held = _pack_counts(counts)
        return pa.Table.from_pydict({"piece": group["piece"][:1], "part": group["part"][:1], "held": [held]}, target)

    def often(batches):
        for batch in batches:
            tables = [_unpack_counts(h.as_py()) for h in batch.column(2)]
            bits = [np.packbits(t >= least, bitorder="little").tobytes() for t in tables]
            yield pa.RecordBatch.from_pydict({"piece": batch.column(0), "part": batch.column(1), "held": bits}, target)

    target = pa.schema([("piece", pa.int32()), ("part", pa.int64()), ("held", pa.binary())])
    kind = "piece int, part long, held binary"
    rows = materialize(df.mapInArrow(task(count), kind), "counters")
    parts = (rows.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        rows = rows.withColumn("part", F.floor(F.col("part") / _FAN))
        rows = materialize(rows.groupBy("piece", "part").applyInArrow(add, kind), "counters")
        parts = -(-parts // _FAN)
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for row in rows.mapInArrow(task(often), kind).collect():
        first = row["piece"] * (_SLOTS // 8)
        out[first : first + _SLOTS // 8] = np.frombuffer(row["held"], dtype=np.uint8)
    return out
