"""Columns packed into one number that orders as the columns do, NULLs first.

The largest or smallest of a struct is found by sorting the rows of a group, as a struct cannot be updated in place. A number can, so
``max`` and ``min`` of packed columns are hash aggregations. Up to 63 bits make a long, up to 126 a ``decimal(38, 0)``.
Each column is shifted to be positive and counted from 1, so that 0 is its NULL and comes first, as it does in a struct.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DataType, DateType, IntegerType, LongType, ShortType

LONG_BITS, DECIMAL_BITS = 63, 126
# Days from 0001-01-01 to 9999-12-31, counted from 1970-01-01.
_FIRST_DAY, _DAYS = -719_162, 3_652_059
_HALF = 32


@dataclass(frozen=True)
class Part:
    """One packed column: the values from ``low`` to ``high`` of a type."""

    name: str
    kind: DataType
    low: int
    high: int

    @property
    def bits(self) -> int:
        return (self.high - self.low + 1).bit_length()


def position(name: str, bits: int = 40) -> Part:
    """A long from 0 to below ``2 ** bits``; rows outside raise an error."""
    return Part(name, LongType(), 0, (1 << bits) - 2)


def flag(name: str) -> Part:
    """A long that is 0 or 1."""
    return Part(name, LongType(), 0, 1)


def day(name: str) -> Part:
    return Part(name, DateType(), _FIRST_DAY, _FIRST_DAY + _DAYS - 1)


def parts_of(df: DataFrame, columns: Sequence[str]) -> list[Part] | None:
    """Parts for columns of ``df`` with the whole range of their types, None if they are too wide or of another type."""
    found = []
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, DateType):
            found.append(day(name))
        elif isinstance(kind, BooleanType):
            found.append(Part(name, kind, 0, 1))
        elif isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
            half = 1 << {ByteType: 7, ShortType: 15, IntegerType: 31, LongType: 63}[type(kind)]
            found.append(Part(name, kind, -half, half - 1))
        else:
            return None
    return found if sum(p.bits for p in found) <= DECIMAL_BITS else None


class Packing:
    """How some columns are packed, the first one leading the order."""

    def __init__(self, *parts: Part):
        self.parts = parts
        self.bits = sum(p.bits for p in parts)
        if self.bits > DECIMAL_BITS:
            raise ValueError(f"{self.bits} bits do not fit into a number")
        # Words of at most 62 bits, from the highest: (bits, pieces); a piece is a part, the part's bit it starts at and its bits.
        pieces = []
        for part in parts:
            if part.bits > LONG_BITS - 1:  # a whole long, in two halves
                pieces += [(part, _HALF, part.bits - _HALF), (part, 0, _HALF)]
            else:
                pieces.append((part, 0, part.bits))
        if self.bits <= LONG_BITS:
            self.words = [pieces]
        else:
            self.words = [[]]
            for piece in pieces:
                if sum(b for *_, b in self.words[-1]) + piece[2] > LONG_BITS - 1:
                    self.words.append([])
                self.words[-1].append(piece)

    @staticmethod
    def _code(part: Part, value: Column) -> Column:
        """The value counted from 1, 0 for NULL, as a long."""
        if isinstance(part.kind, DateType):
            number = F.unix_date(value).cast("long")
        else:
            number = value.cast("long")
        if not isinstance(part.kind, LongType):
            return F.coalesce(number - part.low + 1, F.lit(0).cast("long"))
        inside = number.between(part.low, part.high)
        wrong = F.raise_error(F.concat(F.lit(f"{part.name} is out of the packed range: "), number.cast("string"))).cast("long")
        return F.when(number.isNull(), F.lit(0).cast("long")).when(inside, number - part.low + 1).otherwise(wrong)

    def _piece(self, part: Part, start: int, bits: int, value: Column) -> Column:
        if part.bits <= LONG_BITS - 1:
            return self._code(part, value)
        # A whole long: shifted by half its range and counted from 1 it has 65 bits. The upper piece has the carry of that 1.
        flipped = value.bitwiseXOR(F.lit(-(1 << 63)))
        low = flipped.bitwiseAND(F.lit((1 << _HALF) - 1))
        full = F.lit((1 << _HALF) - 1)
        if start == 0:
            return F.coalesce((low + 1).bitwiseAND(full), F.lit(0).cast("long"))
        return F.coalesce(F.shiftrightunsigned(flipped, _HALF) + F.when(low == full, 1).otherwise(0), F.lit(0).cast("long"))

    def pack(self, **values: Column | str) -> Column:
        """The number; a part that is not named is the column of its name."""
        total = None
        for word in self.words:
            packed, width = None, 0
            for part, start, bits in word:
                value = values.get(part.name, part.name)
                piece = self._piece(part, start, bits, F.col(value) if isinstance(value, str) else value)
                packed = piece if packed is None else F.shiftleft(packed, bits).bitwiseOR(piece)
                width += bits
            if len(self.words) == 1:
                return packed
            packed = packed.cast("decimal(38,0)")
            total = packed if total is None else (total * F.lit(1 << width).cast("decimal(38,0)") + packed).cast("decimal(38,0)")
        return total

    def unpack(self, number: Column) -> dict[str, Column]:
        """The columns of a number; all NULL for a NULL."""
        longs, rest = [], number
        for word in reversed(self.words):
            width = sum(b for *_, b in word)
            if len(longs) == len(self.words) - 1:
                longs.append(rest.cast("long"))
            else:
                size = F.lit(1 << width).cast("decimal(38,0)")
                longs.append((rest % size).cast("long"))
                rest = F.floor((rest - rest % size) / size).cast("decimal(38,0)")
        pieces: dict[str, list[Column]] = {}
        for word, packed in zip(self.words, reversed(longs)):
            left = sum(b for *_, b in word)
            for part, _, bits in word:
                left -= bits
                mask = F.lit((1 << bits) - 1)
                pieces.setdefault(part.name, []).append(F.shiftrightunsigned(packed, left).bitwiseAND(mask))
        return {part.name: self._value(part, pieces[part.name]) for part in self.parts}

    @staticmethod
    def _value(part: Part, codes: list[Column]) -> Column:
        if len(codes) == 2:
            upper, lower = codes
            none = (upper == 0) & (lower == 0)
            # Take the 1 off again, with its borrow, and put the sign back.
            borrowed = F.when(lower == 0, 1).otherwise(0)
            low = (lower - 1).bitwiseAND(F.lit((1 << _HALF) - 1))
            number = F.shiftleft(upper - borrowed, _HALF).bitwiseOR(low).bitwiseXOR(F.lit(-(1 << 63)))
            return F.when(~none, number)
        number = codes[0] - 1 + part.low
        if isinstance(part.kind, DateType):
            value = F.date_from_unix_date(number.cast("int"))
        elif isinstance(part.kind, BooleanType):
            value = number == 1
        else:
            value = number.cast(part.kind)
        return F.when(codes[0] > 0, value)
