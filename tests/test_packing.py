from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tenura.functions.packing import DECIMAL_BITS, Packing, day, flag, parts_of, position

RANGES = {
    "boolean": st.booleans(),
    "tinyint": st.integers(-128, 127),
    "smallint": st.integers(-(1 << 15), (1 << 15) - 1),
    "int": st.integers(-(1 << 31), (1 << 31) - 1),
    "bigint": st.integers(-(1 << 63), (1 << 63) - 1) | st.sampled_from([-(1 << 63), (1 << 63) - 1, -1, 0, 0xFFFFFFFF, -(1 << 32)]),
    "date": st.dates(date(1, 1, 1), date(9999, 12, 31)),
}
ROWS = [
    ("date", "int"), ("bigint",), ("boolean", "bigint", "date"), ("int", "bigint"), ("tinyint", "date", "smallint", "int", "int"),
    ("date", "boolean", "boolean"), ("bigint", "smallint", "date", "boolean"),
]


def first_nulls(row):
    return tuple((v is not None, v) if v is not None else (False, 0) for v in row)


@pytest.mark.parametrize("kinds", ROWS, ids="-".join)
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_order_and_values_survive(spark, kinds, data):
    row = st.tuples(*[st.none() | RANGES[k] for k in kinds])
    rows = data.draw(st.lists(row, min_size=1, max_size=30))
    names = [f"c{i}" for i in range(len(kinds))]
    schema = StructType.fromDDL(", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    df = spark.createDataFrame(rows, schema)
    packing = Packing(*parts_of(df, names))
    assert packing.bits <= DECIMAL_BITS
    packed = df.select(*names, packing.pack().alias("p"))
    back = packed.select(*names, "p", *[v.alias(f"b_{n}") for n, v in packing.unpack(F.col("p")).items()]).collect()
    for r in back:
        assert tuple(r[f"b_{n}"] for n in names) == tuple(r[n] for n in names)
    by_number = [tuple(r[n] for n in names) for r in sorted(back, key=lambda r: r["p"])]
    assert by_number == sorted(rows, key=first_nulls)


def test_too_wide_and_other_types(spark):
    df = spark.createDataFrame([(1, 2, "x", 1.0)], "a long, b long, s string, d double")
    assert parts_of(df, ["a", "b"]) is None and parts_of(df, ["a", "s"]) is None and parts_of(df, ["d"]) is None
    assert parts_of(df, ["a"]) is not None
    with pytest.raises(ValueError):
        Packing(position("a", 60), position("b", 60), day("c"))


def test_positions_out_of_range_are_errors(spark):
    packing = Packing(day("d"), position("n", 10), flag("f"))
    assert packing.bits <= 63
    df = spark.createDataFrame([(date(2016, 1, 1), 5, 1), (date(2016, 1, 1), None, 0), (None, 1022, None)], "d date, n long, f long")
    got = df.select(packing.pack().alias("p")).select(*[v.alias(n) for n, v in packing.unpack(F.col("p")).items()])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))
    for wrong in (-1, 1023):
        with pytest.raises(Exception, match="packed range"):
            spark.createDataFrame([(None, wrong, 0)], "d date, n long, f long").select(packing.pack()).collect()


def test_nothing_packed_is_nothing(spark):
    packing = Packing(day("d"), position("n"), position("m"))
    row = spark.range(1).select(*[v.alias(n) for n, v in packing.unpack(F.lit(None).cast("decimal(38,0)")).items()]).first()
    assert row.asDict() == {"d": None, "n": None, "m": None}
