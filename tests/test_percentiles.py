from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.functions.placement import column_percentiles, exact_percentiles
from tests.test_plans import plan, shuffled  # noqa: F401


def test_many_groups_without_a_broadcast(spark, shuffled):  # noqa: F811
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("g"), (F.xxhash64("id") % 100).alias("x"))
    found = exact_percentiles(df, "x", [0.5], "g")
    assert "Broadcast" not in plan(found)
    got = {r.g: r.value for r in found.collect()}
    rows = df.groupBy("g").agg(F.collect_list("x").alias("x")).collect()
    assert len(got) == 20_000 and all(got[r.g] == np.median(r.x) for r in rows)


def test_many_columns_by_one_sort(spark):
    rng = np.random.default_rng(2)
    data = rng.integers(-5, 9, (300, 31)).astype(float)
    data[rng.random(data.shape) < 0.2] = np.nan
    data[:, 30] = np.nan
    names = [f"c{i}" for i in range(31)]
    rows = [tuple(None if v != v else float(v) for v in row) for row in data]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r.column_name, r.fraction): r.value for r in column_percentiles(df, names, [0.0, 0.1, 0.5, 1.0]).collect()}
    assert len(got) == 30 * 4
    for (name, fraction), value in got.items():
        assert value == pytest.approx(np.nanquantile(data[:, int(name[1:])], fraction))
    assert column_percentiles(df.limit(0), names, [0.5]).count() == 0
