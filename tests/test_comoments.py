from __future__ import annotations

import numpy as np
import pandas
import pytest
from pyspark.sql import functions as F

from tenura.functions.comoments import State, co_moments
from tenura.operators import reports
from tests.test_plans import plan


def sparse(rng, rows, width, missing=0.3):
    values = rng.standard_normal((rows, width)) * 10.0 ** rng.integers(-3, 4, width) + 10.0 ** rng.integers(0, 7, width)
    return values, rng.random((rows, width)) > missing


def check(state, values, known):
    width = values.shape[1]
    for i in range(width):
        for j in range(width):
            rows = known[:, i] & known[:, j]
            x, y = values[rows, i], values[rows, j]
            assert state.n[i, j] == len(x)
            if len(x):
                scale = max(1e-300, float(np.abs(x).max()))
                assert state.mean[i, j] == pytest.approx(x.mean(), rel=1e-12)
                assert state.dev[i, j] == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-6, abs=1e-12 * scale**2)
                assert (state.low[i, j], state.high[i, j]) == (x.min(), x.max())
                product = ((x - x.mean()) * (y - y.mean())).sum()
                spread = np.sqrt(((x - x.mean()) ** 2).sum() * ((y - y.mean()) ** 2).sum())
                assert state.both[i, j] == pytest.approx(product, abs=1e-6 * spread + 1e-12)


@pytest.mark.parametrize("missing", [0.0, 0.3, 0.95])
def test_merged_states_are_the_state_of_all_rows(missing):
    values, known = sparse(np.random.default_rng(5), 400, 6, missing)
    known[:60, 2] = False
    parts = [State.of(values[a:b], known[a:b]) for a, b in ((0, 1), (1, 60), (60, 61), (61, 250), (250, 400))]
    forward = parts[0]
    for part in parts[1:]:
        forward = forward.merged(part)
    tree = parts[4].merged(parts[2]).merged(parts[0].merged(parts[3].merged(parts[1])))
    for state in (forward, tree, State.of(values, known)):
        assert state.rows == 400
        check(state, values, known)


def test_large_means_do_not_swallow_the_spread():
    rng = np.random.default_rng(1)
    values = rng.standard_normal((5000, 3)) + 1e9
    values[:, 2] = values[:, 0] * 0.5 + values[:, 1]
    known = np.ones(values.shape, dtype=bool)
    state = State.of(values[:100], known[:100])
    for a in range(100, 5000, 700):
        state = state.merged(State.of(values[a : a + 700], known[a : a + 700]))
    wanted = np.corrcoef((values - 1e9).T)
    r = state.both / np.sqrt(np.outer(np.diag(state.dev), np.diag(state.dev)))
    assert np.abs(r - wanted).max() < 1e-5


def test_infinite_values_touch_only_their_pairs():
    values = np.array([[1.0, np.inf, 3.0], [2.0, 1.0, np.nan], [3.0, 5.0, 9.0], [5.0, 0.0, 1.0]])
    known = np.array([[True, False, True], [True, True, False], [True, True, True], [True, True, True]])
    state = State.of(values, known)
    check(state, np.where(known, values, 0.0), known)
    known[:] = True
    state = State.of(values, known)
    assert np.isfinite(state.both[0, 0]) and not np.isfinite(state.both[0, 1]) and not np.isfinite(state.both[2, 0])


@pytest.mark.parametrize("handling", ["dropna", "fillzero", "fillmean", "pairwise"])
@pytest.mark.parametrize("parts", [1, 6])
def test_pairs_over_many_tasks(spark, handling, parts):
    values, known = sparse(np.random.default_rng(9), 300, 5, 0.1)
    known[:, 4] &= np.arange(300) % 50 != 0
    rows = [tuple(float(v) if k else None for v, k in zip(*row)) for row in zip(values, known)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(parts)
    table = pandas.DataFrame(np.where(known, values, np.nan), columns=list("abcde"))
    table = {"dropna": table.dropna(), "fillzero": table.fillna(0), "fillmean": table.fillna(table.mean())}.get(handling, table)
    got = reports.correlation_pairs(df, null_handling=handling).collect()
    assert len(got) == 10
    for r in got:
        assert r.n_rows == len(table) and r.r == pytest.approx(table.corr().loc[r.col_a, r.col_b], abs=1e-6)


@pytest.mark.parametrize("handling", ["dropna", "fillzero", "fillmean", "pairwise"])
def test_columns_without_values(spark, handling):
    df = spark.range(20).select(F.col("id").cast("double").alias("a"), F.lit(None).cast("double").alias("b"), (F.col("id") % 3).alias("c"))
    got = {(r.col_a, r.col_b): r.r for r in reports.correlation_pairs(df, null_handling=handling).collect()}
    if handling == "dropna":
        assert got == {}
    else:
        assert got["a", "b"] is None and got["b", "c"] is None and got["a", "c"] == pytest.approx(0.035, abs=0.1)
    assert reports.correlation_pairs(df.limit(0), null_handling=handling, min_rows=0).count() == 0


def test_rows_are_never_unfolded(spark):
    df = spark.range(100).select(*[(F.col("id") * n % 17).cast("double").alias(f"c{n}") for n in range(12)])
    text = plan(reports.correlation_pairs(df))
    assert "Generate" not in text and "Scan parquet" in text
    # One row for each task and pair is all that is stored.
    assert co_moments(df.coalesce(1), df.columns).count() == 78
