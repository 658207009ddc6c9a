from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import bond

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    """All pairs, one by one, in Python integers."""
    held = [
        (i, [int(np.floor(256 * float(x))) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and abs(x) <= bond.LIMIT for x in v)
    ]
    out = []
    for i, v, label in held:
        if i % 50:
            continue
        met = sorted((-sum(a * b for a, b in zip(v, w)), j, m == label) for j, w, m in held if j != i and len(w) == len(v))
        for score, j, _ in [m for m in met if m[2]][:positives]:
            inside = [(-s, k) for s, k, same in met if not same and low * -score <= 100 * -s <= high * -score]
            out += [(i, j, r + 1, k, -score, s) for r, (s, k) in enumerate(inside[:negatives])]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in bond.hard_negatives(df, F.col("vec_id") % 50 == 0, **more).collect())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((6, 24))
    made = [(centres[i % 6] + 0.7 * rng.standard_normal(24)).astype(np.float32).tolist() for i in range(700)]
    return [(i, v, int(rng.integers(0, 3))) for i, v in enumerate(made)]


def test_against_brute_force(spark, vectors):
    df = spark.createDataFrame(vectors, VECTORS).repartition(3)
    wanted = brute(vectors)
    assert mined(df) == wanted and len(wanted) > 50
    assert mined(df, positives=2, negatives=7, low=10, high=120) == brute(vectors, 2, 7, 10, 120)


def test_small_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(bond, "BLOCK_ROWS", 40)
    monkeypatch.setattr(bond, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(bond, "CELL_BLOCKS", 2)
    assert mined(spark.createDataFrame(vectors, VECTORS).repartition(4)) == brute(vectors)


def test_many_copies_and_one_label(spark):
    rng = np.random.default_rng(9)
    same = rng.standard_normal(6).astype(np.float32).tolist()
    rows = [(i, same, 1) for i in range(300)] + [(i, rng.standard_normal(6).astype(np.float32).tolist(), i % 4) for i in range(300, 420)]
    assert mined(spark.createDataFrame(rows, VECTORS)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.5], 1), (2, [0.9, 1.0], 2), (2, [0.9, 1.0], 2), (3, None, 1), (4, [], 1),
        (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 2.0, 3.0], 1), (9, [1.0, 2.0, 1.0], 2), (None, [1.0, 2.1], 1),
        (10, [3.0, 2.0], None), (11, [0.5, 1.0], 2), (50, [2.0, 1.0, 0.5], 1), (12, [0.0, 0.0], 1), (100, [-1.0, -2.0], 1), (150, [1e30, 1.0], 1),
        (200, [60_000.0, -60_000.0], 1), (13, [59_000.0, -60_000.0], 1), (14, [50_000.0, -50_000.0], 3),
    ]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], VECTORS + ", rank int, block string, score int")
    assert mined(df) == brute(rows) != []
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 50")) == []


def test_unread_dimensions(vectors):
    """What is left out early has been judged by its bounds: fewer cells are read, the result is the same."""
    rng = np.random.default_rng(1)
    cells = np.floor(256 * rng.standard_normal((64, 4_000)) * np.geomspace(8, 0.01, 64)[:, None]).astype(np.int32)
    block = bond.Block.of(np.arange(4_000), np.zeros(4_000, dtype=np.int64), cells)
    vector, read = cells[:, 7].astype(np.int64), []
    exact = vector @ cells

    def keep(partial, low, high):
        read.append(len(partial))
        return partial + high >= bond._nth_largest(partial, 5) + low

    rows, scores = bond.scan(block, vector, np.arange(4_000), keep)
    assert (scores == exact[rows]).all() and set(np.argsort(-exact)[:5]) <= set(rows)
    assert sum(read) < 0.4 * 4_000 * 8


@pytest.mark.parametrize("reach", [10, 1 << 24])
def test_windows_are_exact_for_large_numbers(reach):
    rng = np.random.default_rng(reach % 97)
    cells = rng.integers(-reach, reach, (33, 500)).astype(np.int32)
    block = bond.Block.of(np.arange(500), np.zeros(500, dtype=np.int64), cells)
    vector = rng.integers(-reach, reach, 33)
    exact = [sum(int(a) * int(b) for a, b in zip(vector, cells[:, i])) for i in range(500)]
    first, last = sorted(exact)[200], sorted(exact)[420]
    best = bond.Best(4)
    bond.best_in_windows(block, vector, np.arange(500), [(first, last, best)])
    wanted = sorted(((-s, i) for i, s in enumerate(exact) if first <= s <= last))[:4]
    assert [(-s, i) for s, i in zip(best.scores.tolist(), best.ids.tolist())] == wanted
