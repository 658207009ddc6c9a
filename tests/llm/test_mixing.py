from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tenura.llm import mixing
from tests.llm.conftest import words_of

def dimensions():
    return {"source": F.col("source"), "lang": F.col("lang")}



def ipf(cells, targets, rounds=500):
    total = sum(cells.values())
    weight = {k: v / total for k, v in cells.items()}
    for _ in range(rounds):
        for i, target in enumerate(targets):
            sums = defaultdict(float)
            for k, v in weight.items():
                sums[k[i]] += v
            weight = {k: v * target[k[i]] / sums[k[i]] for k, v in weight.items()}
    return weight


def test_weights_match_brute_force(documents):
    powers = {"source": 0.5, "lang": 0.7}
    rows = mixing.sample(documents, dimensions(), powers=powers).collect()
    assert len(rows) == documents.count()
    cells = defaultdict(float)
    for r in rows:
        assert r.n_tokens == len(words_of(r.text))
        cells[r.source, r.lang] += r.n_tokens
    targets = []
    for i, name in enumerate(dimensions()):
        sums = defaultdict(float)
        for k, v in cells.items():
            sums[k[i]] += v
        raised = {k: v ** powers[name] for k, v in sums.items()}
        targets.append({k: v / sum(raised.values()) for k, v in raised.items()})
    wanted = ipf(cells, targets)
    scale = min(cells[k] / wanted[k] for k in cells)
    for r in rows:
        key = (r.source, r.lang)
        assert r.weight == pytest.approx(wanted[key], abs=1e-7)
        assert r.probability == pytest.approx(min(1, scale * wanted[key] / cells[key]), abs=1e-5)


def test_stated_targets_and_budget(spark, documents):
    half = spark.createDataFrame([("en", 0.5), ("fr", 0.5), ("xx", 3.0)], "value string, share double")
    rows = mixing.sample(documents, {"lang": F.col("lang")}, targets={"lang": half}, budget_share=0.4).collect()
    expected = defaultdict(float)
    for r in rows:
        expected[r.lang] += r.probability * r.n_tokens
    total = sum(r.n_tokens for r in rows)
    assert expected["en"] == pytest.approx(0.2 * total, rel=1e-6) and expected["fr"] == pytest.approx(0.2 * total, rel=1e-6)


def test_a_budget_beyond_a_cell_fills_the_others(spark):
    rows = [(i, "w " * 10, "small" if i < 10 else "large") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    half = spark.createDataFrame([("small", 0.5), ("large", 0.5)], "value string, share double")
    got = mixing.sample(df, {"source": F.col("source")}, targets={"source": half}, budget=500.0).collect()
    chance = {r.source: r.probability for r in got}
    assert chance["small"] == 1.0 and chance["large"] == pytest.approx(400 / 900)


def test_odd_rows(odd, nothing):
    found = mixing.sample(odd, dimensions(), powers={"source": 0.5, "lang": 0.5})
    rows = found.collect()
    assert len(rows) == odd.count()
    assert set(found.columns) == set(odd.columns) | {"n_tokens", "weight", "probability", "sampled", "gap"}
    assert all(0 <= r.probability <= 1 for r in rows)
    assert found.select("doc_id", "text", "sampled").distinct().count() == odd.select("doc_id", "text").distinct().count()
    assert mixing.sample(nothing, dimensions(), powers={"source": 0.5, "lang": 0.5}).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_targets_that_can_not_be_met_leave_a_gap(spark):
    rows = [(i, "w " * 10, "a" if i < 50 else "b", "x" if i < 50 else "y") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    tables = {"source": [("a", 0.5), ("b", 0.5)], "lang": [("x", 0.9), ("y", 0.1)]}
    targets = {k: spark.createDataFrame(v, "value string, share double") for k, v in tables.items()}
    found = mixing.sample(df, dimensions(), targets=targets).collect()
    assert {round(r.gap, 6) for r in found} == {0.4}
    met = mixing.sample(df, dimensions(), targets={**targets, "lang": spark.createDataFrame([("x", 0.5), ("y", 0.5)], "value string, share double")})
    assert max(r.gap for r in met.collect()) < 1e-6


def test_kept_rows_are_the_sampled_ones(documents):
    wide = documents.withColumns({c: F.lit("own") for c in ("topic", "weight", "sampled", "_mix_0", "_MIX_tokens", "n_tokens", "gap")})
    more = {"dimensions": {**dimensions(), "topic": mixing.content_type(F.col("text"))}, "powers": {"source": 0.5, "lang": 0.7, "topic": 0.5}}
    drawn = {r.doc_id for r in mixing.sample(documents, **more).where("sampled").collect()}
    kept = mixing.keep_sampled(wide, **more)
    assert kept.columns == wide.columns and {r.doc_id for r in kept.collect()} == drawn and 0 < len(drawn) < documents.count()
    assert kept.exceptAll(wide).isEmpty()


def test_stored_steps_keep_plans_small(documents, monkeypatch):
    """No stored plan reads a table once for every way through the steps before it."""
    read = []

    def counted(df, label="stage", store=mixing.materialize):
        read.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return store(df, label)

    monkeypatch.setattr(mixing, "materialize", counted)
    dims = {**dimensions(), "topic": mixing.content_type(F.col("text")), "long": F.length("text") > 500}
    mixing.sample(documents, dims, powers=dict.fromkeys(dims, 0.7))
    # The cells with their total and the shares of each dimension are the widest.
    assert max(read) <= 2 + len(dims)
