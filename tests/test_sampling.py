from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tenura.functions import sampling
from tenura.functions.sampling import exact_sample
from tenura.operators import reports
from tenura.sources import tables
from tests.conftest import rows_of


@pytest.mark.parametrize("cell_rows", [1, 30, 50_000])
@pytest.mark.parametrize("size", [0, 1, 137, 999, 1000, 5000])
def test_size_and_membership(spark, size, cell_rows):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("x"))
    got = exact_sample(df, size, ["id"], cell_rows=cell_rows)
    assert got.columns == ["id", "x"] and got.count() == min(size, 1000)
    assert got.exceptAll(df).isEmpty()
    # The smallest numbers, whatever the rounds.
    ranked = df.withColumn("h", sampling._number(42, F.col("id"))).orderBy("h").limit(size).drop("h")
    assert rows_of(got) == rows_of(ranked)


def test_layout_does_not_matter_and_seed_does(spark):
    df = spark.range(5000)
    samples = [rows_of(exact_sample(d, 50, ["id"])) for d in (df, df.repartition(7), df.orderBy(F.desc("id")))]
    assert samples[0] == samples[1] == samples[2]
    assert rows_of(exact_sample(df, 50, ["id"], seed=7)) != samples[0]
    larger = exact_sample(df, 80, ["id"])
    assert set(samples[0]) < set(rows_of(larger))


def test_every_row_is_as_likely(spark):
    df, hits = spark.range(40), [0] * 40
    for seed in range(60):
        for r in df.withColumn("h", sampling._number(seed, F.col("id"))).orderBy("h").limit(10).collect():
            hits[r.id] += 1
    assert all(abs(h - 15) < 5 * math.sqrt(15 * 0.75) for h in hits)
    assert exact_sample(df, 10, ["id"], seed=3).count() == 10


def test_many_rows_of_one_key_at_the_cut(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, -1).otherwise(F.col("id")).alias("k"), "id")
    for size in (1, 500, 1500, 2500):
        got = exact_sample(df, size, ["k"], cell_rows=100)
        assert got.count() == size and got.exceptAll(df).isEmpty()
    nulls = df.withColumn("k", F.lit(None).cast("long"))
    assert exact_sample(nulls, 700, ["k"], cell_rows=64).count() == 700


def test_without_a_key_places_decide(spark, tmp_path):
    spark.range(400).select(F.lit(1).alias("x")).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert exact_sample(stored, 33).count() == 33
    numbered = stored.withColumn("n", F.monotonically_increasing_id())
    assert rows_of(exact_sample(numbered, 33)) == rows_of(exact_sample(numbered, 33))
    assert exact_sample(stored.limit(0), 5).count() == 0 == exact_sample(stored.limit(0), 5, ["x"]).count()


def test_reports_on_a_sample(spark):
    df = spark.range(1000).select("id", F.col("id").cast("double").alias("x"), (F.col("id") * -2).alias("y"))
    whole = reports.clip_distribution(df, "x", 100, 900, sample_size=50, sample_key=["id"])["regions"]
    assert whole.where("region = 'overall'").first()["count"] == 50
    figures = ("region", "count", "min", "max", "median")
    assert rows_of(whole, *figures) == rows_of(
        reports.clip_distribution(exact_sample(df, 50, ["id"]), "x", 100, 900)["regions"], *figures
    )
    (pair,) = reports.correlation_pairs(df.drop("id"), sample_size=60).collect()
    assert pair.n_rows == 60 and pair.r == pytest.approx(-1)
    (pair,) = reports.correlation_pairs(df, exclude=["id"], sample_size=0, min_rows=0).collect() or [None]
    assert pair is None
    assert tables.table_sample(df, 4, ["id"]).count() == 4
