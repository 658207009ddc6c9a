from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tenura import session
from tests.conftest import rows_of


class Settings:
    """A session's settings alone."""

    def __init__(self, **values):
        self.conf, self.values = self, {k.replace("_", "."): v for k, v in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_folder_is_shared():
    named = Settings(spark_checkpoint_dir="hdfs://n/ck/", spark_master="spark://m:7077", spark_sql_warehouse_dir="/wh")
    assert session.scratch_dir(named) == "hdfs://n/ck"
    assert session.scratch_dir(Settings(spark_master="local", spark_sql_warehouse_dir="/wh")) == "/wh/_scratch"
    assert session.scratch_dir(Settings(spark_master="local[4]", spark_sql_warehouse_dir="file:/wh/")) == "file:/wh/_scratch"
    assert session.scratch_dir(Settings(spark_master="yarn", spark_sql_warehouse_dir="s3a://b/wh")) == "s3a://b/wh/_scratch"
    for warehouse in ("/wh", "file:/wh", "spark-warehouse"):
        for master in ("yarn", "spark://m:7077", "local-cluster[2,1,1024]"):
            with pytest.raises(ValueError):
                session.scratch_dir(Settings(spark_master=master, spark_sql_warehouse_dir=warehouse))


def test_partitions_follow_the_input_up_to_a_bound():
    assert session.shuffle_partitions(1) == 200
    assert session.shuffle_partitions(1 << 40) == 8_192
    assert session.shuffle_partitions(100 << 40) == 100_000


def test_small_tables_have_few_files(spark, tmp_path):
    most = session.FILES_PER_CORE * spark.sparkContext.defaultParallelism
    spark.range(5_000).repartition(300).write.parquet(str(tmp_path / "t"))
    many = spark.read.parquet(str(tmp_path / "t")).repartition(300, "id")
    stored = session.materialize(many.withColumn("at", F.monotonically_increasing_id()))
    assert len(stored.inputFiles()) <= most
    assert stored.select("at").distinct().count() == 5_000 and {r[0] for r in stored.select("id").collect()} == set(range(5_000))
    # A plan of a large estimate keeps its parts.
    large = many
    for name in "abcd":
        large = large.crossJoin(many.withColumnRenamed("id", name))
    assert session.compact(large) is large
