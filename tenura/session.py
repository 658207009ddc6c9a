"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator is planned under. None changes a result.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the aggregate above then needs its own exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Gap lists are bounded by the calendar, so many of them fit before the aggregation turns to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}

# Settings fixed when a session starts. The first saves looking up the call site of every expression.
START_SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_PARTITIONS = 100_000
# A stored table has no more files than a few per core, or than its bytes fill.
FILES_PER_CORE, FILE_BYTES = 4, 16 * 1024 * 1024


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "tenura", master: str | None = None, input_bytes: int | None = None) -> SparkSession:
    """Create a session; ``input_bytes`` sizes the shuffles so a partition stays near 128 MB."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **START_SETTINGS}.items():
        builder = builder.config(name, value)
    if input_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int) -> int:
    """Number of shuffle partitions; adaptive execution merges the small ones.

    One per 128 MB, up to a number that the driver can keep track of: a shuffle of more is spilled in larger parts, and most
    shuffles here carry a small part of the input.
    """
    return min(MAX_PARTITIONS, max(200, -(-input_bytes // TARGET_PARTITION_BYTES)))


# Shuffle files are deleted when the query that made them has ended, not when the driver next collects garbage.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """A block whose queries delete their shuffle files as they end; a query that ends twice makes them twice."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse, if all executors can reach it: with a local master, or a warehouse in a
    store of its own. On a cluster, a warehouse on the driver's disk is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    on_disk = warehouse.startswith("file:") or ":" not in warehouse
    master = spark.conf.get("spark.master", "")
    if on_disk and master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return f"{warehouse}/_scratch"


def compact(df: DataFrame) -> DataFrame:
    """``df`` in no more parts than a few per core, or than its estimated bytes fill; without a shuffle.

    Small tables out of many tasks would be many tiny files, each of which costs more to create than its rows. The estimate
    of a plan is too large rather than too small, and then nothing is merged.
    """
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    parts = max(FILES_PER_CORE * spark.sparkContext.defaultParallelism, -(-size // FILE_BYTES))
    return df.coalesce(parts) if parts < 1 << 20 else df


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage at a stored table, so a lost executor costs a re-read and never a recompute,
    and a result that depends on row placement is fixed once for all its readers.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    stages = _OPEN.get()
    if stages is not None:
        stages.paths.append(path)
    # No reader looks for the marker of a finished job: the schema and the path are handed on by whoever waited for the write.
    compact(df).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Stages:
    """The tables that :func:`materialize` has stored since a block of :func:`stages` began."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def release(self, *results: DataFrame) -> list[str]:
        """Delete the tables that no plan of ``results`` reads; returns the paths of those that stay."""
        read = {root for df in results for root in _roots(df)}
        kept = []
        for path in self.paths:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            store = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if store.makeQualified(at).toString() in read:
                kept.append(path)
            else:
                store.delete(at, True)
        self.paths = kept
        return kept


_OPEN: ContextVar[Stages | None] = ContextVar("open_stages", default=None)


@contextmanager
def stages(spark: SparkSession) -> Iterator[Stages]:
    """A block whose stored tables can be released; what is not released belongs to the block around it."""
    held, outer = Stages(spark), _OPEN.get()
    token = _OPEN.set(held)
    try:
        yield held
    finally:
        _OPEN.reset(token)
        if outer is not None:
            outer.paths += held.paths


def _roots(df: DataFrame) -> set[str]:
    """The folders that the files of a plan lie in."""
    found, leaves = set(), df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            roots = relation.location().rootPaths().iterator()
            while roots.hasNext():
                found.add(roots.next().toString())
    return found
