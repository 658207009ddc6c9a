"""Nearest neighbours by a forest of random-projection trees (operator 8).

Each tree halves the space by hyperplanes between two random vectors, at the median. The planes are fitted on a sample of at
most ``SAMPLE`` vectors; every vector is indexed, by one leaf per tree. A query walks all trees through one
priority queue, always into the branch whose planes it is least far beyond, until it has met its share of leaves. The share is
learned: ``CHECKS`` vectors of the sample look for their nearest in the sample, and the leaves they have to meet for ``RECALL`` of
them are a few in a thousand where vectors lie in clusters, and some in a hundred where they are random. Each leaf then compares its vectors with its queries exactly, in double precision, and keeps the nearest of each query, and the nearest
of all leaves are the answer.

Equal vectors are one entry that carries the least ids that an answer can need, so copies neither fill leaves nor answers.
The planes have a fixed size (``TREES * 2**DEPTH`` planes at most) and are sent to all tasks. Leaves are joined in blocks
of ``BLOCK_VECTORS`` by ``BLOCK_QUERIES``, so a task's memory does not grow with the table.

Edge cases: vectors that are null, empty, zero, hold null or non-finite numbers or have another length than most take no
part, as query or candidate; nor do rows with a null id. Repeated rows are candidates of their own; a repeated query
row is answered once. Other columns are ignored. With fewer candidates than asked for, all are returned. An empty table
gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.arrow import map_batches, text_column
from tenura.session import materialize

TREES = 16
DEPTH = 8
LEAF = 16
SAMPLE = 16_384
# Share of the neighbours that the visited leaves are to hold, and the sample's vectors that tell how many leaves that takes.
RECALL, CHECKS = 0.96, 128
BLOCK_VECTORS = 16_384
BLOCK_QUERIES = 2_048
SEED = 8


class Forest:
    """Planes of all trees: node ``n`` of a tree has the children ``2n + 1`` and ``2n + 2``."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.depth = max(0, min(depth, int(np.log2(max(1, len(sample)) / leaf)))) if len(sample) else 0
        inner, width = (1 << self.depth) - 1, sample.shape[1]
        self.normals, self.cuts = np.zeros((trees, inner, width)), np.zeros((trees, inner))
        for tree in range(trees):
            at = np.zeros(len(sample), dtype=np.int64)
            for node in range(inner):
                own = np.flatnonzero(at == node)
                normal = np.zeros(width)
                if len(own) > 1:
                    one, two = rng.choice(own, 2, replace=False)
                    normal = sample[one] - sample[two]
                if not normal.any():
                    normal = rng.standard_normal(width)
                normal /= np.linalg.norm(normal)
                side = sample[own] @ normal
                self.normals[tree, node] = normal
                self.cuts[tree, node] = np.median(side) if len(own) else 0.0
                at[own] = 2 * node + 1 + (side > self.cuts[tree, node])

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def index(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree."""
        out = np.zeros((len(vectors), len(self.cuts)), dtype=np.int32)
        for tree in range(len(self.cuts)):
            at = np.zeros(len(vectors), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, self.normals[tree][at]) > self.cuts[tree][at]
                at = 2 * at + 1 + side
            out[:, tree] = at - (self.leaves - 1)
        return out

    def search(self, query: np.ndarray, sizes: np.ndarray, share: float, least: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue: a share of all leaves, and ``least`` vectors of one tree."""
        inner = self.leaves - 1
        margins = self.normals @ query - self.cuts if inner else None
        queue = [(-np.inf, tree, 0) for tree in range(len(self.cuts))]
        heapq.heapify(queue)
        wanted = int(np.ceil(share * len(self.cuts) * self.leaves))
        found, held = [], np.zeros(len(self.cuts), dtype=np.int64)
        while queue and (len(found) < wanted or held.max() < least):
            beyond, tree, node = heapq.heappop(queue)
            if node >= inner:
                found.append((tree, node - inner))
                held[tree] += sizes[tree, node - inner]
                continue
            margin = margins[tree, node]
            # The far side is as far away as the furthest plane on the way.
            heapq.heappush(queue, (max(beyond, margin), tree, 2 * node + 1))
            heapq.heappush(queue, (max(beyond, -margin), tree, 2 * node + 2))
        return found


def needed_share(forest: Forest, sample: np.ndarray, k: int, recall: float = RECALL, checks: int = CHECKS, seed: int = SEED) -> float:
    """Share of all leaves at which that share of the ``k`` nearest of some of the sample's vectors has been met."""
    if len(sample) < 2:
        return 1.0
    trees, leaves = len(forest.cuts), forest.leaves
    chosen = np.random.default_rng(seed).choice(len(sample), min(checks, len(sample)), replace=False)
    at, none = forest.index(sample), np.zeros((trees, leaves), dtype=np.int64)
    met = []
    for i in chosen:
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        distance[i] = np.inf
        nearest_to = np.argpartition(distance, min(k, len(sample) - 1) - 1)[: min(k, len(sample) - 1)]
        rank = np.empty((trees, leaves), dtype=np.int64)
        order = np.array(forest.search(sample[i], none, 1.0, 0))
        rank[order[:, 0], order[:, 1]] = np.arange(1, len(order) + 1)
        met.append(rank[np.arange(trees), at[nearest_to]].min(axis=1))
    met = np.sort(np.concatenate(met))
    return float(met[int(np.ceil(recall * len(met))) - 1]) / (trees * leaves)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _valid(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``id`` and ``vector`` (doubles) of the rows that take part, and the vectors' length."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & fine & F.exists("vector", lambda x: x != 0))
    top = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    width = top[0]["n"] if top else 1
    return rows.where(F.size("vector") == width), width


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    share: float | None = None,
    sample: int = SAMPLE,
    recall: float = RECALL,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance) of the ``k`` nearest found for each query.

    ``is_query`` is a condition on the column ``id``. A query's own row is no candidate for it. ``share`` of all leaves are
    visited, without one as many as hold ``recall`` of the neighbours inside the sample.
    """
    spark = df.sparkSession
    rows, width = _valid(df, id_col, vector_col)
    kind = df.schema[id_col].dataType.simpleString()
    # An answer holds k candidates: of equal vectors, only the k + 1 least ids can be among them.
    least = Window.partitionBy("vector").orderBy("id")
    numbered = rows.withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= k + 1)
    entries = numbered.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = materialize(entries.withColumn("node", F.monotonically_increasing_id()), "entries")
    n = entries.count()
    part = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 0.9 * sample / max(1, n)))
    picked = entries.where(part if n > sample else F.lit(True)).select("vector").limit(sample).collect()
    drawn = np.array([r["vector"] for r in picked], dtype=np.float64).reshape(len(picked), width)
    fitted = Forest(drawn)
    if share is None:
        share = needed_share(fitted, drawn, k, recall)
    forest = spark.sparkContext.broadcast(fitted)

    def leaf_of(batch):
        found = forest.value.index(_matrix(text_column(batch, "vector"), width))
        return {"node": text_column(batch, "node"), "leaves": list(found)}

    indexed = map_batches(entries.select("node", "vector"), leaf_of, "node long, leaves array<int>")
    places = indexed.select("node", F.posexplode("leaves").alias("tree", "leaf"))
    places = materialize(places, "places")
    sizes = np.zeros((len(fitted.cuts), fitted.leaves), dtype=np.int64)
    for r in places.groupBy("tree", "leaf").count().collect():  # a row per leaf
        sizes[r["tree"], r["leaf"]] = r["count"]
    leaf_sizes = spark.sparkContext.broadcast(sizes)

    asked = rows.where(is_query).select("id", "vector").distinct()
    asked = materialize(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    enough = 4 * (k + 1)

    def walk(batch):
        vectors = _matrix(text_column(batch, "vector"), width)
        found = [forest.value.search(v, leaf_sizes.value, share, enough) for v in vectors]
        flat = [[tree * forest.value.leaves + leaf for tree, leaf in f] for f in found]
        return {"query": text_column(batch, "query"), "leaves": flat}

    visits = map_batches(asked.select("query", "vector"), walk, "query long, leaves array<int>")
    visits = visits.select("query", F.explode("leaves").alias("leaf"))
    visits = materialize(visits, "visits")

    # Blocks of a leaf: each block of its vectors meets each block of its queries.
    flat_leaf = (F.col("tree") * fitted.leaves + F.col("leaf")).alias("leaf")
    counts = (
        places.select(flat_leaf).groupBy("leaf").count().withColumnRenamed("count", "_v")
        .join(visits.groupBy("leaf").count().withColumnRenamed("count", "_q"), "leaf")
        .select("leaf", F.ceil(F.col("_v") / BLOCK_VECTORS).alias("vb"), F.ceil(F.col("_q") / BLOCK_QUERIES).alias("qb"))
    )
    everyone = F.broadcast(counts)  # at most TREES * 2**DEPTH rows
    v = (
        places.select("node", flat_leaf).join(everyone, "leaf").join(entries.select("node", "vector", F.col("ids")[0].alias("first")), "node")
        .select("leaf", F.pmod(F.xxhash64("node"), "vb").alias("i"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("j"), "node", "first", "vector")
    )
    q = (
        visits.join(everyone, "leaf").join(asked.select("query", F.col("vector")), "query")
        .select("leaf", F.explode(F.sequence(F.lit(0), F.col("vb") - 1)).alias("i"), F.pmod(F.xxhash64("query"), "qb").alias("j"), "query", "vector")
    )
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        vectors = _matrix(left["vector"].combine_chunks(), width)
        first, node = left["first"].to_numpy(zero_copy_only=False), left["node"].to_numpy()
        out = {"query": [], "node": [], "score": []}
        for query, vector in zip(right["query"].to_pylist(), _matrix(right["vector"].combine_chunks(), width)):
            score = np.sqrt(((vectors - vector) ** 2).sum(axis=1))
            if len(score) > k + 1:
                bound = np.partition(score, k)[k]
                at = np.flatnonzero(score <= bound)
                at = at[np.lexsort((first[at], score[at]))[: k + 1]]
            else:
                at = np.arange(len(score))
            out["query"].append(np.full(len(at), query))
            out["node"].append(node[at])
            out["score"].append(score[at])
        return pa.Table.from_arrays([pa.array(np.concatenate(out[c])) for c in schema.names], schema=schema)

    key = ["leaf", "i", "j"]
    met = v.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(compare, "query long, node long, score double")
    # The same entry from several trees has the same score.
    found = met.groupBy("query", "node").agg(F.min("score").alias("score"))
    named = found.join(asked.select("query", F.col("id").alias("query_id"), F.col("vector").alias("_qv")), "query")
    named = named.join(entries.select("node", "ids"), "node")
    # At distance 0 the query's own row is one of the ids.
    own = F.array_position("ids", F.col("query_id"))
    others = F.when(
        (F.col("score") == 0) & (own > 0),
        F.concat(F.slice("ids", F.lit(1), (own - 1).cast("int")), F.slice("ids", (own + 1).cast("int"), F.lit(k + 1))),
    ).otherwise(F.col("ids"))
    each = named.select("query", "query_id", "score", F.explode(others).alias("vec_id"))
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").cast(kind).alias("vec_id"), "score")
