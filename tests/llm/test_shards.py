from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import replace

import pytest
import xxhash
from pyspark.sql import functions as F

from tenura.llm import shards
from tenura.llm.shards import Shard


def draw(name, weight, key):
    top = xxhash.xxh64(f"{name}/{key}".encode(), seed=42).intdigest() >> 11
    return -math.log((top + 0.5) / 2**53) / weight if weight > 0 else math.inf


def descend(key, held):
    """The tree walked down for one key."""
    key = "" if key is None else str(key)
    at = [s for s in held if not s.added]
    late = min(((draw(f"{s.region}/{s.rack}/+{s.number}", s.weight, key), s.number) for s in held if s.added), default=(math.inf, 0))
    for depth, name in enumerate((lambda s: s.region, lambda s: f"{s.region}/{s.rack}", lambda s: f"{s.region}/{s.rack}/{s.number}")):
        weights = Counter()
        for s in at:
            weights[name(s)] += s.weight
        best = min((draw(n, w, key), n) for n, w in weights.items())
        if depth == 0 and late[0] < best[0]:
            return late[1]
        at = [s for s in at if name(s) == best[1]]
    return at[0].number


def assigned(spark, held, n=6_000):
    rows = spark.range(n).select("id", shards.shard_of(F.col("id"), held).alias("shard")).collect()
    return {r["id"]: r["shard"] for r in rows}


def test_tree_against_a_walk(spark):
    uneven = [Shard(i, f"r{i % 3}", f"k{i % 4}", weight=0.5 + i % 5) for i in range(13)] + [Shard(20, "r1", "k9", 2.0, added=True)]
    for held in (shards.tree(), shards.tree(17), uneven):
        got = assigned(spark, held, 800)
        assert got == {k: descend(k, held) for k in range(800)}


def test_shares_follow_weights(spark):
    held = [replace(s, weight=1.0 + s.number % 3) for s in shards.tree(18)]
    counts, total = Counter(assigned(spark, held, 40_000).values()), sum(s.weight for s in held)
    for s in held:
        expected = 40_000 * s.weight / total
        assert abs(counts[s.number] - expected) < 5 * math.sqrt(expected)


@pytest.mark.parametrize("n", [16, 17, 20])
def test_one_more_shard_takes_rows_only_into_itself(spark, n):
    before, after = assigned(spark, shards.tree(n)), assigned(spark, shards.tree(n + 1))
    moved = [k for k in before if before[k] != after[k]]
    assert {after[k] for k in moved} == {n}
    expected = 6_000 / (n + 1)
    assert abs(len(moved) - expected) < 5 * math.sqrt(expected)
    assert len({before[k] for k in moved}) == n


def test_movement_stays_in_subtrees_that_change(spark):
    held = shards.tree()
    place = {s.number: (s.region, s.rack) for s in held}
    heavier = [replace(s, weight=3.0) if s.number == 5 else s for s in held]
    before, after = assigned(spark, held), assigned(spark, heavier)
    home = place[5]
    for key, was in before.items():
        now = after[key]
        if was == now:
            continue
        if place[was][0] != home[0]:
            assert place[now][0] == home[0]
        elif place[was] != home:
            assert place[now] == home
        else:
            assert now == 5
    # Names of other subtrees do not matter: without one region the rows of the others stay.
    less = assigned(spark, [s for s in held if s.region == home[0]])
    assert all(less[k] == was for k, was in before.items() if place[was][0] == home[0])


def test_slots_sizes_and_sums(spark, documents):
    out = shards.place_documents(documents, shards.tree(), shards.tree(17)).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.shard == descend(r.doc_id, shards.tree()) and r.grown_shard in (r.shard, 16)
    for number in {r.shard for r in out}:
        slots = sorted((r.slot, r.doc_id) for r in out if r.shard == number)
        assert [s for s, _ in slots] == list(range(len(slots))) and slots == sorted(slots, key=lambda s: s[1])


def test_one_key_with_most_rows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(9_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
        out = shards.place_documents(df, shards.tree())
        counts = out.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("d"))
        for r in counts.collect():
            assert r.a == 0 and r.b == r.n - 1 and r.d == r.n
        assert out.where("doc_id is null").select("shard").distinct().count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_odd_rows(spark, odd, nothing):
    clash = odd.withColumns({"shard": F.lit(1), "slot": F.lit(2), "size": F.lit("x"), "law": F.lit(None)})
    out = shards.place_documents(clash, shards.tree(), shards.tree(17)).collect()
    assert len(out) == odd.count()
    assert all(r.size == 1 and r.text_crc32 == 0 for r in out if r.doc_id == 0)
    assert {r.shard for r in out if r.doc_id is None} == {descend(None, shards.tree())}
    assert shards.place_documents(nothing, shards.tree()).count() == 0
    with pytest.raises(ValueError):
        shards.tree(3)
    with pytest.raises(ValueError):
        shards.shard_of(F.col("doc_id"), [Shard(0, "a", "b", 0.0)])


def test_written_shards(spark, documents, tmp_path):
    path = str(tmp_path / "out")
    shards.write_shards(documents, shards.tree(), path)
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(documents).isEmpty() and back.count() == documents.count()
    assert all(r.shard == descend(r.doc_id, shards.tree()) for r in back.collect())
    with pytest.raises(ValueError):
        shards.write_shards(back, shards.tree(), path)
