from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from checks.world import World
from tenura.functions.asof import as_of
from tenura.operators import membership, merge
from tests.conftest import SF_SMALL, day, rows_of
from tests.test_plans import plan, shuffled  # noqa: F401

SEQ = (
    "user_id long, transaction_date date, membership_expire_date date, sequence_id long, sequence_group_id long, is_cancel long"
)


def before(asked, rows, strict=False):
    """For each (key, time, mark): the carried value of the last row."""
    out = []
    for k, t, mark in asked:
        met = [(u, (o is not None, o or 0), v) for key, u, o, v in rows if k is not None and key == k and u is not None and t is not None]
        met = [r for r in met if (r[0] < t if strict else r[0] <= t)]
        out.append((k, t, mark, max(met, key=lambda r: r[:2])[2] if met else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("hot_rows", [None, 5])
def test_as_of_against_brute_force(spark, strict, hot_rows):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([*range(30), None]), o, f"v{i}") for i, o in enumerate([None, *range(150)])]
    asked = [(rng.choice([1, 2, 4, None]), rng.choice([*range(-2, 33), None]), i % 40) for i in range(120)]
    got = as_of(
        spark.createDataFrame(asked, "k long, t int, mark int"), spark.createDataFrame(rows, "k long, t int, o int, v string"), "k", "t",
        {"v": "found"}, order=("o",), strict=strict, hot_rows=hot_rows,
    )
    assert got.columns == ["k", "t", "mark", "found"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == before(asked, rows, strict)


def test_as_of_replaces_columns_and_meets_nothing(spark):
    asked = spark.createDataFrame([(1, 5, "old"), (1, 5, "old")], "k long, t int, found string")
    rows = spark.createDataFrame([(1, 4, None), (1, 3, "x")], "k long, t int, found string")
    # The last row carries its NULL.
    assert rows_of(as_of(asked, rows, ["k"], "t", {"found": "found"}), "k", "t", "found") == [(1, 5, None)] * 2
    assert rows_of(as_of(asked, rows.limit(0), ["k"], "t", {"found": "found"}), "k", "t", "found") == [(1, 5, None)] * 2
    assert as_of(asked.limit(0), rows, "k", "t", {"found": "found"}).count() == 0


def reference_place(last_expires, payments):
    """The payment that set the expiry, by the definition."""
    hits = [p for p in payments if p[1] in last_expires]
    if not hits:
        return None, None
    hit = max(hits, key=lambda p: (p[0], p[2], p[3], p[4]))
    back = [p for p in payments if p[4] == 0 and p[0] <= hit[0]]
    if hit[4] == 1 and back:
        hit = max(back, key=lambda p: (p[0], p[2], p[3]))
    return hit[3], hit[2]


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_membership_place_against_its_definition(spark, hot_rows):
    rng = random.Random(8)
    payments = {
        u: [(rng.randint(1, 6), rng.randint(5, 9), i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(rng.randint(0, 9))]
        for u in range(120)
    }
    seq = spark.createDataFrame([(u, day(t), day(e), s, g, c) for u, held in payments.items() for t, e, s, g, c in held], SEQ)
    members = [(u, rng.choice([None, 5, 6, 7, 8, 9])) for u in range(125)] + [(7, 5), (7, 9)]
    given = spark.createDataFrame([(u, None if e is None else day(e)) for u, e in members], "user_id long, last_expire date")
    asked = {u: {e for v, e in members if v == u and e is not None} for u, _ in members}
    got = membership.membership_seq_info(given, seq, hot_rows=hot_rows)
    wanted = [(u, None if e is None else day(e), *reference_place(asked[u], payments.get(u, []))) for u, e in members]
    assert rows_of(got, *got.columns) == sorted(wanted, key=repr)


def test_plans_sort_no_aggregates(spark, shuffled, tmp_path):  # noqa: F811
    world = World(spark, SF_SMALL)
    world.seq.write.parquet(str(tmp_path / "seq"))
    world.members_last.write.parquet(str(tmp_path / "members"))
    seq, members = (spark.read.parquet(str(tmp_path / n)) for n in ("seq", "members"))
    text = plan(membership.membership_seq_info(members, seq))
    assert text.count("Exchange ") <= 3 and "SortAggregate" not in text
    assert sum("sequence_id" in line for line in text.splitlines() if "FileScan" in line) == 1
    text = plan(membership.last_txn_in_window(members, seq))
    assert "SortAggregate" not in text and text.count("Exchange ") == 3
    wide = members.select("user_id", "last_expire", F.col("city").cast("int").alias("city"), (F.col("bd") > 50).alias("old"))
    text = plan(merge.merge_prefer_latest(wide, wide, "user_id"))
    assert "SortAggregate" not in text and "Sort [" not in text


def test_packed_merge_equals_the_struct(spark):
    rng = random.Random(2)

    def rows(n):
        return [(rng.randint(0, 30), rng.choice([None, -5, 0, 7]), rng.choice([None, day(3), day(9)]), rng.choice([None, True, False])) for _ in range(n)]

    v1, v2 = (spark.createDataFrame(rows(60), "msno long, a long, d date, f boolean") for _ in range(2))
    best = {}
    for p, df in enumerate((v2, v1)):
        for r in df.collect():
            rank = (p, *[(x is not None, x if x is not None else 0) for x in r[1:]])
            if r.msno not in best or rank < best[r.msno][0]:
                best[r.msno] = (rank, tuple(r))
    got = merge.merge_prefer_latest(v1, v2)
    assert rows_of(got, *got.columns) == sorted((t for _, t in best.values()), key=repr)
