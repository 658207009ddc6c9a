"""Sharding by a hierarchical tree of weighted hash draws (operator 13).

Shards hang in racks and racks in regions. A row goes down from the root: at each level every child draws a number from a
hash of its own name and the row's key, exponentially distributed with the child's weight as its rate, and the least draw
wins, so that a child is chosen with its share of the weight and independently of what its siblings are called. Changing a
child's weight changes its own draws only: rows move into a subtree that grows and out of one that shrinks, and never between others.

A shard that is added later keeps this promise down to the shard itself. Were its weight simply put on its rack and region,
the rows they win would be dealt to all shards below. So a node draws once for what it was built of and once more for each
later addition below it; its draw is the least of these, and where an addition has won, the row follows it down to
the new shard. One more shard takes rows from all others by its share of the weight, and no other row moves. This is the law ``key``:
the key and the tree alone decide, equal keys share a shard, and the number of rows or bytes is even only as far as keys are many.

Draws are column functions over literal arrays of the tree, whose size is the number of shards. Only ids, sizes and shards
are moved for the numbering: they are sorted over the cluster by shard and id, copies spread by input position, and row
counts of each partition and shard turn places into slots. No task holds a shard, however large it is.

Edge cases: a null key is drawn for as the key ''; rows with one key, however many, share a shard, as the law demands, and are
numbered by many tasks. A null text has no bytes. Repeated rows get a slot each. Weights of zero take no rows. Other columns are
ignored, or kept by :func:`write_shards`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.placement import placed
from tenura.session import materialize

SHARDS = 16
REGIONS, RACKS = 2, 2
_BITS = 53


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree: its number, where it hangs, its weight, and whether it came after the tree was built."""

    number: int
    region: str
    rack: str
    weight: float = 1.0
    added: bool = False


def tree(shards: int = SHARDS, built: int = SHARDS, regions: int = REGIONS, racks: int = RACKS) -> list[Shard]:
    """A tree of ``shards`` equal shards: the first ``built`` by regions and racks, the others added later, rack by rack."""
    if shards < built:
        raise ValueError(f"a tree built of {built} shards can not have {shards}")
    homes = [(f"region{i // racks}", f"rack{i % racks}") for i in range(regions * racks)]
    at = [i * len(homes) // built if i < built else (i - built) % len(homes) for i in range(shards)]
    return [Shard(i, *homes[home], added=i >= built) for i, home in enumerate(at)]


def _draw(name: Column, weight: Column, key: Column) -> Column:
    """A number from an exponential distribution with rate ``weight``; null for a weight of zero."""
    top = F.shiftrightunsigned(F.xxhash64(F.concat_ws("/", name, key)), 64 - _BITS)
    share = (top.cast("double") + 0.5) / F.lit(float(1 << _BITS))
    return F.when(weight > 0, -F.log(share) / weight)


def _least(children: Column, key: Column) -> Column:
    """Of structs with ``name`` and ``weight``, the one that draws the least."""
    drawn = F.transform(children, lambda c: F.struct(_draw(c["name"], c["weight"], key).alias("draw"), c.alias("child")))
    return F.array_min(F.filter(drawn, lambda d: d["draw"].isNotNull()))["child"]


def shard_of(key: Column, shards: Sequence[Shard]) -> Column:
    """Number of the shard that a key belongs to."""
    if not any(s.weight > 0 for s in shards) or any(s.weight < 0 for s in shards):
        raise ValueError("weights must not be negative and need a positive one")
    if len({s.number for s in shards}) < len(shards):
        raise ValueError("two shards have one number")
    key = F.coalesce(key.cast("string"), F.lit(""))
    built: dict[str, dict[str, list[Shard]]] = {}
    for s in sorted(shards, key=lambda s: s.number):
        if not s.added:
            built.setdefault(s.region, {}).setdefault(s.rack, []).append(s)

    def named(name: str, weight: float, more: Column, what: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"), more.alias(what))

    def leaf(s: Shard, name: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(float(s.weight)).alias("weight"), F.lit(s.number).alias("shard"))

    subtrees = []
    for region, racks in built.items():
        held = []
        for rack, own in racks.items():
            leaves = F.array(*[leaf(s, f"{region}/{rack}/{s.number}") for s in own])
            held.append(named(f"{region}/{rack}", sum(s.weight for s in own), leaves, "below"))
        weight = sum(s.weight for own in racks.values() for s in own)
        subtrees.append(named(region, weight, F.array(*held), "below"))
    # What an addition wins at the root it wins at every level below, so it is drawn for here once and for all.
    late = [leaf(s, f"{s.region}/{s.rack}/+{s.number}") for s in shards if s.added and s.weight > 0]
    top = F.array(*subtrees) if sum(s.weight for s in shards if not s.added) > 0 else None
    if top is None:
        return _least(F.array(*late), key)["shard"]
    rack = _least(_least(top, key)["below"], key)["below"]
    inner = _least(rack, key)["shard"]
    if not late:
        return inner
    base = F.array_min(F.transform(top, lambda c: _draw(c["name"], c["weight"], key)))
    first = F.array_min(
        F.transform(F.array(*late), lambda c: F.struct(_draw(c["name"], c["weight"], key).alias("draw"), c["shard"].alias("shard")))
    )
    return F.when(first["draw"] < base, first["shard"]).otherwise(inner)


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with their ``slot``: the place in their shard by ``order``, gapless from 0."""
    stored = materialize(rows, "shard-rows").withColumn("_copy", F.monotonically_increasing_id())
    places = placed(stored, ["shard", *order, "_copy"], "shard-places")
    # At most one row per partition and shard that meets it.
    runs = places.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_nth").alias("_first"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_offset")
    met = places.join(runs.select("shard", "_part", offset), ["shard", "_part"])
    return met.select(*rows.columns, (F.col("_nth") + F.col("_offset")).alias("slot"))


def place_documents(
    df: DataFrame, shards: Sequence[Shard], grown: Sequence[Shard] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, ``size`` (UTF-8 bytes and one), ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every row.

    ``grown_shard`` is the shard in the tree ``grown``, null without one.
    """
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    rows = df.select(
        df[id_col].alias(id_col), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(df[id_col], shards).cast("int").alias("shard"),
        (shard_of(df[id_col], grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
    )
    numbered = _numbered(rows, [id_col, "text_crc32", "size"])
    return numbered.select(id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, shards: Sequence[Shard], path: str, id_col: str = "doc_id", name: str = "shard") -> None:
    """Write all columns of the rows into one folder per shard, ``path/name=<number>``.

    Rows are gathered by shard in parts of the size that adaptive execution asks for, so a shard may be written by many tasks.
    """
    if name in df.columns:
        raise ValueError(f"the table has a column {name} already: choose another name for the folders")
    dealt = df.withColumn(name, shard_of(df[id_col], shards).cast("int")).hint("rebalance", name)
    dealt.write.partitionBy(name).parquet(path)
