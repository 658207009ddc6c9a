"""Near-duplicates by SetSketch registers (operator 10).

A document's set is its distinct word shingles. Register ``i`` of its sketch is ``1 - log_b`` of the least of the set's
values ``h_i`` (exponential with rate ``a``), cut to 16 bits: exponentially spaced, truncated minima. The sketch of a
union is the maximum per register, so sketches merge, and with a base near 1 two registers agree about as often as the sets
overlap. Bands of registers bring candidates together; their similarity is estimated by maximum likelihood from the
numbers of larger, smaller and equal registers together with the exact set sizes; what may reach the threshold is confirmed on
the full sets. A pair at the threshold 0.8 shares no band of 32 with probability 5e-8 and is estimated
below the floor with 1e-5.

Documents with equal sets are one class from the start, so copies cost nothing further on. A bucket's classes are never
paired with each other at large: first each is compared with the bucket's least class. Buckets that then still hold
several components are searched inside tasks, in blocks of bounded size: what is outside the largest component is
compared with it and with each other, and confirmed in place. Pairs already known to be in one component are left
out, which loses no component.

Edge cases: null, empty and blank texts have an empty set, are linked with nothing and are kept. A null id is linked with
nothing and has a null component. Repeated ids are separate documents with one id. Other columns are ignored by :func:`near_duplicates`
and kept by :func:`keep_first`. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm import bitmap
from tenura.llm.arrow import keep_rows, map_batches, task, text_column, unused
from tenura.llm.components import components
from tenura.llm.words import Chunk, chunks, mix
from tenura.session import materialize

REGISTERS = 128
BAND = 4
BASE = 1.001
RATE = 20.0
THRESHOLD = 80  # percent
FLOOR = 0.65
BLOCK = 500_000  # shingles

_rng = np.random.default_rng(411)
_ODD = _rng.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_ALONE = np.uint64(0xA24BAED4963EE407)


def shingle_sets(chunk: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts of a chunk, text after text in ascending order, and where each text's end."""
    words, counts = chunk.word_hashes(), chunk.word_counts()
    n_docs = len(counts)
    rolled = np.zeros(len(words), dtype=np.uint64)
    for i in range(size):
        rolled[: len(words) - i] += words[i:] * _PLACE[i]
    owner = chunk.owner()
    room = np.repeat(chunk.word_edges[1:], counts) - np.arange(len(words)) >= size
    short = (counts > 0) & (counts < size)
    keys, owners = mix(rolled[room]), owner[room]
    if short.any():  # the whole sequence is the only shingle
        at = np.flatnonzero(short[owner])
        place = at - chunk.word_edges[owner[at]]
        whole = np.zeros(n_docs, dtype=np.uint64)
        np.add.at(whole, owner[at], words[at] * _PLACE[place + size])
        keys = np.concatenate((keys, mix(whole[short] ^ _ALONE)))
        owners = np.concatenate((owners, np.flatnonzero(short)))
    order = np.lexsort((keys, owners)) if len(keys) < 2 else _by_owner(keys, owners, n_docs)
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners = keys[new], owners[new]
    return keys, np.searchsorted(owners, np.arange(n_docs + 1))


def _by_owner(keys: np.ndarray, owners: np.ndarray, n_docs: int) -> np.ndarray:
    """Order by owner, then key: sorted by key once, then dealt to the owners in that order."""
    order = np.argsort(keys)
    return order[np.argsort(owners[order].astype(np.uint16 if n_docs < 1 << 16 else np.int64), kind="stable")]


def sketches(keys: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Registers of each set; zeros for an empty one."""
    sizes = np.diff(edges)
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), REGISTERS), dtype=np.uint16)
    if not len(full):
        return out
    low, starts = (keys >> np.uint64(32)).astype(np.uint32), edges[:-1][full]
    least = np.empty((len(full), REGISTERS), dtype=np.uint32)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(low * _ODD[i] + _ADD[i], starts)
    value = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 1, 65535).astype(np.uint16)
    return out


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(one, other)


def bands(registers: np.ndarray) -> np.ndarray:
    """Bucket numbers of each sketch, one per band."""
    held = registers.reshape(len(registers), REGISTERS // BAND, BAND).astype(np.uint64)
    packed = held[..., 0] | held[..., 1] << np.uint64(16) | held[..., 2] << np.uint64(32) | held[..., 3] << np.uint64(48)
    return mix(packed ^ mix(np.arange(1, REGISTERS // BAND + 1, dtype=np.uint64))[None, :])


def likely_similarity(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from the numbers of registers above and below, given both set sizes."""
    total = n_a + n_b
    u, v = n_a / total, n_b / total
    level = REGISTERS - above - below

    def share(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def score(j):
        up, down = share(u - v * j), share(v - u * j)
        return above * np.log(up) + below * np.log(down) + level * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(25):  # the likelihood has one top
        left, right = low + (high - low) / 3, high - (high - low) / 3
        worse = score(left) < score(right)
        low, high = np.where(worse, left, low), np.where(worse, high, right)
    return (low + high) / 2


def _registers(column: pa.Array) -> np.ndarray:
    held = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16)
    return held.reshape(len(column), REGISTERS)


def _sketched(df: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Id, set size, 128-bit key of the set and registers of every row."""
    source = df.select(df[id_col].alias("_id"), df[text_col].cast("string").alias("_text"))
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch):
        sizes, one, two, registers = [], [], [], []
        for chunk in chunks(text_column(batch, "_text")):
            keys, edges = shingle_sets(chunk, size)
            sizes.append(np.diff(edges))
            before = np.concatenate(([np.uint64(0)], np.cumsum(keys, dtype=np.uint64)))
            one.append(before[edges[1:]] - before[edges[:-1]])
            before = np.concatenate(([np.uint64(0)], np.cumsum(mix(keys ^ _ALONE), dtype=np.uint64)))
            two.append(before[edges[1:]] - before[edges[:-1]])
            registers += [r.tobytes() for r in sketches(keys, edges)]
        joined = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (sizes, one, two)]
        return {
            id_col: text_column(batch, "_id"), "n_shingles": joined[0].astype(np.int64),
            "_k1": joined[1].astype(np.uint64).view(np.int64), "_k2": joined[2].astype(np.uint64).view(np.int64),
            "_registers": registers,
        }

    return map_batches(source, run, f"{id_col} {kind}, n_shingles long, _k1 long, _k2 long, _registers binary")


def _full_sets(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``node`` and sorted ``set`` of the classes in ``wanted`` (node, first, _k1, _k2), from their first documents."""
    seen = bitmap.build(wanted.select(F.xxhash64("_first").alias("k")), "k")
    held = df.sparkSession.sparkContext.broadcast(seen)
    source = df.select(
        df[id_col].alias("_id"), F.xxhash64(df[id_col]).alias("_h"), df[text_col].cast("string").alias("_text")
    )
    kind = df.schema[id_col].dataType.simpleString()

    def run(batch):
        passes = bitmap.holds(held.value, text_column(batch, "_h").to_numpy())
        batch = batch.filter(pa.array(passes))
        one, two, sets = [], [], []
        for chunk in chunks(text_column(batch, "_text")):
            keys, edges = shingle_sets(chunk, size)
            for i in range(len(edges) - 1):
                own = keys[edges[i] : edges[i + 1]]
                one.append(int(own.sum(dtype=np.uint64).view(np.int64)))
                two.append(int(mix(own ^ _ALONE).sum(dtype=np.uint64).view(np.int64)))
                sets.append(own.tobytes())
        return {"_id": text_column(batch, "_id"), "_k1": one, "_k2": two, "set": sets}

    found = map_batches(source, run, f"_id {kind}, _k1 long, _k2 long, set binary")
    same = (found["_id"] == wanted["_first"]) & (found["_k1"] == wanted["_k1"]) & (found["_k2"] == wanted["_k2"])
    return found.join(wanted, same).select("node", "set").dropDuplicates(["node"])


def _screened(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose likely similarity reaches the floor."""
    side = classes.select("node", "n_shingles", "_registers")
    met = pairs.join(side.toDF("a", "n_a", "r_a"), "a").join(side.toDF("b", "n_b", "r_b"), "b")

    def run(batch):
        n_a, n_b = (text_column(batch, c).to_numpy() for c in ("n_a", "n_b"))
        r_a, r_b = _registers(text_column(batch, "r_a")), _registers(text_column(batch, "r_b"))
        likely = likely_similarity((r_a > r_b).sum(axis=1), (r_a < r_b).sum(axis=1), n_a, n_b)
        kept = pa.array(likely >= FLOOR)
        return {c: text_column(batch, c).filter(kept) for c in "ab"}

    return map_batches(met, run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    met = pairs.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b")

    def run(batch):
        kept = []
        for one, two in zip(text_column(batch, "s_a"), text_column(batch, "s_b")):
            x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (one, two))
            both = len(np.intersect1d(x, y, assume_unique=True))
            kept.append(100 * both >= percent * (len(x) + len(y) - both))
        kept = pa.array(kept, type=pa.bool_())
        return {c: text_column(batch, c).filter(kept) for c in "ab"}

    return map_batches(met, run, "a long, b long")


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``nodes`` with ``comp``, the least node reachable over ``links``."""
    member = components(links).withColumnsRenamed({"node": "_n", "component": "_c"})
    return nodes.join(member, F.col("node") == F.col("_n"), "left").select(
        *nodes.columns, F.coalesce("_c", "node").alias("comp")
    )


def _open(hits: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (bucket, node, comp) of the buckets that hold more than one component."""
    rows = materialize(_labelled(hits, links), "labelled")
    mixed = rows.groupBy("bucket").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi")
    return rows.join(mixed.select("bucket"), "bucket", "left_semi")


def _rest(rows: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a bucket, found block by block inside tasks.

    The largest component of a bucket is only compared with the others, so pairs inside it are never looked at. A task
    holds two blocks of about ``BLOCK`` shingles each, confirms likely pairs on the full sets, and emits no more links
    than it takes to join what belongs together. Buckets with the same members are compared once.
    """
    per_bucket = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.xxhash64("node") % (1 << 40)).alias("_s"), F.bit_xor(F.xxhash64("node")).alias("_x")
    )
    once = per_bucket.groupBy("_n", "_s", "_x").agg(F.min("bucket").alias("bucket")).select("bucket")
    rows = rows.join(once, "bucket", "left_semi").join(classes.select("node", "n_shingles"), "node")
    per = rows.groupBy("bucket", "comp").agg(F.sum("n_shingles").alias("_n"))
    whole = per.groupBy("bucket").agg(F.max(F.struct("_n", "comp")).alias("_m"), F.sum("_n").alias("_all"))
    blocks = whole.select(
        "bucket",
        F.col("_m.comp").alias("_main"),
        F.ceil(F.col("_m._n") / BLOCK).alias("_mains"),
        F.greatest(F.lit(1), F.ceil((F.col("_all") - F.col("_m._n")) / BLOCK)).alias("_others"),
    )
    placed = rows.join(blocks, "bucket").withColumn("_is_main", F.col("comp") == F.col("_main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("_is_main"), F.col("_mains")).otherwise(F.col("_others")))
    placed = placed.withColumn("_own", own)
    other = F.sequence(F.lit(0), F.col("_others") - 1)
    main_cells = F.transform(other, lambda j: F.array(F.lit(0), F.col("_own"), j))
    across = F.transform(
        F.sequence(F.lit(0), F.col("_mains") - 1), lambda i: F.array(F.lit(0), i, F.col("_own"))
    )
    among = F.transform(other, lambda k: F.array(F.lit(1), F.least(k, F.col("_own")), F.greatest(k, F.col("_own"))))
    cells = F.when(F.col("_is_main"), main_cells).otherwise(F.concat(across, among))
    dealt = placed.select("bucket", "node", "comp", "_is_main", F.explode(cells).alias("_cell"))
    dealt = dealt.join(classes.select("node", "_registers"), "node").join(sets, "node")
    key = ["bucket", "_kind", "_i", "_j"]
    flat = dealt.select(
        "bucket", *[F.col("_cell")[i].alias(name) for i, name in enumerate(key[1:])],
        "node", "comp", "_is_main", "_registers", "set",
    )
    flat = flat.repartition(F.xxhash64(*key)).sortWithinPartitions(*key)

    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for group in _runs(batches, key):
            links = _links(group, percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(side) for side in zip(*links)], schema=schema)

    return flat.mapInArrow(task(run), "a long, b long").distinct()


def _runs(batches, key: list[str]):
    """Tables of consecutive rows with equal keys."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([text_column(batch, c).to_numpy() for c in key], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for first, last in zip([0, *cuts], [*cuts, len(keys)]):
            now = tuple(keys[first])
            if held and now != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held, held_key = [*held, batch.slice(first, last - first)], now
    if held:
        yield pa.Table.from_batches(held)


def _shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Number of elements of each other set in a sorted set."""
    values = np.concatenate(others)
    at = np.searchsorted(one, values)
    at[at == len(one)] = 0
    starts = np.concatenate(([0], np.cumsum([len(o) for o in others])))[:-1]
    return np.add.reduceat((one[at] == values).astype(np.int64), starts)


def _links(group: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Confirmed links between different components of a cell; each joins two that were apart."""
    node, main = group["node"].to_numpy(), group["_is_main"].to_numpy(zero_copy_only=False)
    label = np.unique(group["comp"].to_numpy(), return_inverse=True)[1]
    registers = _registers(group["_registers"].combine_chunks())
    sets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in group["set"]]
    size = np.array([len(s) for s in sets])
    across = group["_kind"][0].as_py() == 0
    found = []
    for i in np.flatnonzero(~main) if across else range(len(node)):
        able = (label != label[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
        able[: i + 1] &= across
        if across:
            able &= main
        at = np.flatnonzero(able)
        same = (registers[at] == registers[i]).sum(axis=1)
        # An estimate from the equal registers alone is near enough to leave out what cannot reach the floor.
        likely = same >= int((FLOOR - 0.03) * REGISTERS)
        at, same = at[likely], same[likely]
        if not len(at):
            continue
        up, down = (registers[i] > registers[at]).sum(axis=1), (registers[i] < registers[at]).sum(axis=1)
        at = at[likely_similarity(up, down, np.full(len(at), size[i]), size[at]) >= FLOOR]
        if not len(at):
            continue
        both = _shared(sets[i], [sets[k] for k in at])
        for k in at[100 * both >= percent * (size[i] + size[at] - both)]:
            if label[k] != label[i]:
                found.append((min(node[i], node[k]), max(node[i], node[k])))
                label[label == label[k]] = label[i]
    return found


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = THRESHOLD
) -> DataFrame:
    """Id, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Rows whose sets of ``size``-word shingles have a similarity of ``percent`` / 100 or more are linked. ``component_id``
    is the least id reachable; the row with that id is kept.
    """
    rows = materialize(_sketched(df, id_col, text_col, size), "sketches")
    able = rows.where((F.col("n_shingles") > 0) & F.col(id_col).isNotNull())
    classes = able.groupBy("_k1", "_k2", "n_shingles").agg(
        F.min(id_col).alias("_first"), F.first("_registers").alias("_registers")
    )
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    def cut(batch):
        buckets = bands(_registers(text_column(batch, "_registers"))).view(np.int64)
        return {"bucket": buckets.ravel(), "node": np.repeat(text_column(batch, "node").to_numpy(), buckets.shape[1])}

    banded = map_batches(classes.select("node", "_registers"), cut, "bucket long, node long")
    shared = banded.groupBy("bucket").agg(F.min("node").alias("_lo"), F.max("node").alias("_hi")).where("_lo <> _hi")
    hits = materialize(banded.join(shared.select("bucket", "_lo"), "bucket"), "hits")

    pairs = hits.where(F.col("node") != F.col("_lo")).select(F.col("_lo").alias("a"), F.col("node").alias("b")).distinct()
    likely = materialize(_screened(pairs, classes), "pairs")
    in_buckets = hits.select("node").distinct()
    wanted = classes.join(in_buckets, "node", "left_semi").select("node", "_first", "_k1", "_k2")
    sets = materialize(_full_sets(df, wanted, id_col, text_col, size), "sets")
    links = materialize(_confirmed(likely, sets, percent), "links")

    still = materialize(_open(hits.select("bucket", "node"), links), "open")
    links = links.unionByName(materialize(_rest(still, classes, sets, percent), "links"))

    named = _labelled(classes.select("node", "_k1", "_k2", "n_shingles", "_first"), links)
    named = materialize(named, "named")
    ids = named.groupBy("comp").agg(F.min("_first").alias("component_id"))
    final = named.join(ids, "comp").select(
        F.col("_k1").alias("_c1"), F.col("_k2").alias("_c2"), F.col("n_shingles").alias("_cn"), "component_id"
    )
    same = (F.col("_k1") == F.col("_c1")) & (F.col("_k2") == F.col("_c2")) & (F.col("n_shingles") == F.col("_cn"))
    known = F.when(F.col(id_col).isNotNull(), F.coalesce("component_id", id_col))
    return rows.drop("_registers").join(final, same, "left").select(
        id_col, "n_shingles", known.alias("component_id"), F.coalesce(known == F.col(id_col), F.lit(True)).alias("kept")
    )


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns.

    A bitmap of the dropped ids tells rows that are surely kept, so that few texts move to the exact join.
    """
    found = near_duplicates(df, id_col, text_col, size, percent)
    bit, gone = unused(df, "_sketch_bit"), unused(df, "_dropped")
    dropped = materialize(found.where(~F.col("kept")).select(F.col(id_col).alias(gone)).distinct(), "dropped")
    seen = bitmap.build(dropped.select(F.xxhash64(gone).alias("k")), "k")
    held = df.sparkSession.sparkContext.broadcast(seen)
    marked = df.withColumn(bit, F.xxhash64(id_col))
    sure = keep_rows(marked, lambda column: ~bitmap.holds(held.value, column.to_numpy()), bit)
    others = keep_rows(marked, lambda column: bitmap.holds(held.value, column.to_numpy()), bit)
    others = others.join(dropped, F.col(id_col) == F.col(gone), "left_anti")
    return sure.unionByName(others).drop(bit)
