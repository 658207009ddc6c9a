"""Hard negatives by a vertical scan of vector dimensions (operator 11).

Every anchor has positives, its best other rows of the same label, and for each of them a window of scores, a share of the
positive's own; its hard negatives are the best rows of other labels inside the window. Scores are integer inner products.

Rows are stored in blocks, column by column, with the least and the largest value of each dimension. A block is scanned for
an anchor a few dimensions at a time, in the order of the anchor's descending magnitude. What the dimensions not yet read can still
add lies between two sums of the block's extremes; rows whose score can no longer reach the best ones, or any open
window, leave the candidate bitmap, and a block whose bitmap is empty is read no further. When all dimensions are read, the
rest of the scores are exact. The best found so far for an anchor stay with it from block to block and raise the bound.

There are two scans, one for positives and one for negatives. In both, blocks of anchors meet blocks of rows in cells
(anchor block, slice of row blocks): a task reads the anchors of a cell, then streams the row blocks past them and returns
only the best of each anchor, which a window over those few rows makes final. All rows are compared with all anchors, as the
task asks; a task holds one block of each and the best lists, whatever the size of the table or of a label. Rows are dealt to blocks by
label, so most blocks are skipped or read for one label only, and by input position, so copies spread.

Edge cases: rows with a null id or label, a null or empty vector, or a null or non-finite component take no part, nor do
vectors with a component beyond ``LIMIT`` in magnitude or with more than ``LONGEST`` components, for which sums could leave the range
of a long. Vectors are compared with those of their
own length only. Every row with an anchor's id is an anchor of its own; rows with the same id as an anchor are neither its
positives nor its negatives. Repeated rows are each a candidate. Fewer rows than asked for are all returned, and an anchor
without a positive, or a window without a row, gives no row. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, StructType

from tenura.llm.arrow import slices, task, text_column
from tenura.session import materialize

POSITIVES, NEGATIVES = 5, 3
# The window of a positive, in hundredths of its score.
LOW, HIGH = 50, 95
SCALE = 256
LIMIT, LONGEST = 65_536.0, 32_767
BLOCK_ROWS, BLOCK_BYTES = 8_192, 4 << 20
ANCHOR_ROWS = 2_048
STEP = 8  # dimensions read between two looks at the bounds
CELL_BLOCKS = 16
CELLS_PER_CORE = 4

_LAYOUT = (
    StructType().add("label", BinaryType()).add("ids", BinaryType()).add("width", IntegerType()).add("cells", BinaryType())
)
_EXACT = float(1 << 53)


@dataclass
class Block:
    """Rows of equally long vectors: ``cells`` has a line for each dimension, as integers and as doubles."""

    ids: np.ndarray
    labels: np.ndarray
    cells: np.ndarray
    floats: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray) -> Block:
        least, most = cells.min(axis=1).astype(np.int64), cells.max(axis=1).astype(np.int64)
        return cls(ids, labels, cells, cells.astype(np.float64), least, most)


def scan(block: Block, vector: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of ``rows`` that ``keep`` leaves after all dimensions, and their scores.

    ``keep(partial, low, high)`` gets the sums so far and what the unread dimensions add at least and at most.
    """
    order = np.argsort(-np.abs(vector), kind="stable")
    ends = np.stack([vector * block.least, vector * block.most])[:, order]
    low = np.concatenate((np.cumsum(ends.min(axis=0)[::-1])[::-1], [0]))
    high = np.concatenate((np.cumsum(ends.max(axis=0)[::-1])[::-1], [0]))
    cells = block.cells
    if np.abs(ends.astype(np.float64)).max(axis=0).sum() < _EXACT:  # doubles are exact, and faster
        cells, vector, low, high = block.floats, vector.astype(np.float64), low.astype(np.float64), high.astype(np.float64)
    alive = np.zeros(cells.shape[1], dtype=bool)
    alive[rows] = True
    partial = np.zeros(len(rows), dtype=vector.dtype)
    for begin in range(0, len(order), STEP):
        read = order[begin : begin + STEP]
        part = cells[read] if len(rows) == cells.shape[1] else cells[np.ix_(read, rows)]
        partial += vector[read] @ part
        end = begin + len(read)
        stay = keep(partial, low[end], high[end])
        if not stay.all():
            alive[rows[~stay]] = False
            rows, partial = np.flatnonzero(alive), partial[stay]
            if not len(rows):
                break
    return rows, partial.astype(np.int64)


def _nth_largest(values: np.ndarray, n: int):
    """The ``n``-th largest value, or None if there are fewer."""
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else None


class Best:
    """The best ``size`` (score, id) met so far: higher scores first, ties by smaller id."""

    def __init__(self, size: int):
        self.size = size
        self.scores, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    @property
    def bound(self):
        """The score that a further row has to reach, if the list is full."""
        return self.scores[-1] if len(self.scores) == self.size else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
            order = np.lexsort((ids, -scores))[: self.size]
            self.scores, self.ids = scores[order], ids[order]


def best_of(block: Block, vector: np.ndarray, rows: np.ndarray, best: Best) -> None:
    """Bring ``best`` up to date with the best of ``rows``."""

    def keep(partial, low, high):
        bound, sure = best.bound, _nth_largest(partial, best.size)
        need = [b for b in (bound, None if sure is None else sure + low) if b is not None]
        return partial + high >= max(need) if need else np.ones(len(partial), dtype=bool)

    rows, scores = scan(block, vector, rows, keep)
    best.add(scores, block.ids[rows])


def best_in_windows(block: Block, vector: np.ndarray, rows: np.ndarray, windows: list[tuple[int, int, Best]]) -> None:
    """Bring the list of each window (lowest score, highest score, list) up to date with the rows inside it."""

    def keep(partial, low, high):
        wanted = np.zeros(len(partial), dtype=bool)
        for first, last, best in windows:
            sure = _nth_largest(partial[(partial + low >= first) & (partial + high <= last)], best.size)
            need = max(b for b in (first, best.bound, None if sure is None else sure + low) if b is not None)
            wanted |= (partial + high >= need) & (partial + low <= last)
        return wanted

    rows, scores = scan(block, vector, rows, keep)
    for first, last, best in windows:
        inside = (scores >= first) & (scores <= last)
        best.add(scores[inside], block.ids[rows[inside]])


def _rows(df: DataFrame, vector_col: str, id_col: str, label: Column) -> DataFrame:
    """The rows that take part: ``_id``, ``_label`` and ``_vector``."""
    rows = df.select(
        df[id_col].cast("long").alias("_id"), label.cast("long").alias("_label"),
        F.transform(df[vector_col], lambda x: x.cast("double")).alias("_vector"),
    )
    # NaN is larger than any number, null fails as well.
    fits = F.forall("_vector", lambda x: F.coalesce(F.abs(x) <= LIMIT, F.lit(False)))
    sized = F.size("_vector").between(1, LONGEST)
    return rows.where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & sized & fits)


def _blocks(rows: DataFrame, most_rows: int, label: str) -> DataFrame:
    """Rows in stored blocks of at most ``most_rows`` and about ``BLOCK_BYTES``, with their number ``block``."""
    schema = to_arrow_schema(_LAYOUT)

    def close(parts) -> list[pa.RecordBatch]:
        most = _room(parts[0][2].shape[1], most_rows)
        ids, labels = (np.concatenate([p[i] for p in parts]) for i in range(2))
        cells = np.concatenate([p[2] for p in parts])
        order = np.argsort(labels, kind="stable")
        cut = [order[i : i + most] for i in range(0, len(order), most)]
        return [_packed(ids[at], labels[at], cells[at].T, schema) for at in cut]

    def run(batches):
        held: dict[int, list] = {}
        size: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch):
                vectors = text_column(part, "_vector")
                widths = np.diff(vectors.offsets.to_numpy())
                flat = np.floor(SCALE * vectors.flatten().to_numpy()).astype(np.int32)
                ids, labels = text_column(part, "_id").to_numpy(), text_column(part, "_label").to_numpy()
                for width in np.unique(widths).tolist():
                    own = np.repeat(widths == width, widths)
                    at = widths == width
                    held.setdefault(width, []).append((ids[at], labels[at], flat[own].reshape(-1, width)))
                    size[width] = size.get(width, 0) + int(at.sum())
                    if size[width] >= _room(width, most_rows):
                        yield from close(held.pop(width))
                        del size[width]
                # Many lengths at once: close the fullest, so that what is held stays bounded.
                while sum(n * 4 * width for width, n in size.items()) > 2 * BLOCK_BYTES:
                    width = max(size, key=lambda w: w * size[w])
                    yield from close(held.pop(width))
                    del size[width]
        for width in list(held):
            yield from close(held.pop(width))

    return materialize(rows.mapInArrow(task(run), _LAYOUT).withColumn("block", F.monotonically_increasing_id()), label)


def _room(width: int, most_rows: int) -> int:
    """Rows of a full block."""
    return max(1, min(most_rows, BLOCK_BYTES // (4 * width)))


def _packed(ids: np.ndarray, labels: np.ndarray, cells: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    row = [labels.tobytes(), ids.tobytes(), len(cells), np.ascontiguousarray(cells, dtype=np.int32).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and cells of a stored block."""
    ids, labels = (np.frombuffer(row[c].as_buffer(), dtype=np.int64) for c in ("ids", "label"))
    cells = np.frombuffer(row["cells"].as_buffer(), dtype=np.int32).reshape(row["width"].as_py(), -1)
    return ids, labels, cells


def _cells(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Anchor blocks and row blocks by cell, the anchors of a cell first."""
    spark = blocks.sparkSession
    cores = spark.sparkContext.defaultParallelism
    rows, n = max(1, anchors.count()), max(1, blocks.count())
    columns = min(n, max(-(-n // CELL_BLOCKS), -(-CELLS_PER_CORE * cores // rows)))
    tasks = min(rows * columns, max(CELLS_PER_CORE * cores, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def own(parts: int) -> Column:
        return F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")

    def all_of(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    held = ["block", "windows", *_LAYOUT.names]
    left = anchors.select(own(rows).alias("row"), all_of(columns).alias("column"), F.lit(0).alias("kind"), *held)
    right = blocks.withColumn("windows", F.lit(None).cast(anchors.schema["windows"].dataType)).select(
        all_of(rows).alias("row"), own(columns).alias("column"), F.lit(1).alias("kind"), *held
    )
    dealt = left.unionByName(right).repartition(tasks, "row", "column")
    return dealt.sortWithinPartitions("row", "column", "kind")


class _Anchors:
    """An anchor block with the lists of its anchors: one each for positives, or one per window for negatives."""

    def __init__(self, row: dict, size: int, low: int, high: int):
        self.number = row["block"].as_py()
        self.ids, self.labels, cells = _unpacked(row)
        self.vectors = np.ascontiguousarray(cells.T).astype(np.int64)
        # place, lowest score, highest score, list
        self.lists: list[list] = [[] for _ in self.ids]
        if not row["windows"].is_valid:
            self.lists = [[(0, 0, 0, Best(size))] for _ in self.ids]
        for window in row["windows"].as_py() or []:
            first, last = -(-low * window["score"] // 100), high * window["score"] // 100
            if first <= last:
                self.lists[window["at"]].append((window["rank"], first, last, Best(size)))

    def meet(self, block: Block, same_label: bool) -> None:
        if block.cells.shape[0] != self.vectors.shape[1]:
            return
        by_label: dict[int, np.ndarray] = {}
        for at, lists in enumerate(self.lists):
            if not lists:
                continue
            label = int(self.labels[at])
            if label not in by_label:
                by_label[label] = np.flatnonzero((block.labels == label) == same_label)
            rows = by_label[label]
            if len(rows):
                own = block.ids[rows] == self.ids[at]
                rows = rows[~own] if own.any() else rows
            if not len(rows):
                continue
            if same_label:
                best_of(block, self.vectors[at], rows, lists[0][3])
            else:
                best_in_windows(block, self.vectors[at], rows, [w[1:] for w in lists])

    def found(self, schema: pa.Schema) -> pa.RecordBatch:
        out = [
            (self.number, at, place, int(self.ids[at]), score, i)
            for at, lists in enumerate(self.lists)
            for place, _, _, best in lists
            for score, i in zip(best.scores.tolist(), best.ids.tolist())
        ]
        arrays = [pa.array(v, type=f.type) for v, f in zip(zip(*out) if out else [[]] * len(schema), schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _scanned(anchors: DataFrame, blocks: DataFrame, size: int, same_label: bool, low: int = 0, high: int = 0) -> DataFrame:
    """The best ``size`` rows of each list over all cells: anchor ``block``, ``at`` in it, list ``place``, ``anchor_id``,
    ``score``, ``id`` and ``rank``."""
    struct = StructType.fromDDL("block long, at int, place int, anchor_id long, score long, id long")
    schema = to_arrow_schema(struct)

    def run(batches):
        cell, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: text_column(batch, c)[i] for c in batch.schema.names}
                here = (row["row"].as_py(), row["column"].as_py())
                if here != cell:
                    for anchors in held:
                        yield anchors.found(schema)
                    cell, held = here, []
                if row["kind"].as_py() == 0:
                    held.append(_Anchors(row, size, low, high))
                elif held:
                    block = Block.of(*_unpacked(row))
                    for anchors in held:
                        anchors.meet(block, same_label)
        for anchors in held:
            yield anchors.found(schema)

    rows = _cells(anchors, blocks).mapInArrow(task(run), struct)
    best_first = Window.partitionBy("block", "at", "place").orderBy(F.col("score").desc(), "id")
    return rows.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= size)


def hard_negatives(
    df: DataFrame, anchors: Column, vector_col: str = "embedding", id_col: str = "vec_id", label: Column | str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``anchors`` is a condition on the columns of ``df``; null counts as false. ``low`` and ``high`` bound a window in
    hundredths of the positive's score. Components are scaled by ``SCALE`` and floored.
    """
    label = F.col(label) if isinstance(label, str) else label
    # By label, and inside a label by input position, so that neither a common label nor copies of a row make a large part.
    salted = _rows(df, vector_col, id_col, label).withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    dealt = salted.repartitionByRange("_label", "_salt").drop("_salt")
    blocks = _blocks(dealt, BLOCK_ROWS, "row-blocks")
    asked = df.where(anchors)
    few = max(1, -(-asked.count() // ANCHOR_ROWS))
    chosen = _blocks(_rows(asked, vector_col, id_col, label).repartition(few), ANCHOR_ROWS, "anchor-blocks")

    window = "array<struct<at: int, rank: int, score: long>>"
    best = _scanned(chosen.withColumn("windows", F.lit(None).cast(window)), blocks, positives, True)
    best = materialize(best.select("block", "at", "rank", F.col("id").alias("positive_id"), "score"), "positives")
    # At most ``ANCHOR_ROWS`` times ``positives`` entries.
    windows = best.groupBy("block").agg(F.collect_list(F.struct("at", "rank", "score")).cast(window).alias("windows"))
    found = _scanned(chosen.join(windows, "block"), blocks, negatives, False, low, high)
    met = found.withColumnsRenamed({"score": "negative_score", "id": "negative_id", "rank": "_rank", "place": "rank"}).join(
        best.withColumnRenamed("score", "positive_score"), ["block", "at", "rank"]
    )
    return met.select(
        "anchor_id", "positive_id", F.col("_rank").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
