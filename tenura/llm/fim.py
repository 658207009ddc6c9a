"""Fill-in-middle transformation with a tree over text blocks (operator 12).

A text is cut twice at unit boundaries into prefix, middle and suffix, and put together again with three sentinels: as
prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``), or it stays as it is (``plain``). Units are code points,
or matches of a pattern: a match with what follows it up to the next one, what comes before the first belongs to it.

The UTF-8 bytes of a text are divided into blocks of ``BLOCK_BYTES``. A Fenwick tree over the blocks holds how many units
and how many code points begin in each. To cut after ``k`` units, a descent by halving steps through the tree finds the block
where unit ``k`` begins and the units and code points before that block; only this block is then looked into. Every row is
worked on by itself: nothing is shuffled, and a task holds one batch of texts.

All draws come from the sha256 of seed and id, so a document has the same form and cuts on every run and in any layout.
:func:`restored` takes the output apart again with column functions; as a text that holds a sentinel stays plain, and a
sentinel can not arise across a seam, each sentinel is found once.

Edge cases: a null text is empty, and an empty one is plain, with 0 units. A null id is drawn for as the id ''. Repeated
rows are transformed alike, rows with one id share their draws. A text without a match of the pattern has 0 units, all of it
is suffix. Texts of any length are cut whole. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.arrow import map_batches, text_column

BLOCK_BYTES = 4_096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
# Out of 100 documents, transformed ones; out of 100 of those, the ones in the order suffix, prefix, middle.
RATE, SPM_RATE = 90, 20


class BlockTree:
    """Units and code points of a text's blocks; node ``i`` (from 1) sums the ``i & -i`` blocks that end with block ``i``."""

    def __init__(self, unit_starts: np.ndarray, point_starts: np.ndarray, block: int = BLOCK_BYTES):
        self.unit_starts, self.point_starts, self.block = unit_starts, point_starts, block
        begins = np.arange(0, len(point_starts), block)
        node = np.arange(1, len(begins) + 1)
        self.nodes = []
        for flags in (unit_starts, point_starts):
            held = np.add.reduceat(flags, begins, dtype=np.int64) if len(begins) else np.zeros(0, dtype=np.int64)
            before = np.concatenate(([0], np.cumsum(held)))
            self.nodes.append(before[node] - before[node - (node & -node)])
        self.units = int(np.count_nonzero(unit_starts))

    def cut(self, units: int) -> tuple[int, int]:
        """Byte where a cut after ``units`` units lies, and the code points before it."""
        in_units, in_points = self.nodes
        at, points, left = 0, 0, units
        step = 1 << len(in_units).bit_length()
        while step:
            if at + step <= len(in_units) and in_units[at + step - 1] <= left:
                at += step
                left -= int(in_units[at - 1])
                points += int(in_points[at - 1])
            step >>= 1
        begin = at * self.block
        if begin >= len(self.point_starts):
            return len(self.point_starts), points
        inside = int(np.flatnonzero(self.unit_starts[begin : begin + self.block])[left])
        return begin + inside, points + int(np.count_nonzero(self.point_starts[begin : begin + inside]))


def _unit_starts(text: bytes, point_starts: np.ndarray, pattern: regex.Pattern | None) -> np.ndarray:
    """Flags of the bytes at which a unit begins."""
    if pattern is None:
        return point_starts
    flags = np.zeros(len(text), dtype=bool)
    points = [m.start() for m in pattern.finditer(text.decode())]
    if points:
        points[0] = 0
        flags[np.flatnonzero(point_starts)[points]] = True
    return flags


def draws(seed: int, key: str | None) -> tuple[int, int, int, int]:
    """The four numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{key or ''}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def cut_up(
    text: bytes, numbers: tuple[int, int, int, int], rate: int = RATE, spm_rate: int = SPM_RATE,
    pattern: regex.Pattern | None = None, block: int = BLOCK_BYTES,
) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle (None if plain), and the output of one text."""
    point_starts = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    tree = BlockTree(_unit_starts(text, point_starts, pattern), point_starts, block)
    one, two, three, four = numbers
    marks = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]
    if not text or three % 100 >= rate or any(mark in text for mark in marks):
        return tree.units, "plain", None, None, text
    # Cuts behind unit n lie at the end of the text.
    places = sorted((one % (tree.units + 1), two % (tree.units + 1)))
    (first, prefix_points), (last, both_points) = (tree.cut(k) for k in places)
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if four % 100 < spm_rate:
        form, output = "spm", b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle))
    else:
        form, output = "psm", b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle))
    return tree.units, form, prefix_points, both_points - prefix_points, output


def fill_in_middle(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
    pattern: str | None = None, block: int = BLOCK_BYTES,
) -> DataFrame:
    """Id, ``n`` units, ``form``, ``prefix_chars`` and ``middle_chars`` (null if plain) and ``output`` of every text."""
    source = df.select(
        df[id_col].alias("_id"), df[id_col].cast("string").alias("_key"), df[text_col].cast("string").alias("_text")
    )
    units = regex.compile(pattern) if pattern else None

    def run(batch):
        out = {c: [] for c in ("n", "form", "prefix_chars", "middle_chars", "output")}
        for key, text in zip(text_column(batch, "_key"), text_column(batch, "_text")):
            held = text.as_buffer() if text.is_valid else None
            row = cut_up(bytes(held) if held else b"", draws(seed, key.as_py()), rate, spm_rate, units, block)
            for name, value in zip(out, row):
                out[name].append(value)
        return {id_col: text_column(batch, "_id"), **out, "output": [o.decode() for o in out["output"]]}

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(
        source, run, f"{id_col} {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of :func:`fill_in_middle` was made of."""

    def after_mark(part: Column) -> Column:
        return F.substring(part, F.lit(len(PREFIX) + 1), F.length(part))

    def parts(second: str) -> tuple[Column, Column, Column]:
        rest = F.substring_index(output, second, -1)
        return (
            after_mark(F.substring_index(output, second, 1)), F.substring_index(rest, MIDDLE, 1),
            F.substring_index(rest, MIDDLE, -1),
        )

    prefix, suffix, middle = parts(SUFFIX)
    behind, front, between = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(front, between, behind))
        .otherwise(output)
    )
