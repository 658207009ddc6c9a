"""Quality rules from repetition coverage (operator 1).

Rolling hashes of word n-grams of several lengths, in numpy, give the share of a text's word characters that lie in an
n-gram found before in the text, and line hashes the share that lies in lines equal to an earlier one. A first occurrence
is no repetition, so that one repeated sentence does not condemn a short text. A text is rejected when a share exceeds
its limit, or by the base rule on length and repeated 8-word windows.

Texts are judged one by one, so nothing is shuffled: one pass, balanced by the scan, whatever the sources' sizes.

Edge cases: a null or empty text has no words, all counts 0, ``base_failed`` true and ``kept`` false. Repeated ids are
judged row by row. Other columns are ignored by :func:`quality_signals` and passed on unchanged by
:func:`keep_good`. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tenura.llm.arrow import keep_rows, map_batches, text_column
from tenura.llm.words import _ALL, IS_WORD, Chunk, chunks, mix, piece_hashes

# Limits on the share of characters in duplicated n-grams, by n, as published for web text filtering.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.30
LINE_CHARS_LIMIT = 0.20
# A share of lines says little about a text of a few lines.
LEAST_LINES = 5
MIN_WORDS = 20
WINDOW = 8
WINDOW_PERCENT = 30
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_LINE = np.where(np.arange(256) == 0x0A, np.uint64(0), _ALL)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _apart(owner: np.ndarray) -> np.ndarray:
    """A number per text that keeps equal hashes of different texts apart."""
    return mix(owner.astype(np.uint64) + np.uint64(1))


def _duplicated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the keys found twice or more, and of those among them that are not the first of their kind."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    flags = np.zeros(len(keys), dtype=bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    at = np.flatnonzero(flags)
    _, first = np.unique(keys[at], return_index=True)
    later = flags.copy()
    later[at[first]] = False
    return flags, later


def _covered(begins: np.ndarray, width: int, n_words: int) -> np.ndarray:
    """Flags of the words inside a window that starts at ``begins``."""
    edge = np.zeros(n_words + 1, dtype=np.int32)
    edge[begins] += 1
    edge[begins + width] -= 1
    return np.cumsum(edge[:-1]) > 0


def _measure(chunk: Chunk) -> dict[str, np.ndarray]:
    data, counts, owner = chunk.data, chunk.word_counts(), chunk.owner()
    n_words, n_docs = len(chunk.starts), len(counts)
    lead = (data & 0xC0) != 0x80
    # Characters of each word; the bytes up to the next word add none.
    chars = np.add.reduceat(lead & IS_WORD[data], chunk.starts, dtype=np.int64) if n_words else np.zeros(0, np.int64)
    total = np.bincount(owner, weights=chars, minlength=n_docs).astype(np.int64)
    out = {"n_words": counts.astype(np.int64), "word_chars": total, "n_symbols": chunk.sums(_SYMBOL[data])}

    # Lines with a word.
    line_at = np.union1d(chunk.edges[:-1], np.flatnonzero(data == 0x0A) + 1)
    line_at = line_at[line_at < len(data)]
    words_before = np.searchsorted(chunk.starts, np.append(line_at, len(data)))
    worded = np.diff(words_before) > 0
    line_owner = np.searchsorted(chunk.edges, line_at, side="right") - 1
    chars_before = np.concatenate(([0], np.cumsum(chars)))
    keys = (piece_hashes(data, line_at, _LINE) ^ _apart(line_owner))[worded]
    line_owner, line_chars = line_owner[worded], np.diff(chars_before[words_before])[worded]
    _, first = np.unique(keys, return_index=True)
    later = np.ones(len(keys), dtype=bool)
    later[first] = False
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=n_docs).astype(np.int64)
    out["n_lines"] = np.bincount(line_owner, minlength=n_docs).astype(np.int64)
    out["dup_line_chars"] = np.bincount(line_owner[later], weights=line_chars[later], minlength=n_docs).astype(np.int64)

    # Windows of growing width; a repeated window has repeated windows of the width before at both of its ends.
    words, apart = chunk.word_hashes(fold=False), _apart(owner)
    room = np.repeat(chunk.word_edges[1:], counts) - np.arange(n_words)
    rolled, factor, found = np.zeros(n_words, dtype=np.uint64), np.uint64(1), None
    for width in range(1, max(NGRAM_LIMITS) + 1):
        last = words[width - 1 :] * factor
        rolled[: len(last)] += last
        factor = np.uint64(int(factor) * int(_STEP) % (1 << 64))
        if width < min(NGRAM_LIMITS):
            continue
        able = room >= width
        if found is not None:
            able[:-1] &= found[:-1] & found[1:]
        at = np.flatnonzero(able)
        repeated, later = _duplicated(mix(rolled[at]) ^ apart[at])
        found = np.zeros(n_words, dtype=bool)
        found[at[repeated]] = True
        again = chars * _covered(at[later], width, n_words)
        out[f"dup_{width}gram_chars"] = np.bincount(owner, weights=again, minlength=n_docs).astype(np.int64)
        if width == WINDOW:
            inside = _covered(at[repeated], width, n_words)
            out["n_repeat_words"] = np.bincount(owner[inside], minlength=n_docs).astype(np.int64)

    out["base_failed"] = (counts < MIN_WORDS) | (100 * out["n_repeat_words"] > WINDOW_PERCENT * counts)
    heavy = (out["n_dup_lines"] > LINE_LIMIT * out["n_lines"]) & (out["n_lines"] >= LEAST_LINES)
    heavy |= out["dup_line_chars"] > LINE_CHARS_LIMIT * total
    for width, limit in NGRAM_LIMITS.items():
        heavy |= out[f"dup_{width}gram_chars"] > limit * total
    out["kept"] = ~(out["base_failed"] | heavy)
    return out


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars"] + [
    f"dup_{n}gram_chars" for n in NGRAM_LIMITS
]


def measure(column) -> dict[str, np.ndarray]:
    """Counts and verdicts of the texts of one Arrow column."""
    parts = [_measure(chunk) for chunk in chunks(column)]
    return {name: np.concatenate([p[name] for p in parts]) for name in (*COUNTS, "base_failed", "kept")}


def quality_signals(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, counts, ``base_failed`` and ``kept`` of every text."""
    source = df.select(df[id_col].alias("_id"), df[text_col].cast("string").alias("_text"))
    out = f"{id_col} {df.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batch):
        return {id_col: text_column(batch, "_id"), **measure(text_column(batch, "_text"))}

    return map_batches(source, run, out + ", base_failed boolean, kept boolean")


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text passes, with all their columns."""
    return keep_rows(df, lambda column: measure(column)["kept"], text_col)
