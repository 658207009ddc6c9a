from __future__ import annotations

import re
from collections import Counter

from tenura.llm import quality
from tests.llm.conftest import WORD


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


def repeated_chars(words, n):
    """Characters in n-grams that occurred before."""
    seen, inside = set(), set()
    for i in range(len(words) - n + 1):
        gram = tuple(words[i : i + n])
        if gram in seen:
            inside.update(range(i, i + n))
        seen.add(gram)
    return sum(len(words[i]) for i in inside)


def check(rows, texts):
    for row in rows:
        text = texts[row.doc_id]
        found = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert found == brute(text)
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        for n in quality.NGRAM_LIMITS:
            assert row[f"dup_{n}gram_chars"] == repeated_chars(WORD.findall(text or ""), n)


def test_counts_match_brute_force(spark):
    block = "the quick brown fox jumps over the lazy dog again and again"
    texts = {
        1: block, 2: f"{block}\n{block}\nother words follow here", 3: " ".join(f"w{i}" for i in range(100)),
        4: "a b " * 40, 5: "#*$ %&|<> plain\n\n  \nplain\nplain", 6: "é漢 " * 30,
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = quality.quality_signals(df).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_clean_text_stays_and_repetition_goes(spark):
    clean = "\n".join(" ".join(f"w{line}x{i}" for i in range(12)) for line in range(6))
    repeated = "\n".join(["always the very same long line of words in this text"] * 12)
    df = spark.createDataFrame([(1, clean), (2, repeated), (3, "too short")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in quality.quality_signals(df).collect()} == {1: True, 2: False, 3: False}
    assert [r.doc_id for r in quality.keep_good(df).collect()] == [1]


def test_one_repeated_sentence_does_not_condemn(spark):
    sentence = "this sentence of nine words stands at two places"
    text = f"{sentence}\n" + " ".join(f"w{i}" for i in range(160)) + f"\n{sentence}"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.quality_signals(df).first().kept


def test_odd_rows(odd, nothing):
    rows = quality.quality_signals(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words == 0)
    assert max(r.n_words for r in rows) == 70_000
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns
    assert quality.quality_signals(nothing).count() == 0 and quality.keep_good(nothing).count() == 0


def test_texts_over_chunk_borders(spark):
    import numpy as np
    import pyarrow as pa

    from tenura.llm.words import chunks

    texts = ["", "ab cd", None, "x" * 50, "e f g " * 20, " lead", "trail "]
    whole = np.concatenate([c.word_hashes() for c in chunks(pa.array(texts))])
    small = [c for c in chunks(pa.array(texts), limit=16)]
    assert len(small) > 3
    assert (np.concatenate([c.word_hashes() for c in small]) == whole).all()
    assert [int(n) for c in small for n in c.word_counts()] == [len(WORD.findall(t or "")) for t in texts]
