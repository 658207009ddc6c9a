from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from tenura.llm import fim


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(doc_id, text):
    """The contract, on code points of a Python string."""
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    one, two, three, four = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or three % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((one % (n + 1), two % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if four % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows_of(df, **more):
    out = fim.fill_in_middle(df, **more).withColumn("text", fim.restored(F.col("output"), F.col("form")))
    return [tuple(r) for r in out.collect()]


def test_against_slices_of_strings(spark, prose):
    rng = random.Random(3)
    letters = "aé漢🙂 <PSM>\ń"
    texts = prose + ["".join(rng.choices(letters, k=rng.randint(1, 9_000))) for _ in range(120)]
    texts += ["x<P>y", "<S>", "a<M", "<<S", "P>x", "<P" * 50, "🙂" * 5_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(rows_of(df))
    assert got == [(i, *wanted(i, t), t) for i, t in enumerate(texts)]
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_odd_rows(spark, odd, nothing):
    got = sorted(map(repr, rows_of(odd)))
    expected = [(r.doc_id, *wanted(r.doc_id, r.text), r.text or "") for r in odd.select("doc_id", "text").collect()]
    assert got == sorted(map(repr, expected))
    assert rows_of(nothing) == []


@pytest.mark.parametrize("block", [1, 3, 7, 64])
def test_tree_finds_every_boundary(block):
    rng = np.random.default_rng(block)
    text = "".join(rng.choice(list("aé漢🙂 "), 150))
    data = text.encode()
    points = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
    tree = fim.BlockTree(points, points, block)
    for k in range(len(text) + 1):
        assert tree.cut(k) == (len(text[:k].encode()), k)
    # Units that are rarer than blocks: most blocks hold none.
    units = points & (rng.random(len(points)) < 0.05)
    tree, starts = fim.BlockTree(units, points, block), np.flatnonzero(units)
    for k, at in enumerate(starts):
        assert tree.cut(k) == (at, int(points[:at].sum()))
    assert tree.cut(len(starts)) == (len(data), len(text))


def test_units_of_a_pattern(spark):
    text = "  ein Wort, zwei\nWörter und 🙂 noch eins  "
    df = spark.createDataFrame([(i, text) for i in range(40)] + [(40, "..."), (41, "")], "doc_id long, text string")
    starts = [m.start() for m in regex.finditer(r"\w+", text)]
    edges = {0, len(text), *starts[1:]}
    for doc_id, n, form, prefix, middle, output, back in rows_of(df, pattern=r"\w+", block=8):
        if doc_id < 40:
            assert back == text and n == len(starts)
            if form != "plain":
                assert prefix in edges and prefix + middle in edges
        else:
            assert n == 0 and back == ("..." if doc_id == 40 else "")


def test_rates_and_repeats(spark):
    df = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("some words of a text").alias("text"))
    counts = {r["form"]: r["count"] for r in fim.fill_in_middle(df).groupBy("form").count().collect()}
    assert 0.88 < 1 - counts["plain"] / 4_000 < 0.92 and 0.17 < counts["spm"] / (counts["spm"] + counts["psm"]) < 0.23
    assert {r["form"] for r in fim.fill_in_middle(df, rate=0).collect()} == {"plain"}
    assert fim.fill_in_middle(df).exceptAll(fim.fill_in_middle(df.repartition(5))).isEmpty()
