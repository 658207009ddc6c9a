from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tenura.llm import bitmap, setsketch
from tenura.llm.words import chunks, mix
from tests.llm.conftest import words_of


def shingle_set(text, size):
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent=80):
    """Ids, set sizes and least reachable ids; rows with a null id are never linked."""
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [
        (d, len(s), None if d is None else least[root(i)], d is None or d == least[root(i)])
        for i, ((d, _), s) in enumerate(zip(rows, sets))
    ]


def same(df, size):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    found = setsketch.near_duplicates(df, size=size).collect()
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found]
    assert sorted(got, key=repr) == sorted(brute(rows, size), key=repr)


@pytest.mark.parametrize("size", [2, 5])
def test_components_match_brute_force(documents, size):
    same(documents, size)


def chain(n, rng):
    """Texts of which only neighbours are near enough, and a large group around one text."""
    words = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(n):
        words = list(words)
        for k in rng.choice(120, 5, replace=False):
            words[k] = f"c{i}x{k}"
        texts.append(" ".join(words))
    return texts


def test_chains_and_large_groups(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 400)
    rng = np.random.default_rng(6)
    texts = chain(30, rng)
    base = [f"b{i}" for i in range(100)]
    for i in range(80):
        own = list(base)
        for k in rng.choice(100, 4 + i % 5, replace=False):
            own[k] = f"d{i}x{k}"
        texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    same(df, 2)


def test_odd_rows(odd, nothing):
    same(odd, 2)
    kept = setsketch.keep_first(odd, size=2)
    assert kept.columns == odd.columns
    wanted = {r[0] for r in brute([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()], 2) if not r[3]}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in odd.select("doc_id").collect()} - wanted
    assert setsketch.near_duplicates(nothing).count() == 0 and setsketch.keep_first(nothing).count() == 0


def sketch_of(values):
    keys = np.sort(np.asarray(values, dtype=np.uint64))
    return setsketch.sketches(keys, np.array([0, len(keys)]))[0]


def test_sketches_merge_and_estimate():
    pool = mix(np.arange(1, 3_001, dtype=np.uint64))
    one, two = pool[:2_000], pool[400:2_400]
    a, b = sketch_of(one), sketch_of(two)
    assert (setsketch.merged(a, b) == sketch_of(np.union1d(one, two))).all()
    estimates = []
    for seed in range(30):
        pool = mix(np.arange(seed * 10_000 + 1, seed * 10_000 + 3_001, dtype=np.uint64))
        a, b = sketch_of(pool[:2_000]), sketch_of(pool[200:2_100])
        up, down = (a > b).sum(), (a < b).sum()
        estimates.append(setsketch.likely_similarity(np.array([up]), np.array([down]), np.array([2_000]), np.array([1_900]))[0])
    assert abs(np.mean(estimates) - 1_800 / 2_100) < 0.02 and np.std(estimates) < 0.06
    assert (setsketch.sketches(np.zeros(0, np.uint64), np.array([0, 0])) == 0).all()


def test_sets_of_a_chunk():
    texts = ["a b a b a", "A", "", None, "x y", "one two three four five six"]
    for size in (2, 5):
        for chunk in chunks(pa.array(texts)):
            keys, edges = setsketch.shingle_sets(chunk, size)
            assert list(np.diff(edges)) == [len(shingle_set(t, size)) for t in texts]
    one = setsketch.shingle_sets(next(chunks(pa.array(["p q r", "P Q R", "r q p"]))), 2)
    assert (one[0][:2] == one[0][2:4]).all() and set(one[0][4:]) != set(one[0][:2])


def test_bitmap(spark):
    keys = [-5, 0, 7, 1 << 40, -(1 << 62), 123456789]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long")
    held = bitmap.build(df, "k", 1 << 20)
    assert bitmap.holds(held, np.array(keys, dtype=np.int64)).all()
    assert bitmap.holds(held, np.arange(1, 1_000_000, 1_001, dtype=np.int64) << 9).mean() < 0.01
    assert not bitmap.build(df.limit(0), "k", 1 << 20).any()
