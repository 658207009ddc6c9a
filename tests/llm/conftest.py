from __future__ import annotations

import random
import re

import pytest

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    """Lower-cased (A-Z) words of a text."""
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


@pytest.fixture(scope="session")
def prose():
    """Texts of random words with exact copies, near copies and shared passages."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("aeioustrnl", k=rng.randint(2, 7))) for _ in range(400)]

    def make(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage = make(70)
    texts = [make(rng.choice([1, 3, 30, 120, 300])) for _ in range(60)]
    for base in range(0, 20, 4):
        texts.append(list(texts[base]))
        near = list(texts[base + 2])
        for _ in range(max(1, len(near) // 40)):
            near[rng.randrange(len(near))] = "changed"
        texts.append(near)
    texts += [make(40) + passage + make(30) for _ in range(4)]
    return [" ".join(t) for t in texts]


@pytest.fixture(scope="session")
def documents(spark, prose):
    rows = [(i, t, "en" if i % 3 else "fr", f"src{i % 5}", len(t)) for i, t in enumerate(prose)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


ODD_TEXTS = [
    None, "", "   \n\t ", "one", "One one", "a " * 70_000, "x" * 200_000, "é漢🙂 \u00a0 mot", "a\x00b c", "Same text here now",
    "Same text here now", "line\nline\nline\n", "mail me@a.example.org 1.2.3.4 +1 (499) 555-6503 pay 4111111111111111",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows and ids, and columns named like results."""
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "src0", None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id at all", None, None, None), (None, None, None, None, None), rows[9], rows[9], (3, "another with id three", "en", "src0", 1)]
    clash = [(*r, 7, True, "x", 1.5, 2) for r in rows]
    return spark.createDataFrame(clash, SCHEMA + ", n_words long, kept boolean, spans string, score double, node long")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
