from __future__ import annotations

import sys
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tenura.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    """The kinds by their patterns alone."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans = [("email", *m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]
    return spans


def test_base_spans_match_the_patterns():
    rng = random.Random(4)
    parts = ["a", "B.c", "@", "@x", ".org", "..", "-", "+", "1", "255", "256", "0001", ".", " ", "(", ")", "4111111111111111", "4111 1111 1111 1111", "%", "é", "@@", "a@b.c", "\n"]
    for _ in range(30_000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 12)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@" * 100_000, "@" * 300_000):
        pii.base_spans(text)


def test_counts_and_digests(spark, odd):
    texts = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = pii.find_personal_data(odd).collect()
    wanted = []
    for i, text in texts:
        spans = plain(text or "")
        wanted.append((i, *[sum(s[0] == k for s in spans) for k in pii.KINDS], pii.joined(spans)))
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base) for r in found), key=repr) == sorted(wanted, key=repr)
    assert any(r.n_email and r.n_ip and r.n_card and r.n_phone for r in found)


def disclosing(texts, support, disclosure, near):
    """Term spans by the definition."""
    import math

    words = re.compile("[^\x20\x09-\x0D]+")
    lower = lambda s: re.sub("[A-Z]", lambda m: m.group().lower(), s)
    n_term, n_entity, n_both, places = {}, {}, {}, {}
    for i, text in texts.items():
        text = text or ""
        spans = plain(text)
        tokens = [(lower(m.group()), *m.span()) for m in words.finditer(text)]
        for w in {t[0] for t in tokens}:
            n_term[w] = n_term.get(w, 0) + 1
        entities = {(k, text[a:b]) for k, a, b in spans}
        for e in entities:
            n_entity[e] = n_entity.get(e, 0) + 1
        free = [all(e <= a or s >= b for _, a, b in spans) for _, s, e in tokens]
        pairs = set()
        for k, a, b in spans:
            over = [j for j, (_, s, e) in enumerate(tokens) if e > a and s < b]
            for j, (w, s, e) in enumerate(tokens):
                if free[j] and (0 < over[0] - j <= near or 0 < j - over[-1] <= near):
                    pairs.add(((k, text[a:b]), w))
                    places.setdefault(i, set()).add(((k, text[a:b]), w, s, e))
        for p in pairs:
            n_both[p] = n_both.get(p, 0) + 1
    n = len(texts)
    told = set()
    for (e, w), both in n_both.items():
        if both >= support and n_entity[e] < n:
            pmi = math.log(n * both / (n_term[w] * n_entity[e]))
            if pmi / math.log(n / n_entity[e]) >= disclosure - 1e-12:
                told.add((e, w))
    return {i: sorted({(s, e) for p, w, s, e in own if (p, w) in told}) for i, own in places.items()}


@pytest.fixture(scope="module")
def letters():
    rng = random.Random(8)
    common = ["the", "of", "and", "to", "in", "mail"]
    texts = {i: " ".join(rng.choices(common, k=30)) for i in range(60)}
    texts[3] = "the Boss of Acme mail boss@acme.example.org the and the Tower"
    texts[9] = "and to boss@acme.example.org boss of acme , tower"
    texts[12] = "the tower and Acme of other things"
    texts[20] = "call +1 (499) 555-6503 or +1 (499) 555-6503 zebra"
    texts[21] = "zebra call +1 (499) 555-6503"
    texts[22] = None
    return texts


def test_terms_follow_the_definition(spark, letters):
    df = spark.createDataFrame(list(letters.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    wanted = disclosing(letters, pii.SUPPORT, pii.DISCLOSURE, sys.maxsize)
    for i, row in found.items():
        terms = [tuple(map(int, s.split(":")[1:])) for s in row.spans.split(",") if s.startswith("term")]
        assert terms == wanted.get(i, [])
        assert row.spans.startswith(row.base)
    assert wanted[3] and wanted[20]


def test_redaction(spark, letters):
    df = spark.createDataFrame([(i, t, i) for i, t in letters.items()], "doc_id long, text string, spans long")
    rows = {r.doc_id: r for r in pii.redact(df).collect()}
    assert len(rows) == len(letters) and rows[5].spans == 5
    for i, text in letters.items():
        if not plain(text or ""):
            assert rows[i].text == text
    assert rows[9].text == "and to <email> <term> of acme , tower" or "<email>" in rows[9].text
    assert "boss@acme" not in rows[3].text and "Boss" not in rows[3].text
    assert rows[12].text == letters[12]
    assert "555" not in rows[20].text


def test_odd_rows(odd, nothing):
    redacted = pii.redact(odd)
    assert redacted.columns == odd.columns and redacted.count() == odd.count()
    assert pii.find_personal_data(odd).count() == odd.count()
    assert pii.find_personal_data(nothing).count() == 0 and pii.redact(nothing).count() == 0


def test_query_digest(spark, letters):
    df = spark.createDataFrame(list(letters.items()), "doc_id long, text string")
    rows = pii.find_personal_data(df).select("doc_id", "base", F.sha2("base", 256).alias("s")).collect()
    assert all(r.s == hashlib.sha256(r.base.encode()).hexdigest() for r in rows)


def test_a_disclosing_term_goes_at_every_distance(spark):
    rng = random.Random(2)
    filler = lambda k: " ".join(rng.choices(["the", "of", "and", "to"], k=k))
    texts = {i: filler(40) for i in range(60)}
    texts[1] = f"Zelda Quux {filler(30)} call +1 (499) 555-6503 zelda {filler(50)} ZELDA"
    texts[2] = f"+1 (499) 555-6503 {filler(80)} zelda {filler(3)} quux"
    texts[3] = texts[2]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    wanted = disclosing(texts, pii.SUPPORT, pii.DISCLOSURE, 10**9)
    assert len(wanted[1]) == 4 and len(wanted[2]) == len(wanted[3]) == 2
    for row in pii.find_personal_data(df).collect():
        terms = [tuple(map(int, s.split(":")[1:])) for s in row.spans.split(",") if s.startswith("term")]
        assert terms == wanted.get(row.doc_id, [])
    redacted = {r.doc_id: r.text.lower() for r in pii.redact(df).collect()}
    assert not any(w in redacted[i] for i in (1, 2, 3) for w in ("zelda", "quux", "555"))
