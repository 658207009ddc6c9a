from __future__ import annotations

import base64
import hashlib

import public_tokenizers as tokenizers
import pytest

from tenura.llm import bpe

PATH = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_rank_file(documents, odd, reference):
    for df in (documents, odd):
        rows = df.select("doc_id", "text").collect()
        found = bpe.encode_texts(df, PATH, tokenizers.PATTERN).collect()
        assert sorted(((r.doc_id, r.ids) for r in found), key=repr) == sorted(
            ((r.doc_id, reference.encode_ordinary(r.text or "")) for r in rows), key=repr
        )
        assert all(r.n_tokens == len(r.ids) for r in found)


def test_digests(odd, reference):
    texts = {(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()}
    wanted = []
    for i, text in texts:
        ids = reference.encode_ordinary(text or "")
        wanted.append((i, len(ids), _hex(",".join(map(str, ids)).encode()), _hex((text or "").encode())))
    found = bpe.encode_texts(odd, PATH, tokenizers.PATTERN, digests=True).distinct().collect()
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def _hex(data):
    return hashlib.sha256(data).hexdigest()


def test_round_trip(odd):
    encoded = bpe.encode_texts(odd, PATH, tokenizers.PATTERN, keep=["lang", "kept"])
    assert encoded.columns == ["doc_id", "lang", "kept", "n_tokens", "ids"]
    decoded = bpe.decode_ids(encoded, PATH, tokenizers.PATTERN).collect()
    texts = [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.decoded.decode()) for r in decoded), key=repr) == sorted(texts, key=repr)


def test_bad_ids_decode_to_null(spark):
    df = spark.createDataFrame([(1, [0, 10**6]), (2, None), (3, []), (4, [1, None])], "doc_id long, ids array<int>")
    rows = {r.doc_id: r.decoded for r in bpe.decode_ids(df, PATH, tokenizers.PATTERN).collect()}
    assert rows == {1: None, 2: None, 3: b"", 4: None}


def test_empty_table(nothing):
    assert bpe.encode_texts(nothing, PATH, tokenizers.PATTERN).count() == 0


def test_random_strings(reference):
    import random

    rng = random.Random(2)
    codec = bpe.Codec(bpe.read_ranks(PATH), tokenizers.PATTERN)
    signs = ["\x1c", "\x85", "\xa0", "\u2003", "\u200b", " ", "  ", "\n", "\t", "a", "é", "漢", "1", "²", "🙂", "\u0301", "'s", "'LL", ".", "\x00", "▁", "<unk>"]
    for _ in range(3_000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 12)))
        ids = codec.encode(text)
        assert ids == reference.encode_ordinary(text) and codec.decode(ids) == text.encode()
