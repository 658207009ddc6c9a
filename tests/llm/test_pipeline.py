from __future__ import annotations

import base64
import sys
from collections import Counter

import public_tokenizers
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from tenura.llm import pii, quality
from tenura.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_pii import disclosing, plain
from tests.llm.test_setsketch import brute


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave."""
    from tenura.session import materialize

    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF_SMALL), "test-stage")
        out[name] = ({r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()}, docs.columns, after.columns)
        docs = after
    return out


def test_columns(stages):
    for name, (_, _, before, after) in list(stages.items())[:-1]:
        assert before == after == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_quality_stage(spark, stages):
    before, after, _, _ = stages["quality"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {r.doc_id for r in quality.quality_signals(docs).collect() if r.kept}
    assert set(after) == kept and 0 < len(after) < len(before)
    assert all(after[i] == before[i] for i in after)


def test_near_duplicate_stage(stages):
    before, after, _, _ = stages["near_duplicates"]
    wanted = {i for i, _, _, kept in brute([(i, r.text) for i, r in before.items()], 5) if kept}
    assert set(after) == wanted


def test_personal_data_stage(stages):
    before, after, _, _ = stages["personal_data"]
    assert set(before) == set(after)
    terms = disclosing({i: r.text for i, r in before.items()}, pii.SUPPORT, pii.DISCLOSURE, sys.maxsize)
    for i, row in after.items():
        assert row.n_chars == len(row.text)
        if not plain(before[i].text):
            assert row.text == before[i].text
        else:
            assert row.text == pii._replaced(before[i].text, [{"start": a, "end": b} for a, b in terms.get(i, [])])
            assert not plain(row.text)


def test_mixing_stage(stages):
    before, after, _, _ = stages["mixing"]
    assert set(after) <= set(before) and len(after) >= 0.75 * len(before)
    assert all(after[i] == before[i] for i in after)


def test_token_stage(stages):
    import tiktoken

    before, after, _, columns = stages["token_ids"]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(after) == set(before) and columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    for i, row in after.items():
        assert row.ids == reference.encode_ordinary(before[i].text) and row.n_tokens == len(row.ids)


def test_run_is_the_stages(spark, stages):
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert rows == stages["token_ids"][1]


CLASHES = ("topic", "_pii_key", "_text_key", "_pii_terms", "_sketch_bit", "_dropped", "_mix_0", "_mix_tokens", "weight", "kept", "n_tokens")


def test_stages_on_odd_rows(spark, odd, nothing):
    docs = odd.drop("kept", "n_words", "node").withColumns({c: F.lit("own") for c in CLASHES})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name == "token_ids":
            assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
            found = out.collect()
            assert len(found) == docs.count() and {r.n_tokens for r in found if r.doc_id in (0, 1)} == {0}
            continue
        assert out.columns == docs.columns, name
        rows = out.collect()
        if name == "personal_data":
            assert len(rows) == docs.count()
            assert sum(r.text is None for r in rows) == docs.where("text is null").count()
        elif name == "quality":
            assert all(len((r.text or "").split()) >= 20 for r in rows)
        elif name == "near_duplicates":
            ids = [r.doc_id for r in rows]
            assert 9 in ids and 10 not in ids and ids.count(None) == 2 and 0 in ids and 1 in ids
        others = [i for i, c in enumerate(docs.columns) if c not in ("text", "n_chars")]
        given = Counter(tuple(r[i] for i in others) for r in docs.collect())
        assert not Counter(tuple(r[i] for i in others) for r in rows) - given, name
    assert corpus_pipeline.personal_data(spark, odd.drop("n_chars"), SF_SMALL).count() == odd.count()


def test_stages_on_an_empty_table(spark, nothing):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, SF_SMALL)
        assert out.isEmpty() and (name == "token_ids" or out.columns == nothing.columns)


def test_every_query_runs(spark):
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(QUERIES) and len(QUERIES) == 13
    assert set(ORACLES) <= set(QUERIES)
    for name, query in QUERIES.items():
        assert query(spark, SF_SMALL).count() > 0, name


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_its_oracle(spark, name):
    from checks.compare import connect, differences

    assert differences(QUERIES[name](spark, SF_SMALL), connect(SF_SMALL), ORACLES[name]) is None
