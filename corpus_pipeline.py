"""A training corpus from raw documents: quality, near-duplicates, personal data, mixing, token ids.

Each stage gets what the one before it kept, written as Parquet and read again. All but the last return the columns of
``documents``; the last returns id, language, source and the token ids.

Edge cases: a null or empty text has too few words for the first stage and goes; the other stages, given one, keep it as it is, and
it has no tokens. Nulls in other columns are values like others. Of rows with equal texts the one with the least id stays; a null id
is near nothing and stays. Repeated ids are documents of their own. Texts of any length are looked at whole. Columns that
``documents`` has besides, whatever their names, pass through all stages but the last; without ``n_chars`` none is made. An empty
table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import bpe, mixing, pii, quality, setsketch
from tenura.llm.queries import MIX_POWERS, mix_dimensions, prepared
from tenura.session import compact, materialize

# Share of the tokens that the mix may use.
MIX_SHARE = 0.9


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    prepared(spark)
    return compact(quality.keep_good(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, on five-word shingles at 0.8."""
    prepared(spark)
    return compact(setsketch.keep_first(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms replaced."""
    prepared(spark)
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return compact(clean)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet tempered source, language and topic shares as far as they reach."""
    prepared(spark)
    return compact(mixing.keep_sampled(docs, mix_dimensions(), powers=MIX_POWERS, budget_share=MIX_SHARE))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    prepared(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return compact(bpe.encode_texts(docs, path, public_tokenizers.PATTERN, keep=["lang", "source"]))


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", source_mixing),
    ("token_ids", token_ids),
]

# Sketches, disclosure and raking are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
