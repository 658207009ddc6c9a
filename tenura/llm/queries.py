"""Registered queries of the operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import bond, bpe, fim, forest, mixing, oracles, passages, pii, pst, quality, setsketch, shards, urls, warc
from tenura.session import apply_settings

# The rules of the url query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
MIX_POWERS = {"source": 0.8, "lang": 0.8, "topic": 0.9}
# Stored pages have no fetch time; their records share one.
CRAWL_DATE = "2024-01-01T00:00:00Z"


def prepared(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches of whole texts that stay small."""
    apply_settings(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return spark


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_signals(_table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_pages(_table(spark, sf_dir, "pages"), rules)


def mix_dimensions() -> dict:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.content_type(F.col("text"))}


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    mixed = mixing.sample(documents, mix_dimensions(), powers=MIX_POWERS)
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled", "gap")


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return pst.score_texts(documents, F.crc32(F.col("doc_id").cast("string")) % 7 != 2)


def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_texts(documents, path, public_tokenizers.PATTERN, digests=True)


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.build_derivatives(warc.responses_of(_table(spark, sf_dir, "pages"), CRAWL_DATE))


def op8_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
    return found.withColumns({"query_id": F.col("query_id").cast("long"), "vec_id": F.col("vec_id").cast("long")})


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op10_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), size=2)


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bond.hard_negatives(vectors, F.col("vec_id") % 50 == 0, label=shifted)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(_table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return shards.place_documents(documents, shards.tree(), shards.tree(shards.SHARDS + 1))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_url_filters, op3_source_mixing, op4_suffix_tree, op5_compact_windows, op6_byte_bpe,
        op7_warc_derivatives, op8_projection_forest, op9_personal_data,
        op10_setsketch_dedup, op11_bond_negatives, op12_fill_in_middle, op13_hash_tree_shards,
    )
}
ORACLES: dict[str, str] = {
    "op1_quality_rules": oracles.QUALITY_RULES,
    "op2_url_filters": oracles.URL_FILTERS,
    "op10_setsketch_dedup": oracles.NEAR_DUPLICATES,
    "op11_bond_negatives": oracles.HARD_NEGATIVES,
    "op12_fill_in_middle": oracles.FILL_IN_MIDDLE,
}
