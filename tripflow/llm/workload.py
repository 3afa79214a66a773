"""The operators as queries over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import (
    ball_tree,
    bpe,
    exact,
    language,
    lines,
    merkle,
    multi_index,
    packing,
    secrets,
    simhash,
    spelling,
    token_files,
    toxicity,
)
from tripflow.llm.common import read
from tripflow.session import shared_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(read(spark, sf_dir, "documents")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, report=True)


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(read(spark, sf_dir, "embeddings"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = token_files.write_tokens(read(spark, sf_dir, "documents"), shared_dir(spark, "tokens"), WORD_BPE)
    return token_files.read_tokens(spark, shards)


def op6_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_products(read(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), BYTE_BPE)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op9_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), BYTE_BPE)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.find_variants(read(spark, sf_dir, "documents"))


def op13_golomb_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.digest_columns(exact.find_copies(read(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_simhash": op2_simhash,
    "op3_line_dedup": op3_line_dedup,
    "op4_multi_index": op4_multi_index,
    "op5_token_files": op5_token_files,
    "op6_ball_tree": op6_ball_tree,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_forced_bpe": op9_forced_bpe,
    "op10_language": op10_language,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_golomb_dedup": op13_golomb_dedup,
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": lines.ORACLE,
    "op6_ball_tree": ball_tree.ORACLE,
    "op13_golomb_dedup": exact.ORACLE,
}
