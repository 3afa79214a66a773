"""From raw documents to packed sequences, in five stages.

Each stage works on all rows the one before kept and returns the columns of
``documents``; the last returns one row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import language, lines, packing, secrets, simhash
from tripflow.llm.common import dropped, read, stored

#: Nats a letter by which its language must explain a text better than letter frequencies do; the README says how it was set.
MIN_FAMILIAR = 0.0
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` made to fit a text that was changed."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null and empty ones among them, and texts spelt like none of the learned languages.

    Without a labelled row that may be learned from, all texts with a letter stay; ids and
    repeated rows do not matter.
    """
    return language.keep_identified(docs, language.fit(docs), min_familiar=MIN_FAMILIAR)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes runs of two or more lines seen before out of the texts; no row goes, null texts stay null."""
    return _counted(lines.dedup_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component, that of the smallest id, nulls last.

    Null and empty texts are alike, so one of them stays.
    """
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets, nested encodings included; no row goes, null texts stay null."""
    return _counted(secrets.redact_secrets(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every piece of every document in a sequence of 1024 tokens; a null text counts as empty."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: SQL has no SimHash, string kernel, nested decoding or tokenizer; tests use plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; an empty table gives no pieces, and columns beyond those of ``documents`` go along."""
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        if number:
            dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
