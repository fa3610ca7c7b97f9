"""Training corpus pipeline: documents to tokens in five stages.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read back as the next stage's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

import logging
import secrets
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bpe, decontaminate, language_id, pii, simhash
from terrace.llm.queries import VOCABULARY, table
from terrace.llm.shared import cut


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go: texts far from every
    learnt language, and texts without a letter."""
    _, learn = language_id.learn_rule(docs["doc_id"])
    return language_id.accept(docs, language_id.train(docs, learn))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


KEY_SETTING = "spark.terrace.pii.key"


def pseudonym_key(spark: SparkSession) -> bytes:
    """The secret key of the pseudonyms, from the session's settings. Without
    one, a run draws its own: its pseudonyms cannot be turned back, and equal
    values are linked within this run only."""
    key = spark.conf.get(KEY_SETTING, None)
    if key is not None and not key.strip():
        raise ValueError(f"{KEY_SETTING} is empty")
    if key is None:
        logging.getLogger(__name__).warning("%s is not set: this run uses a key of its own", KEY_SETTING)
        return secrets.token_bytes(32)
    return key.encode("utf-8")


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers and dates are replaced in the texts."""
    return pii.pseudonymise(docs, pseudonym_key(spark), chars_col="n_chars")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(VOCABULARY))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("pii", pseudonymise),
    ("bpe", encode),
]

# A learnt classifier, XXH64 fingerprints, keyed pseudonyms and BPE have no SQL
# form. tests/llm/test_pipeline.py compares the rows of each stage with plain
# Python over its input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to and read from the shared
    folder, as the stage contract asks."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
