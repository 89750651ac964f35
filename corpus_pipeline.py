"""From raw documents to packed sequences: five stages, each written as Parquet before the next one reads it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skillweave.llm import deobfuscate, debruijn, digest_index, packing, simhash
from skillweave.llm.common import table
from skillweave.session import shared_root

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity score rejects go; null and empty texts stay. Learns from the labels of ``sf_dir``."""
    return deobfuscate.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space the row with the least id stays; null counts as empty."""
    return digest_index.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows whose fingerprints are linked within two bits the one with the least id stays."""
    return simhash.keep_one_of_each(docs)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 that occur twice leave ``text``, and ``n_chars`` follows; all rows stay."""
    return debruijn.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4,096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_spans),
    ("packing", pack_sequences),
]

# Scores, fingerprints and ids have no form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads back what the one before it has written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
