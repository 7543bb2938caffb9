"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source mix, packing.

Each stage takes the documents its predecessor kept and returns them with their own columns; the
last returns where each piece of a document lies in the training sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from penstock.llm import common, mixing, packing, quality, simhash, spans

MAX_REPEATS = 1.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return simhash.deduplicated(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of passages that occurred before go."""
    return spans.deduplicated(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated up to MAX_REPEATS times; every document occurs at least once."""
    return mixing.mixed(docs, max_repeats=MAX_REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")]
    return packing.packed(packing.pieces(docs, *files, public_tokenizers.PATTERN, with_ids=False))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("pack", pack),
]

# XXH64 fingerprints, expectation-maximisation and byte-pair encoding have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
