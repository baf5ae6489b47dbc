"""A corpus from raw documents to packed sequences, one operator after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import mixing, packing, pii, quality, simhash
from ledgerlake.llm.common import staged, table
from ledgerlake.session import tune

# Shares of the mix, and the tokenizer of the sequences.
WEIGHTS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}
TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and their language's perplexity band keep, each by its own verdict."""
    return quality.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, one with the smallest doc_id; rows without a doc_id stay."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts and n_chars counted again."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix has them; an empty table stays empty."""
    return mixing.drawn(docs, mixing.domains_of(table(spark, sf_dir, "labels")), WEIGHTS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, along the curve; see packing.packed()."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("sequences", sequences),
]
# SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written and read again before the next."""
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
