"""A training-data pipeline over `documents`: clean, deduplicate and pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewarden.context import cut_lineage
from tablewarden.llm import langid, ngram_join, packing, passages, quality
from tablewarden.llm.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose host fails, go."""
    return quality.filter_quality(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or far from every language learned here, go."""
    return langid.filter_languages(docs, langid.learn(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    return ngram_join.drop_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out of the texts."""
    return passages.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences in which each source has its share."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: Models and tokenizers are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each reads what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
