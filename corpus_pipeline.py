"""The corpus pipeline: language ID, toxicity, near-duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. A stage works on all rows that the one before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fundsieve.llm import bpe, decontam, langid, neardup, toxicity
from fundsieve.llm.queries import BPE_RANKS, table
from fundsieve.llm.tables import cut


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language: null and empty ones, those without a letter, and all where nothing could be learnt. Null ids and repeated rows are kept like others."""
    return langid.with_language(docs, langid.learn(docs))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that score as toxic, by labels of rows still here. Null, empty and unlike texts get the rate of toxic labels, so they stay; repeated rows share one fate; without labels all stay."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five words, similarity 0.8), the smallest id. Texts without words are in no group; of equal rows one stays, and every row with a null id."""
    return neardup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, by id: all rows of that id go, rows with a null id stay. Null and empty texts hold none; without items all stay."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of every row; null texts count as empty."""
    return bpe.round_trip(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("tokens", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
