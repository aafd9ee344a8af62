"""Corpus pipeline over ``documents``: quality, toxicity, near-duplicates, mix and
packing. Each stage works on all that its predecessor kept; its result is written
as Parquet to shared storage and read again by the next one.

No stage has a SQL form (models, pseudo-random rounding, a tokenizer), so the
whole is tested against a brute-force version instead of ORACLE_SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import store, table
from strata.llm.jaccard_join import keep_one_of_each
from strata.llm.mixing import mixture
from strata.llm.packing import pack_sequences
from strata.llm.quality import keep_quality
from strata.llm.queries import tokenizer_path
from strata.llm.toxicity import keep_ordinary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores at least 0.3."""
    return keep_quality(docs, table(spark, sf_dir, "labels"), 0.3)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models score below 0.5."""
    return keep_ordinary(docs, table(spark, sf_dir, "labels"), 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each document as often as it is taken."""
    return mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 ids, with the ids."""
    return pack_sequences(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
