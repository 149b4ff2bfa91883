"""Corpus pipeline: quality, toxicity, near-duplicates, mixing and packing, stage by stage.

Every stage is written as Parquet in the shared scratch folder and read again as the
next stage's documents, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import mixing, packing, quality, simhash, toxicity
from threadloom.llm.common import read_table
from threadloom.sources.stages import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_quality(docs, read_table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: three-word shingles, at most two differing bits."""
    return simhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of languages wants them."""
    labelled = mixing.labelled_languages(docs, read_table(spark, sf_dir, "labels"))
    return mixing.mix_documents(docs, labelled, mixing.LANGUAGE_TARGETS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# SQL cannot express the fitted models of these stages; tests/llm/test_pipeline.py works
# the rows of every stage out in plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
