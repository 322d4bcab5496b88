"""Corpus pipeline: quality classifier, exact dedup, n-gram Jaccard join,
benchmark decontamination and best-fit packing, in that order.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result
is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import decontam, exact_dedup, jaccard_join, packing, quality
from orderflow.llm.common import bounded_batches, stored, table
from orderflow.llm.queries import vocabulary
from orderflow.session import prepare


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.keep_one(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("decontamination", decontamination_stage),
          ("packing", packing_stage)]

#: Tokenising and model fitting have no SQL form; tests/llm/test_pipeline.py
#: compares all stages together with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    bounded_batches(prepare(spark))
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return stored(STAGES[-1][1](spark, docs, sf_dir), f"stage-{STAGES[-1][0]}")
