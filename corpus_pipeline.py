"""The corpus pipeline: from the documents table to packed training sequences.

Each stage calls one operator of ``hourweave.llm`` and takes (spark, docs, sf_dir); its result is written as
Parquet and read back as the next stage's documents.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourweave.llm import decontaminate, line_dedup, packing, quality_classifier, simhash
from hourweave.llm.common import ship, store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    return quality_classifier.stage(spark, docs, sf_dir)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that documents share stay in one of them."""
    ship(spark)
    return line_dedup.stage(spark, docs, sf_dir)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    ship(spark)
    return simhash.stage(spark, docs, sf_dir)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    ship(spark)
    return decontaminate.stage(spark, docs, sf_dir)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    ship(spark)
    return packing.stage(spark, docs, sf_dir)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: the classifier's scores, tokens and fingerprints have no SQL form; tests compare each stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
