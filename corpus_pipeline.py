"""The training-data pipeline: quality rules, line dedup, near dedup, benchmark
decontamination, packing. Each stage's result is written and read again as the next
one's documents; all but the last return the columns of ``documents``.

Nulls, repeated rows, empty tables and extra columns behave as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadkit.llm.common import cut, table
from loadkit.llm.decontaminate import drop_leaks
from loadkit.llm.line_dedup import drop_recurring
from loadkit.llm.packing import pack
from loadkit.llm.quality import quality_filter
from loadkit.llm.simhash import near_dedup


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go."""
    return drop_recurring(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dedup(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces in sequences."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Hashed n-grams, XXH64 fingerprints and token ids have no SQL; tests hold run() against its parts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
