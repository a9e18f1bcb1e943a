"""The corpus pipeline: quality rules, line de-duplication, near-duplicates,
benchmark decontamination, packing. Each stage works on all rows that the one
before it kept, and is written as Parquet in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm.common import read, stage
from gaugeflow.llm.decontam import keep_clean
from gaugeflow.llm.linededup import without_boilerplate
from gaugeflow.llm.packing import pack
from gaugeflow.llm.quality import keep_good
from gaugeflow.llm.simhash import one_per_group


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their site's boilerplate lines."""
    return without_boilerplate(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return one_per_group(docs, shingle=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return keep_clean(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-budget batches of the documents, by length bucket."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# SimHash and the bucket search are beyond SQL; tests hold each stage against
# a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
