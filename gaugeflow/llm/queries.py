"""The registered queries of the corpus operators, one per operator, each over
its whole table. ``QUERIES`` maps a name to the plan, ``ORACLES`` to the DuckDB
statement with the same rows where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.chat import ORACLE_SQL as CHAT_SQL
from gaugeflow.llm.common import read
from gaugeflow.llm.decontam import ORACLE_SQL as WINNOW_SQL
from gaugeflow.llm.interactions import ORACLE_SQL as AUDIT_SQL
from gaugeflow.llm.linededup import ORACLE_SQL as LINE_SQL
from gaugeflow.llm.merkle import ORACLE_SQL as MERKLE_SQL
from gaugeflow.llm.quality import oracle_sql as quality_sql
from gaugeflow.llm.warc import ORACLE_SQL as WARC_SQL


def op1_unigram_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.langid import identify

    return identify(read(spark, sf_dir, "documents"))


def op2_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.decontam import decontaminate

    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("mark")


def op3_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.warc import capture_index

    return capture_index(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.linededup import line_dedup

    return line_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op5_suffix_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.suffix import remove_repeats

    return remove_repeats(read(spark, sf_dir, "documents"), with_bytes=False).drop("kept")


def op6_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.packing import pack

    return pack(read(spark, sf_dir, "documents"))


def op7_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.chat import digests, format_chats

    chats = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "'</s>[INST] ok [/INST]'"
    hard = spark.range(1).selectExpr(
        f"stack(2, -7L, 0L, 'user', {said}, -7L, 1L, 'assistant', {said}) AS (conv_id, turn, role, text)")
    return digests(format_chats(chats.unionByName(hard)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.quality import quality_rules

    return quality_rules(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.simhash import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op10_min_cut_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.html import extract

    return extract(read(spark, sf_dir, "pages"))


def op11_min_cost_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.resharding import shard_table

    return shard_table(read(spark, sf_dir, "documents"))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.interactions import interaction_audit

    return interaction_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gaugeflow.llm.merkle import dataset_manifest

    return dataset_manifest(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_unigram_language_id": op1_unigram_language_id,
    "op2_winnowing_decontamination": op2_winnowing_decontamination,
    "op3_warc_index_merge": op3_warc_index_merge,
    "op4_site_line_dedup": op4_site_line_dedup,
    "op5_suffix_index_dedup": op5_suffix_index_dedup,
    "op6_length_bucket_packing": op6_length_bucket_packing,
    "op7_chat_round_trip": op7_chat_round_trip,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_min_cut_extraction": op10_min_cut_extraction,
    "op11_min_cost_resharding": op11_min_cost_resharding,
    "op12_filter_interaction_audit": op12_filter_interaction_audit,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {
    "op2_winnowing_decontamination": WINNOW_SQL,
    "op3_warc_index_merge": WARC_SQL,
    "op4_site_line_dedup": LINE_SQL,
    "op7_chat_round_trip": CHAT_SQL,
    "op8_quality_rules": quality_sql(),
    "op12_filter_interaction_audit": AUDIT_SQL,
    "op13_merkle_manifest": MERKLE_SQL,
}
