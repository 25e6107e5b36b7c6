"""The registered queries of the operators, over whole tables, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import (
    decontamination,
    importance,
    jaccard_join,
    line_dedup,
    merkle,
    packing,
    quality_rules,
    spelling,
    sql,
    substrings,
    toxicity,
    transcripts,
    url_filter,
    warc,
)
from tablewright.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.deduplicated(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("lost_share")


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.recovered(table(spark, sf_dir, "conversations"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.report(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc_revisits,
        op2_quality_rules,
        op3_importance_resampling,
        op4_transcripts,
        op5_url_filter,
        op6_decontamination,
        op7_repeated_passages,
        op8_toxicity,
        op9_jaccard_join,
        op10_packing,
        op11_line_dedup,
        op12_spelling_variants,
        op13_merkle_manifest,
    )
}
SQL: dict[str, str] = sql.SQL
