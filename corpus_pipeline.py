"""A training corpus from ``documents``: five stages, each written and read again by the next.

All stages but the last return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontamination, jaccard_join, packing, quality_rules, substrings
from tablewright.llm.common import ship, table, written

#: Near duplicates here share four fifths of their shingles of five words.
WORDS, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and lines that more than 20 distinct texts of a host share."""
    ship(spark)
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    ship(spark)
    return jaccard_join.deduplicated(docs, percent=PERCENT, words=WORDS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, or of 400 bytes where words are longer, that occur again are cut out of the texts."""
    ship(spark)
    return substrings.removed(docs, (substrings.BYTES, substrings.WORDS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of what is left."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark", benchmark),
    ("packing", pack),
]

#: The last stage cuts tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
