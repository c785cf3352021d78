"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept, as written and read again, and all
but the last return documents with the same columns. Part of the llm subpackage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trafficloom.llm import language, mixing, neardup, packing, quality
from trafficloom.llm.common import shipped, stored, table


@shipped
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text is in no language that the labels name."""
    return language.accepted(docs)


@shipped
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail a rule of the current policy."""
    return quality.kept(docs)


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at 0.8."""
    return neardup.deduplicated(docs, shingle=5, percent=80)


@shipped
def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's rate asks for."""
    return mixing.mixed(docs)


@shipped
def pattern_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all copies into sequences; one row per piece."""
    return packing.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("target_mix", target_mix),
    ("pattern_packing", pattern_packing),
]

#: The stages' signatures, fits and tokens have no counterpart in SQL; tests/llm holds
#: the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
