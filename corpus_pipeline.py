"""The corpus pipeline: quality rules, near-dedup, decontamination, PII
pseudonyms, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, near_dedup, packing, pii
from tessera.llm.common import land, read_table
from tessera.llm.queries import pii_key, vocabulary
from tessera.llm.quality_rules import apply_quality_rules


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their over-frequent lines."""
    return apply_quality_rules(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (similarity 0.8) stays."""
    return near_dedup.deduplicate(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms of the same format."""
    return pii.pseudonymise(docs, pii_key(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, with their token ids."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("pii", pseudonyms),
    ("packing", pack),
]

#: Shingle components, keyed pseudonyms and tokenizer ids have no SQL form;
#: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
