"""Documents to packed training sequences: quality rules, line dedup, near-dedup, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillhouse.llm.common import documents, drop_scratch, scratch_paths, stored
from tillhouse.llm.linededup import dedup_passages
from tillhouse.llm.mixing import mixed_documents
from tillhouse.llm.packing import pack
from tillhouse.llm.quality import kept_documents
from tillhouse.llm.simhash import one_per_group


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go."""
    return kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the multi-line chunks, and passages of over 50 words, that stand in an earlier document or place."""
    return dedup_passages(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix uses it."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequences and offsets."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Robust estimates, fingerprint groups and tokenization have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written to the shared folder and read again by the next.

    Once a stage's result is complete, its input and what it stored on the way are deleted.
    """
    docs = documents(spark, sf_dir)
    start = len(scratch_paths())
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_scratch(spark, scratch_paths()[start:-1])
        start = len(scratch_paths()) - 1
    return STAGES[-1][1](spark, docs, sf_dir)
