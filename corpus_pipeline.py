"""A training corpus from the documents table, stage by stage.

quality rules -> line dedup -> near dedup -> benchmark decontamination -> packing. Each
stage reads what the one before it wrote; all but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.decontamination import drop_contaminated
from feedloom.llm.line_templates import drop_repeated_lines
from feedloom.llm.minhash import drop_near_duplicates
from feedloom.llm.packing import pack
from feedloom.llm.quality import apply_rules
from feedloom.workspace import clear, mark, settle, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines above their host's limit."""
    ship(spark)
    return apply_rules(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates; those that had no others leave."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles have a similarity of 0.8 or more."""
    ship(spark)
    return drop_near_duplicates(docs, words=5, percent=80, rows=6, bands=42)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as it is or with other values."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token sequences in batches."""
    ship(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written to the shared folder and read again.

    Once a stage is written, what it and the stage before it had written on the way is deleted.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    begun = mark()
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear(spark, begun, but_last=True)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizers, MinHash components and bucket boundaries are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None
