"""From raw documents to token files: quality rules, near-duplicates, decontamination, mixing, token blocks.

Each stage gets what the stage before it kept, read from Parquet, and returns a DataFrame; all but the last return the
columns of ``documents``. Every stage works on all rows of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlake.llm import decontamination, mixing, near_duplicates, quality_rules, token_blocks
from churnlake.llm.common import read_table, staged
from churnlake.llm.queries import tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule; cutoffs are learned from the labelled ones among them."""
    return quality_rules.kept_documents(docs, read_table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that with the smallest id."""
    return near_duplicates.one_of_each(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and for every document of them its place, length and checksum, as read back."""
    return token_blocks.token_table(docs, tokenizer_file())


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", keep_one_copy),
    ("decontamination", keep_clean),
    ("mixing", mix_sources),
    ("token_blocks", write_tokens),
]

#: Signatures and token ids are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
