"""Corpus pipeline: quality filter, near-copy removal, decontamination, mixing, token files.

Each stage takes the rows that the one before it kept, as written to the shared folder; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm.bm25_leaks import decontaminated
from pitwall.llm.common import save, table
from pitwall.llm.huffman_file import token_files
from pitwall.llm.ngram_join import without_near_copies
from pitwall.llm.pareto_mix import mix
from pitwall.llm.quality_rank import accepted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from all labels, accepts."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of their five-word shingles."""
    return without_near_copies(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to target weights takes it."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as Huffman-coded token files, read back: a row for each document in them."""
    return token_files(docs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: The first stage trains a model and the last one writes token files: no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
