"""Corpus pipeline: toxicity filter, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramloom.llm.common import Scratch, read_table
from tramloom.llm.line_dedup import without_duplicate_lines
from tramloom.llm.mixing import mixed_documents
from tramloom.llm.packing import pack
from tramloom.llm.simhash import keep_one_of_each
from tramloom.llm.toxicity import not_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a model fitted on ``labels``."""
    return not_toxic(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one."""
    return without_duplicate_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose four-word SimHash fingerprints link within four bits."""
    return keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources by weight, with the columns of ``docs``."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in packed sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("packing", packing),
]

#: Models, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table that the next stage reads."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
