"""From documents to training tokens: quality, near-duplicates, benchmark passages, source mix, token records.

Every stage keeps null and empty texts, null ids and sources, ties, repeated rows and extra columns of any name, as its operator's module
states; an empty table gives empty stages. Null and empty texts are one group of near-duplicates, so one of them stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliospark.llm.common import load, materialise
from foliospark.llm.decontaminate import drop_contaminated
from foliospark.llm.mixing import training_order
from foliospark.llm.quality import keep_good, trained
from foliospark.llm.simhash import drop_near_duplicates
from foliospark.llm.tokens import WINDOWS, token_shards


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-level field, trained on the labels, does not reject."""
    return keep_good(docs, trained(spark, docs, load(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of like shingle sets: that with the smallest doc_id."""
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, in the order of the curriculum."""
    return training_order(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fixed-stride token records, written as shards and read back. Slots are permuted within windows of the run, so the curriculum's order stays."""
    return token_shards(docs, windows=WINDOWS)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: Neither a trained field nor a byte-pair encoding can be written in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each stage's result is written and read again as the next one's input."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
