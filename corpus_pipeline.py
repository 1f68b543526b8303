"""Corpus pipeline: quality, line dedup, document dedup, decontamination, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskflow.llm import decontamination, line_dedup, mixing, ngram_join, quality
from riskflow.llm.common import free_name, read_table, stored
from riskflow.llm.queries import MIX_WEIGHTS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Document dedup works on five-word shingles at a similarity of 0.8.
DEDUP_WIDTH, DEDUP_PERCENT = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, DEDUP_WIDTH, DEDUP_PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def with_rates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``rate``, how often a document is to be seen; documents of rate 0 go."""
    name = free_name(docs, "rate")
    rated = mixing.add_rate(docs, read_table(spark, sf_dir, "labels"), name, MIX_WEIGHTS)
    return mixing.wanted(rated, name)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing", with_rates),
]

#: SQL can express neither the trained stages nor, at this size, the joins; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
