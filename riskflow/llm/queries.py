"""Registered queries of the llm operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import common, conversation_repair, decontamination, fingerprints, language_model, line_dedup, mixing, ngram_join, packing
from riskflow.llm import quality, suffix_dedup, token_counts, toxicity, whitening
from riskflow.llm.sql import all_sql  # noqa: F401

#: Token shares of the mix: less English than there is, few poor texts.
MIX_WEIGHTS = {"en": 0.50, "de": 0.18, "fr": 0.17, "es": 0.12, "poor": 0.03}

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(common.read_table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.hit_report(
        common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "benchmark")
    )
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(common.read_table(spark, sf_dir, "documents"), path)


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates, mix, _ = mixing.mixed(
        common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels"), MIX_WEIGHTS
    )
    shares = [F.col("posterior")[i].alias(f"p_{domain}") for i, domain in enumerate(mix.domains)]
    return rates.select("doc_id", "tokens", *shares, "rate")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.chosen_labels(
        common.read_table(spark, sf_dir, "labels"),
        "toxic",
        where=~common.fold(F.col("label_id"), 3, 1),
    )
    lexicon = toxicity.fit(docs, labels)
    scored = toxicity.scores(docs, lexicon)
    return scored.select("doc_id", common.fold(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(common.read_table(spark, sf_dir, "documents"))


@query
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = common.fold(F.col("doc_id"), 7, 2)
    return language_model.score(common.read_table(spark, sf_dir, "documents"), held_out)


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(common.read_table(spark, sf_dir, "documents"), with_text=False).drop("kept")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(
        common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels")
    )


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(common.read_table(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(common.read_table(spark, sf_dir, "conversations"))
    return conversation_repair.report(conversation_repair.repair(damaged))


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = packing.pack(common.read_table(spark, sf_dir, "documents"), path)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(common.read_table(spark, sf_dir, "embeddings"))
