"""The whole route from a raw file to explained, decided and logged transactions.

Each step reads the stored output of the one before and writes its own below ``root``, so a
step can be repeated alone and nothing depends on the life of a session.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas
from riskflow.constants import DEFAULT_SALT, POLICY_NAME
from riskflow.operators import economics, explain, features, model, narrative, policy, quality
from riskflow.operators import shapley, split
from riskflow.operators.prefilter import keep_possible
from riskflow.sources import audit_log, models, tables
from riskflow.streaming import scoring as scoring_streaming


class Layout:
    """Where the stages keep their tables."""

    def __init__(self, root: str):
        root = root.rstrip("/")
        self.ingested = f"{root}/ingested"
        self.transactions = f"{self.ingested}/quarantined=false"
        self.quarantine = f"{self.ingested}/quarantined=true"
        self.ingest_metrics = f"{root}/reports/ingest"
        self.quality = f"{root}/reports/quality"
        self.features = f"{root}/features"
        self.split_sanity = f"{root}/reports/split_sanity"
        self.model = f"{root}/models/gbt_v1"
        self.metrics = f"{root}/metrics/model"
        self.scored = f"{root}/scored"
        self.sweep = f"{root}/metrics/sweep"
        self.top_tx = f"{root}/metrics/top5_tx"
        self.top_proxy = f"{root}/metrics/top5_proxy"
        self.assumptions = f"{root}/metrics/assumptions"
        self.policy = f"{root}/policies/{POLICY_NAME}"
        self.contributions = f"{root}/contributions"
        self.importance = f"{root}/explainability/importance"
        self.explanations = f"{root}/explainability/explanations"
        self.prompts = f"{root}/prompts"
        self.audit = f"{root}/audit"
        self.inferences = f"{root}/inferences"


def ingest_csv(spark: SparkSession, csv_path: str, root: str) -> DataFrame:
    """Raw CSV to a numbered transaction table, with its quality report.

    Lines with a field that does not fit its type go to ``Layout.quarantine``, as they are and with
    the names of these fields; the rows that can be used go to ``Layout.transactions``. Both are
    written, and counted for ``Layout.ingest_metrics``, in one pass over the file.
    """
    at = Layout(root)
    text = tables.read_csv(spark, csv_path, T.StructType([]), keep_corrupt=True)
    checked = quality.with_misfits(tables.with_txn_id(text))
    seen = Observation("ingest")
    counted = checked.observe(seen, *quality.ingest_metrics())
    parted = counted.withColumn("quarantined", F.size("misfits") > 0)
    tables.write_parquet(parted, at.ingested, "quarantined", gather=False)
    tables.write_json(spark.createDataFrame([Row(**seen.get)]), at.ingest_metrics)
    everything = spark.read.schema(parted.schema).parquet(at.ingested)
    tables.write_report_csv(quality.dq_report(everything), at.quality)
    return transactions(spark, root)


def transactions(spark: SparkSession, root: str) -> DataFrame:
    """The ingested rows that can be used."""
    ingested = tables.read_parquet(spark, Layout(root).ingested)
    return ingested.where(~F.col("quarantined")).drop(schemas.CORRUPT, "misfits", "quarantined")


def build_features(
    spark: SparkSession, root: str, salt: str = DEFAULT_SALT, frame: str = "rows"
) -> DataFrame:
    """Checked transactions to the feature table, in folders by day."""
    at = Layout(root)
    tx = transactions(spark, root)
    tables.write_parquet(features.feature_table(tx, salt, frame), at.features)
    stored = tables.read_parquet(spark, at.features)
    tables.write_report_csv(split.split_sanity(stored), at.split_sanity)
    return stored


def train_and_score(spark: SparkSession, root: str, **options: Any) -> model.Trained:
    """Model, metrics record and scores of all days, without the features, which later stages look
    up for the few rows they explain; ``options`` go to ``model.train``."""
    at = Layout(root)
    table = tables.read_parquet(spark, at.features)
    trained = model.train(table, **options)
    models.save_model(trained.model, at.model)
    lean = model.score(trained.model, table).select("txn_id", "day", "amount", "isFraud", "score")
    tables.write_parquet(lean, at.scored, gather=False)
    scored = tables.read_parquet(spark, at.scored)
    tables.write_json(model.model_metrics(trained, scored), at.metrics, mode="append")
    return trained


def choose_policy(
    spark: SparkSession, root: str, policy_name: str = POLICY_NAME, **economy: Any
) -> dict[str, Any]:
    """Sweep of the test days, its best rows, the assumptions and the frozen policy."""
    at = Layout(root)
    test_days = split.time_split(tables.read_parquet(spark, at.scored))[2]
    sweep = economics.threshold_sweep(test_days, **economy).orderBy("threshold")
    tables.write_report_csv(sweep, at.sweep)
    stored = tables.read_csv(spark, at.sweep, sweep.schema)
    tables.write_report_csv(economics.top_thresholds(stored, "net_profit_tx"), at.top_tx)
    tables.write_report_csv(economics.top_thresholds(stored, "net_profit_proxy"), at.top_proxy)
    rates = {k: v for k, v in economy.items() if k not in ("thresholds", "avg_fraud_loss")}
    tables.write_json(
        economics.econ_assumptions(test_days, model_artifact=at.model, **rates), at.assumptions
    )
    frozen = policy.freeze_policy(
        economics.optimal_threshold(stored), policy_name=policy_name, model_artifact=at.model
    )
    tables.write_json(frozen, at.policy)
    return tables.load_policy(spark, at.policy)


def explain_queue(
    spark: SparkSession, root: str, chosen: Mapping[str, Any], scope: str = "top_n"
) -> DataFrame:
    """Contributions of the queue and of a fixed sample, the riskiest rows and a random baseline;
    importance over the sample; explanations and prompts of the queue. ``scope="declined"``
    explains every declined row instead of the top few, and leaves the importance as it is."""
    at = Layout(root)
    trained = models.load_model(at.model)
    test_days = split.time_split(tables.read_parquet(spark, at.scored))[2]
    queue = explain.explain_scope(test_days, scope, chosen["threshold"])
    sample = explain.explain_sample(test_days)
    wanted = queue.union(sample).dropDuplicates(["txn_id"]).select("txn_id", "score")
    features_of = split.time_split(tables.read_parquet(spark, at.features))[2]
    rows = keep_possible(features_of, "txn_id", wanted).join(wanted, "txn_id")
    tables.write_parquet(shapley.contributions(trained, rows, at.model), at.contributions, None)
    explained = tables.read_parquet(spark, at.contributions)
    fixed = explain.lookup(sample, explained)
    tables.write_json(explain.global_importance(fixed), at.importance)
    found = explain.lookup(queue, explained)
    tables.write_json(explain.explanations(found), at.explanations)
    documents = tables.read_json(spark, at.explanations, schemas.EXPLANATION)
    tables.write_json(narrative.render_prompts(documents, chosen), at.prompts)
    return documents


def log_narratives(
    spark: SparkSession, root: str, chosen: Mapping[str, Any], results: DataFrame
) -> DataFrame:
    """Check the generator's results (``txn_id``, ``narrative``, ``latency_ms``, ``error``) and
    append their audit records; returns the checked texts."""
    at = Layout(root)
    checked = narrative.guardrail_check(results)
    decided = policy.apply_policy(tables.read_parquet(spark, at.scored), chosen)
    audit_log.append_audit(narrative.audit_records(decided, checked, chosen), at.audit)
    return checked


def log_inferences(
    spark: SparkSession,
    root: str,
    chosen: Mapping[str, Any],
    results: DataFrame,
    wait: str = scoring_streaming.WAIT,
    review_band: float | None = None,
) -> DataFrame:
    """The inference log of all days, in folders by date: score, strongest drivers, action, and
    the flags of the generator's results (as for ``log_narratives``, with ``insight_at``)."""
    at = Layout(root)
    inferences = scoring_streaming.explained(
        tables.read_parquet(spark, at.features), models.load_model(at.model), at.model
    )
    flags = scoring_streaming.insights(results, chosen)
    entries = scoring_streaming.with_insights(inferences, flags, chosen, wait, review_band=review_band)
    dated = entries.withColumn("log_date", F.to_date("timestamp"))
    tables.write_parquet(dated, at.inferences, "log_date")
    return tables.read_parquet(spark, at.inferences)
