"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas
from riskflow.constants import POLICY_THRESHOLD, POS_WEIGHT
from riskflow.functions.timeparts import moment_of
from riskflow.operators import economics, explain, features, model, narrative, policy, privacy
from riskflow.operators import quality, ranking, shapley, split
from riskflow.plans import testdata
from riskflow.session import scratch_dir
from riskflow.sources import audit_log, models, tables
from riskflow.streaming import audit as audit_streaming
from riskflow.streaming import once as once_streaming
from riskflow.streaming import scoring as scoring_streaming

Query = Callable[[SparkSession, str], DataFrame]

class ModelRun(NamedTuple):
    trained: model.Trained
    model_path: str
    features: str
    scored: str


_QUERIES: dict[str, Query] = {}
_MODELS: dict[tuple[str, str], ModelRun] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _r6(column: str) -> Column:
    """Six decimals: engines may differ in the last bits of a floating-point mean."""
    return (F.round(column, 6) + F.lit(0.0)).alias(column)


def _test_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.time_split(testdata.scored(spark, sf_dir))[2]


# -- sources and sinks ---------------------------------------------------------------------


@query
def src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    raw = testdata.transactions(spark, sf_dir).select(*schemas.RAW_WITH_ID.names)
    raw.write.option("header", True).csv(path)
    return tables.read_csv(spark, path, schemas.RAW_WITH_ID)


@query
def src_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    timed = features.add_time_features(testdata.transactions(spark, sf_dir))
    tables.write_parquet(timed, path)
    return tables.read_parquet(spark, path)


@query
def test_window_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    tables.write_parquet(testdata.scored(spark, sf_dir), path)
    test_days = split.time_split(tables.read_parquet(spark, path))[2]
    return test_days.select("txn_id", "day", "amount", "score")


@query
def sweep_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "sweep")
    sweep = economics.threshold_sweep(_test_days(spark, sf_dir))
    tables.write_report_csv(sweep.orderBy("threshold"), path)
    return _rounded_sweep(tables.read_csv(spark, path, sweep.schema))


@query
def explanations_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "explanations")
    tables.write_json(explain.explanations(testdata.contributions(spark, sf_dir)), path)
    return _flat_explanations(tables.read_json(spark, path, schemas.EXPLANATION))


@query
def stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stage_report(
        features.preprocess(testdata.transactions(spark, sf_dir)), "processed"
    )


# -- validation ------------------------------------------------------------------------------


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_report(testdata.transactions(spark, sf_dir))


@query
def column_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns a table needs and has; here one is missing, and one is null throughout."""
    tx = testdata.transactions(spark, sf_dir).drop("nameDest").withColumn("type", F.lit(None).cast("string"))
    return privacy.column_report(tx)


@query
def dq_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_report(testdata.dirty(spark, sf_dir))


def _dirty_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "dirty")
    testdata.dirty_text(spark, sf_dir).write.option("header", True).csv(path)
    return path


@query
def type_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a file, read as text, that do not fit the declared type of their column."""
    text = tables.read_csv(spark, _dirty_csv(spark, sf_dir), T.StructType([]))
    return quality.failed_casts(text, schemas.RAW_WITH_ID)


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a file that ingestion sets apart, and why."""
    text = tables.read_csv(spark, _dirty_csv(spark, sf_dir), T.StructType([]), keep_corrupt=True)
    bad = quality.with_misfits(text).where(F.size("misfits") > 0)
    return bad.select(F.col("txn_id").cast("long").alias("txn_id"), F.array_join(F.array_sort("misfits"), ",").alias("misfits"))


@query
def split_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_sanity(testdata.scored(spark, sf_dir)).withColumn(
        "fraud_rate_pct", F.round("fraud_rate_pct", 6)
    )


# -- preprocessing and features ------------------------------------------------------------------


@query
def preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = features.preprocess(testdata.transactions(spark, sf_dir))
    return processed.withColumns(
        {c: _r6(c) for c in ("avg_amount_24h", "amount_deviation")}
    )


@query
def hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = testdata.transactions(spark, sf_dir).select("txn_id", "nameOrig", "nameDest")
    return privacy.hash_identifiers(tx)


@query
def identifier_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.identifier_map(testdata.transactions(spark, sf_dir))


@query
def identifier_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = testdata.transactions(spark, sf_dir).select("txn_id", "nameOrig", "nameDest")
    return privacy.join_identifiers(tx, privacy.identifier_map(tx))


@query
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = testdata.transactions(spark, sf_dir).select("txn_id", "step")
    return features.add_time_features(tx)


@query
def one_hot_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.one_hot_types(testdata.transactions(spark, sf_dir).select("txn_id", "type"))


def _rolled(spark: SparkSession, sf_dir: str, frame: str) -> DataFrame:
    tx = testdata.transactions(spark, sf_dir).select("txn_id", "nameOrig", "step", "amount")
    return features.rolling_features(tx, "nameOrig", frame).select(
        "txn_id", "txn_count_24h", _r6("avg_amount_24h"), _r6("amount_deviation")
    )


@query
def rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(spark, sf_dir, "rows")


@query
def rolling_features_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(spark, sf_dir, "hours")


@query
def behavior_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = features.feature_table(testdata.transactions(spark, sf_dir))
    return table.select(
        "txn_id",
        "time_since_last_txn_hr",
        (F.round(F.col("amount_ratio_24h").cast("double"), 4)).alias("amount_ratio_24h"),
        "is_transfer",
        "is_cash_out",
    )


@query
def sequence_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged route: processed table first, behaviour features on top of it."""
    processed = features.preprocess(testdata.transactions(spark, sf_dir))
    return features.behavior_features(processed).select(
        "txn_id", "account_id", "step", "transfer_in_last_6h", "transfer_then_cashout_6h"
    )


#: Splits the large accounts of the skewed tables at any scale of the test data.
_SKEW_ROWS = 400


def _skewed(spark: SparkSession, sf_dir: str, frame: str) -> DataFrame:
    tx = testdata.skewed(spark, sf_dir)
    rolled = features.rolling_features(
        tx.select("txn_id", "nameOrig", "step", "amount"), "nameOrig", frame, hot_rows=_SKEW_ROWS
    )
    return rolled.select("txn_id", "txn_count_24h", _r6("avg_amount_24h"), _r6("amount_deviation"))


@query
def rolling_features_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _skewed(spark, sf_dir, "rows")


@query
def rolling_features_hours_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _skewed(spark, sf_dir, "hours")


@query
def sequence_features_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recency with gaps beyond its cap, and the sequence, by the route of hot accounts."""
    table = features.feature_table(testdata.skewed(spark, sf_dir), hot_rows=_SKEW_ROWS)
    return table.select(
        "txn_id", "step", "time_since_last_txn_hr", "transfer_in_last_6h", "transfer_then_cashout_6h"
    )


@query
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = features.feature_table(testdata.transactions(spark, sf_dir))
    return split.feature_matrix(table).withColumns(
        {
            "avg_amount_24h": _r6("avg_amount_24h"),
            "amount_deviation": _r6("amount_deviation"),
            "amount_ratio_24h": F.round(F.col("amount_ratio_24h").cast("double"), 4),
        }
    )


@query
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.add_split(testdata.scored(spark, sf_dir)).select("txn_id", "day", "split")


# -- aggregates -----------------------------------------------------------------------------------


@query
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train_days = split.time_split(testdata.scored(spark, sf_dir))[0]
    return split.class_balance(train_days).withColumn("neg_per_pos", F.round("neg_per_pos", 6))


@query
def avg_fraud_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return economics.avg_fraud_loss(_test_days(spark, sf_dir)).select(_r6("avg_fraud_loss"))


@query
def threshold_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = economics.threshold_confusion(testdata.scored(spark, sf_dir))
    return counts.select("threshold", "tp", "fp", "tn", "fn")


def _rounded_sweep(sweep: DataFrame) -> DataFrame:
    same = ("threshold", "good_users_blocked")
    return sweep.select(
        *(c if c in same else (F.round(c, 4) + F.lit(0.0)).alias(c) for c in economics.SWEEP_COLUMNS)
    )


@query
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_sweep(economics.threshold_sweep(_test_days(spark, sf_dir)))


@query
def optimal_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = economics.threshold_sweep(_test_days(spark, sf_dir))
    return _rounded_sweep(economics.optimal_threshold(sweep))


@query
def top5_thresholds_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = economics.threshold_sweep(_test_days(spark, sf_dir))
    return _rounded_sweep(economics.top_thresholds(sweep, "net_profit_tx"))


@query
def top5_thresholds_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = economics.threshold_sweep(_test_days(spark, sf_dir))
    return _rounded_sweep(economics.top_thresholds(sweep, "net_profit_proxy"))


@query
def fp_fn_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return economics.fp_fn_curve(_test_days(spark, sf_dir))


@query
def econ_assumptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = economics.econ_assumptions(_test_days(spark, sf_dir))
    return record.withColumns(
        {"AVG_FRAUD_LOSS": _r6("AVG_FRAUD_LOSS"), "feature_set": F.array_join("feature_set", ",")}
    )


def _ranked(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    rows = split.add_split(testdata.scored(spark, sf_dir)).select("split", "score", "isFraud")
    return ranking.ranking_metrics(rows).select("split", F.round(metric, 9).alias(metric))


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir, "roc_auc")


@query
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir, "average_precision")


# -- decisions ----------------------------------------------------------------------------------------


@query
def policy_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "policy")
    optimum = economics.optimal_threshold(economics.threshold_sweep(_test_days(spark, sf_dir)))
    tables.write_json(policy.freeze_policy(optimum, policy_name="net_value_v1"), path)
    versions = [policy.DEFAULT_POLICY, tables.load_policy(spark, path)]
    decided = policy.compare_policies(testdata.scored(spark, sf_dir), versions)
    return decided.select("txn_id", "score", "policy_version", "threshold", "decision")


@query
def decision_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.decision_report(testdata.scored(spark, sf_dir))


@query
def freeze_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    optimum = economics.optimal_threshold(economics.threshold_sweep(_test_days(spark, sf_dir)))
    return policy.freeze_policy(optimum).select(
        "policy_name",
        "model_artifact",
        "threshold",
        F.col("decision_labels.block").alias("block_label"),
        F.col("decision_labels.allow").alias("allow_label"),
        "notes",
    )


@query
def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.contributions(spark, sf_dir)
    ranked = rows.withColumn("drivers", explain.ranked_drivers(F.col("drivers")))
    entries = policy.inference_log(ranked, review_band=0.04)
    return entries.withColumns(
        {
            "top_features": F.array_join("top_features", ","),
            "timestamp": F.col("timestamp").isNotNull(),
        }
    )


INSIGHT_WAIT = "30 seconds"


def _inferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.contributions(spark, sf_dir)
    return rows.select(
        "txn_id",
        moment_of(F.col("step")).alias("timestamp"),
        "score",
        explain.ranked_drivers(F.col("drivers")).alias("drivers"),
    )


def _flat_log(entries: DataFrame) -> DataFrame:
    return entries.withColumns(
        {"top_features": F.array_join("top_features", ","), "timestamp": F.unix_seconds("timestamp")}
    )


@query
def inference_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = scoring_streaming.insights(
        testdata.insight_results(spark, sf_dir), terms=testdata.NARRATIVE_TERMS
    )
    return _flat_log(
        scoring_streaming.with_insights(_inferences(spark, sf_dir), flags, wait=INSIGHT_WAIT)
    )


def _closed(session: SparkSession, rows: DataFrame, purpose: str, at: str, end: object) -> str:
    """A folder of files with the rows twice over, as replayed files have them, and a heartbeat."""
    path = scratch_dir(session, purpose)
    rows.write.parquet(path, compression="zstd")
    # The second copy is read from the first: rows are joined, and their texts exchanged, once.
    session.read.schema(rows.schema).parquet(path).write.mode("append").parquet(path, compression="zstd")
    once_streaming.heartbeat(session, rows.schema, {at: end}).write.mode("append").parquet(path)
    return path


@query
def inference_insights_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log from two streams whose files arrive twice."""
    partitions = once_streaming.state_partitions(_inferences(spark, sf_dir), testdata.narratives(spark, sf_dir))
    session = once_streaming.stream_session(spark, partitions)
    asked = _inferences(session, sf_dir)
    results = testdata.insight_results(session, sf_dir)
    end = datetime(2100, 1, 1)
    asked_path = _closed(session, asked, "inferences-in", "timestamp", end)
    results_path = _closed(session, results, "results-in", "insight_at", end)
    flags = scoring_streaming.insights(
        scoring_streaming.arriving(session, results_path, results.schema),
        terms=testdata.NARRATIVE_TERMS,
    )
    entries = scoring_streaming.with_insights(
        scoring_streaming.arriving(session, asked_path, asked.schema), flags, wait=INSIGHT_WAIT
    )
    target = scratch_dir(spark, "inferences")
    audit_streaming.append_stream(
        entries, target, scratch_dir(spark, "inferences-state")
    ).awaitTermination()
    return _flat_log(tables.read_parquet(spark, target))


# -- explanations ---------------------------------------------------------------------------------------


@query
def top_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.top_risk(_test_days(spark, sf_dir)).select("txn_id", "score", "isFraud")


@query
def explain_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.explain_sample(_test_days(spark, sf_dir)).select("txn_id", "score")


@query
def top_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drivers of the declined rows, all of them, by lookup in the contribution table."""
    declined = explain.explain_scope(testdata.scored(spark, sf_dir), "declined", POLICY_THRESHOLD)
    found = explain.lookup(declined, testdata.contributions(spark, sf_dir))
    return explain.top_drivers(found)


def _flat_explanations(explained: DataFrame) -> DataFrame:
    return explained.select(
        "transaction_index",
        "predicted_risk_score",
        "actual_is_fraud_label",
        F.posexplode("top_risk_drivers").alias("position", "d"),
    ).select(
        "transaction_index", "predicted_risk_score", "actual_is_fraud_label", "position", "d.*"
    )


@query
def explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = explain.top_risk(_test_days(spark, sf_dir))
    found = explain.lookup(queue, testdata.contributions(spark, sf_dir))
    return _flat_explanations(explain.explanations(found))


@query
def global_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = explain.global_importance(testdata.contributions(spark, sf_dir))
    return ranked.select("feature", F.round("mean_abs_shap", 9).alias("mean_abs_shap"))


@query
def riskiest_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_explanations(explain.riskiest(testdata.contributions(spark, sf_dir)))


@query
def driver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.driver_table(explain.explanations(testdata.contributions(spark, sf_dir)))


@query
def queue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = explain.top_risk(_test_days(spark, sf_dir))
    return explain.queue_summary(queue, "score").withColumn(
        "avg_risk_score", F.round("avg_risk_score", 9)
    )


# -- narratives and audit -----------------------------------------------------------------------------------


@query
def render_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    explained = explain.explanations(testdata.contributions(spark, sf_dir))
    return narrative.render_prompts(explained)


@query
def guardrail_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven terms in texts that contain them, and in texts that only come near."""
    checked = narrative.guardrail_check(testdata.guarded_narratives(spark, sf_dir))
    return checked.withColumn("violations", F.array_join("violations", ","))


@query
def guardrail_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = testdata.narratives(spark, sf_dir)
    checked = narrative.guardrail_check(results, testdata.NARRATIVE_TERMS)
    return checked.withColumn("violations", F.array_join("violations", ","))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = policy.apply_policy(testdata.scored(spark, sf_dir))
    checked = narrative.guardrail_check(
        testdata.narratives(spark, sf_dir), testdata.NARRATIVE_TERMS
    )
    return narrative.audit_records(decided, checked)


@query
def audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "audit")
    audit_log.append_audit(_audit(spark, sf_dir), path)
    logged = audit_log.read_audit(spark, path)
    return logged.withColumn("timestamp", F.col("timestamp").isNotNull()).drop("log_date")


@query
def audit_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narrative.audit_telemetry(_audit(spark, sf_dir)).withColumns(
        {c: F.round(c, 6) for c in ("pass_rate_pct", "avg_latency_ms")}
    )


@query
def audit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's files arrive twice; each record is stored once."""
    source, target = scratch_dir(spark, "audit-in"), scratch_dir(spark, "audit-table")
    audit_log.append_audit(_audit(spark, sf_dir), source)
    logged = audit_log.read_audit(spark, source)
    partitions = once_streaming.state_partitions(logged)
    logged.write.json(f"{source}/replayed")
    session = once_streaming.stream_session(spark, partitions)
    arriving = audit_streaming.audit_once(audit_streaming.audit_stream(session, source))
    audit_streaming.append_stream(
        arriving, target, scratch_dir(spark, "audit-state"), "log_date"
    ).awaitTermination()
    stored = tables.read_parquet(spark, target)
    return stored.withColumn("timestamp", F.col("timestamp").isNotNull()).drop("log_date")


# -- model ---------------------------------------------------------------------------------------------------


def _run(spark: SparkSession, sf_dir: str) -> ModelRun:
    """A model with its stored feature and score tables, once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        table, path, scored = (scratch_dir(spark, p) for p in ("features", "model", "scored"))
        path += "/gbt_v1"
        tables.write_parquet(features.feature_table(testdata.transactions(spark, sf_dir)), table)
        stored = tables.read_parquet(spark, table)
        trained = model.train(stored)
        models.save_model(trained.model, path)
        tables.write_parquet(model.score(trained.model, stored), scored)
        _MODELS[key] = ModelRun(trained, path, table, scored)
    return _MODELS[key]


@query
def model_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    nodes = shapley.tree_nodes(spark, run.trained.model, run.model_path)
    return nodes.groupBy(F.col("treeID").alias("tree")).agg(
        F.count_if(F.col("leftChild") < 0).alias("leaves"),
        F.max("rawCount").alias("training_rows"),
    )


@query
def model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    scored = model.score(models.load_model(run.model_path), tables.read_parquet(spark, run.features))
    return scored.select("txn_id", "day", "isFraud", "score")


@query
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    return model.model_metrics(run.trained, tables.read_parquet(spark, run.scored))


@query
def model_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run(spark, sf_dir)
    test_days = split.time_split(tables.read_parquet(spark, run.scored))[2]
    chosen = explain.explain_sample(test_days)
    explained = shapley.contributions(run.trained.model, chosen, run.model_path)
    return explained.select("txn_id", "score", "base_value", F.inline("drivers"))


def _frozen(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, str, DataFrame]:
    """The frozen model, read from its JSON file and saved again, and the scores it gives."""
    document, path = (scratch_dir(spark, p) for p in ("portable", "model"))
    tables.write_json(testdata.frozen_document(spark), document)
    models.save_model(models.read_portable(spark, document), path)
    loaded = models.load_model(path)
    return loaded, path, model.score(loaded, testdata.gappy_features(spark, sf_dir))


@query
def frozen_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _frozen(spark, sf_dir)[2]
    return scored.select("txn_id", "day", "isFraud", F.round("score", 9).alias("score"))


def _frozen_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all rows of the test days, so that the rows do not depend on a queue."""
    loaded, path, scored = _frozen(spark, sf_dir)
    rows = shapley.contributions(loaded, split.time_split(scored)[2], path)
    # Contributions of different engines agree up to their last bits; ranks need more than that.
    rounded = F.transform(
        "drivers",
        lambda d: F.struct(
            d["feature"].alias("feature"),
            (F.round(d["shap_impact"], 9) + F.lit(0.0)).alias("shap_impact"),
            d["actual_value"].alias("actual_value"),
        ),
    )
    return rows.withColumn("drivers", rounded)


@query
def frozen_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _frozen_contributions(spark, sf_dir)
    return rows.select("txn_id", F.round("base_value", 9).alias("base_value"), F.inline("drivers")).drop("actual_value")


@query
def frozen_top_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five of seventeen drivers; many contribute nothing and tie."""
    return explain.top_drivers(_frozen_contributions(spark, sf_dir)).drop("actual_value")


@query
def frozen_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = explain.global_importance(_frozen_contributions(spark, sf_dir))
    return ranked.select("feature", F.round("mean_abs_shap", 9).alias("mean_abs_shap"))


@query
def frozen_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics record of the frozen model, which counts as trained elsewhere."""
    loaded, _, scored = _frozen(spark, sf_dir)
    trees = loaded.stages[-1].getNumTrees
    record = model.model_metrics(model.Trained(loaded, trees - 1, POS_WEIGHT), scored)
    ranks = ("val_auc_roc", "val_auc_pr", "test_auc_roc", "test_auc_pr")
    return record.withColumns({c: F.round(c, 9) for c in ranks})


@query
def scoring_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature rows and the generator's results as two streams whose files arrive twice."""
    run = _run(spark, sf_dir)
    partitions = once_streaming.state_partitions(
        tables.read_parquet(spark, run.features), testdata.narratives(spark, sf_dir)
    )
    session = once_streaming.stream_session(spark, partitions)
    rows = tables.read_parquet(session, run.features)
    results = testdata.insight_results(session, sf_dir)
    last_step = 24 * 365 * 50  # of the heartbeat
    source = _closed(session, rows, "features-in", "step", last_step)
    results_path = _closed(session, results, "results-in", "insight_at", datetime(2100, 1, 1))
    entries = scoring_streaming.scoring_stream(
        session,
        source,
        rows.schema,
        run.trained.model,
        model_artifact=run.model_path,
        results=scoring_streaming.arriving(session, results_path, results.schema),
        wait=INSIGHT_WAIT,
    )
    target = scratch_dir(spark, "inference")
    audit_streaming.append_stream(
        entries, target, scratch_dir(spark, "inference-state")
    ).awaitTermination()
    return tables.read_parquet(spark, target)
