"""From a raw CSV file to the audit log, in the order a user would run the steps."""

from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.functions.timeparts import moment_of
from riskflow.operators import narrative
from riskflow.plans import pipeline, testdata
from riskflow.sources import audit_log, tables


def test_raw_file_to_audit_log(spark, tmp_path):
    root, raw = str(tmp_path / "run"), str(tmp_path / "raw")
    source = testdata.transactions(spark, "/root/testdata/sf0.01").select(*schemas.RAW.names)
    text = source.select(*(F.col(c).cast("string") for c in source.columns))
    broken = text.limit(3).withColumn("step", F.lit("x"))
    text.union(broken).write.option("header", True).csv(raw)

    stored = pipeline.ingest_csv(spark, raw, root)
    assert stored.count() == stored.select("txn_id").distinct().count() == 10000
    at = pipeline.Layout(root)
    assert spark.read.json(at.ingest_metrics).first()["quarantined"] == 3
    bad = spark.read.parquet(at.quarantine)
    assert {(r["misfits"][0], r["_corrupt_record"].split(",")[0]) for r in bad.collect()} == {("step", "x")}

    table = pipeline.build_features(spark, root)
    assert table.count() == 10000 and "nameOrig" not in table.columns

    trained = pipeline.train_and_score(spark, root, max_trees=3, max_depth=3, early_stop=None)
    metrics = spark.read.json(at.metrics).first()
    assert metrics["n_test"] == 1335 and metrics["best_iteration"] == trained.best_iteration == 2

    chosen = pipeline.choose_policy(spark, root, margin_rate=0.03)
    assert set(chosen) == set(schemas.POLICY.names) and 0.01 <= chosen["threshold"] <= 0.99
    assert spark.read.json(at.assumptions).first()["MARGIN_RATE"] == 0.03
    for report in (at.top_tx, at.top_proxy):
        assert spark.read.option("header", True).csv(report).count() == 5

    scores = tables.read_parquet(spark, at.scored).filter("day >= 26")
    assert set(scores.columns) == {"txn_id", "day", "amount", "isFraud", "score"}
    middle = scores.approxQuantile("score", [0.5], 0.0)[0]
    declined = pipeline.explain_queue(spark, root, {**chosen, "threshold": middle}, "declined")
    assert declined.count() == scores.filter(F.col("score") >= middle).count() > 200

    importance = spark.read.json(at.importance).orderBy("feature").collect()
    documents = pipeline.explain_queue(spark, root, chosen)
    assert spark.read.json(at.importance).orderBy("feature").collect() == importance
    assert documents.count() == 200
    assert documents.filter(F.size("top_risk_drivers") != 5).count() == 0

    prompts = spark.read.json(at.prompts)
    results = prompts.select(
        F.col("transaction_index").alias("txn_id"),
        F.lit(" An objective summary. ").alias("narrative"),
        F.lit(12).cast("long").alias("latency_ms"),
        F.lit(None).cast("string").alias("error"),
    )
    checked = pipeline.log_narratives(spark, root, chosen, results)
    assert {r[0] for r in checked.select("narrative").distinct().collect()} == {"An objective summary."}
    telemetry = narrative.audit_telemetry(audit_log.read_audit(spark, at.audit)).first()
    assert telemetry["generations"] == prompts.count() and telemetry["pass_rate_pct"] == 100.0
    assert telemetry["model_version"] == "gbt_v1"

    timed = results.join(tables.read_parquet(spark, at.features).select("txn_id", "step"), "txn_id").select(
        "txn_id", "narrative", "latency_ms", "error", moment_of(F.col("step")).alias("insight_at")
    )
    entries = pipeline.log_inferences(spark, root, chosen, timed)
    assert entries.count() == entries.select("request_id").distinct().count() == 10000
    assert entries.where("insight_generated and insight_valid").count() == 200
    assert entries.where("size(top_features) <> 5").count() == 0
