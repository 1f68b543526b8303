import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.constants import CONNECTION_MESSAGE, GUARDRAIL_MESSAGE
from riskflow.functions.text import fixed, passes_guardrail, strip, violations
from riskflow.operators import narrative, policy
from riskflow.plans import testdata
from riskflow.session import scratch_dir
from riskflow.sources import audit_log, tables
from riskflow.streaming.audit import append_stream, audit_stream

RESULTS = "txn_id long, narrative string, latency_ms long, error string"


def test_fixed_decimals_equal_python(spark):
    values = [0.125, 0.375, 2.675, -0.001, 12345.675, 0.0, 1e7, 0.005, 1.005, -2.5, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 3):
        got = {r[0]: r[1] for r in df.select("v", fixed(F.col("v"), digits)).collect()}
        assert got == {v: f"{v:.{digits}f}" for v in values}


def test_strip_equals_python(spark):
    texts = ["  a b\n", "\t\r\n x 　", "", " ", "\x1fq\x85", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in df.select("t", strip(F.col("t"))).collect()} == {t: t.strip() for t in texts}


def test_guardrail_terms(spark):
    texts = ["Resource Allocation", "new DEVICE", "cross-border", "clean", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    got = {r[0]: (r[1], r[2], r[3]) for r in df.select("t", passes_guardrail(t), violations(t), passes_guardrail(t, word_boundary=True)).collect()}
    assert got == {
        "Resource Allocation": (False, ["location"], True),
        "new DEVICE": (False, ["device"], False),
        "cross-border": (False, ["cross-border"], False),
        "clean": (True, [], True),
        None: (None, [], None),
    }


def test_results_are_checked_and_replaced(spark):
    rows = [(1, " fine \n", 10, None), (2, "by country", 20, None), (3, None, 11, "refused"), (4, None, 5, None)]
    got = {r["txn_id"]: r for r in narrative.guardrail_check(spark.createDataFrame(rows, RESULTS)).collect()}
    assert (got[1]["narrative"], got[1]["guardrail_passed"]) == ("fine", True)
    assert (got[2]["narrative"], got[2]["guardrail_passed"], got[2]["violations"]) == (GUARDRAIL_MESSAGE, False, ["country"])
    assert (got[3]["narrative"], got[3]["guardrail_passed"], got[3]["violations"]) == (CONNECTION_MESSAGE, False, [])
    assert (got[4]["narrative"], got[4]["guardrail_passed"]) == ("", True)


def test_prompt_text(spark):
    rows = [(1, 0.125, 1, [("amount", 0.125, 10.0), ("hour", -0.5, 3.0)])]
    prompt = narrative.render_prompts(spark.createDataFrame(rows, schemas.EXPLANATION)).first()["prompt"]
    lines = prompt.split("\n")
    assert lines[0] == "" and lines[-1] == "    "
    assert "    Decision: DECLINE" in lines and "    Risk Score: 0.12" in lines
    at = lines.index("    - amount: actual value is 10.00 (SHAP Risk Impact: 0.12)")
    assert lines[at + 1] == "- hour: actual value is 3.00 (SHAP Risk Impact: -0.50)"
    assert lines[at - 1] == "    Top Risk Drivers (Features pushing the score higher):"


def audit_rows(spark):
    scored = spark.createDataFrame([(1, 0.9), (2, 0.01), (3, 0.5)], "txn_id long, score double")
    results = [(1, "fine", 40, None), (2, "by country", 20, None), (3, None, 11, "refused"), (1, "fine", 60, None)]
    checked = narrative.guardrail_check(spark.createDataFrame(results, RESULTS))
    return narrative.audit_records(policy.apply_policy(scored), checked)


def test_telemetry_keeps_failed_calls_apart(spark):
    got = narrative.audit_telemetry(audit_rows(spark)).first()
    assert (got["generations"], got["errors"], got["passed"], got["guardrail_failures"]) == (4, 1, 2, 1)
    assert got["pass_rate_pct"] == pytest.approx(200 / 3)
    assert (got["avg_latency_ms"], got["min_latency_ms"], got["max_latency_ms"]) == (40.0, 20, 60)


def test_narrative_of_an_unknown_transaction_is_logged(spark):
    scored = spark.createDataFrame([(1, 0.9)], "txn_id long, score double")
    checked = narrative.guardrail_check(spark.createDataFrame([(5, "fine", 40, None)], RESULTS))
    row = narrative.audit_records(policy.apply_policy(scored), checked).first()
    assert (row["transaction_index"], row["risk_score"], row["decision"]) == (5, None, None)


def test_audit_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    audit_log.append_audit(audit_rows(spark), path)
    audit_log.append_audit(audit_rows(spark), path, F.lit(datetime(2024, 1, 2, 3)).cast("timestamp"))
    logged = audit_log.read_audit(spark, path)
    assert logged.columns == [*schemas.AUDIT.names, "log_date"]
    assert logged.count() == 8 and logged.filter("log_date = date'2024-01-02'").count() == 4
    line = json.loads(next(next(tmp_path.glob("log/log_date=2024-01-02")).glob("part-*")).read_text().splitlines()[0])
    assert set(line) == set(schemas.AUDIT.names)


def test_stream_equals_batch_and_takes_each_row_once(spark, tmp_path):
    source, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    for _ in range(2):
        audit_log.append_audit(audit_rows(spark), source)
        append_stream(audit_stream(spark, source, 1), target, state, "log_date").awaitTermination()
    batch = audit_log.read_audit(spark, source)
    stored = tables.read_parquet(spark, target).select(batch.columns)
    assert stored.count() == 8
    assert stored.exceptAll(batch).count() == 0 and batch.exceptAll(stored).count() == 0


# -- files ---------------------------------------------------------------------------------


def test_csv_keeps_broken_lines_for_the_report(spark, tmp_path):
    path = tmp_path / "raw.csv"
    head = ",".join(schemas.RAW.names)
    path.write_text(f"{head}\n1,DEBIT,2.5,C1,0,0,M1,0,0,0,0\nx,DEBIT,2.5,C1,0,0,M1,0,0,0,0\n")
    df = tables.read_csv(spark, str(path), keep_corrupt=True).cache()
    assert {r["step"] for r in df.collect()} == {1, None}
    from riskflow.operators.quality import dq_report

    counts = {r["check_name"]: r["violations"] for r in dq_report(df).collect()}
    assert counts["corrupt_record"] == 1 and counts["null_step"] == 1
    assert tables.with_txn_id(tables.read_csv(spark, str(path))).select("txn_id").distinct().count() == 2


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("amount,step,note,type\n2.5,7,x,DEBIT\n")
    df = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["double", "bigint", "string", "string"]
    assert df.select("step", "amount").first() == (7, 2.5)
    with pytest.raises(ValueError, match="isFraud"):
        from riskflow.operators.privacy import require_columns

        require_columns(df)


def test_csv_files_with_different_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("step,amount\n7,2.5\n")
    (tmp_path / "b.csv").write_text("amount,step\n2.5,7\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        tables.read_csv(spark, str(tmp_path)).collect()


def test_audit_lines_with_offset_timestamps(spark, tmp_path):
    line = {
        "transaction_index": 1,
        "risk_score": 0.5,
        "decision": "DECLINE",
        "llm_latency_ms": 40,
        "guardrail_passed": True,
        "error": None,
        "model_version": "m",
        "policy_version": "p",
        "prompt_version": "v1.0",
        "timestamp": "2025-03-04T05:06:07.123456+00:00",
    }
    (tmp_path / "log.jsonl").write_text(json.dumps(line) + "\n")
    row = audit_log.read_audit(spark, str(tmp_path / "log.jsonl")).select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "error", "llm_latency_ms"
    ).first()
    assert tuple(row) == ("2025-03-04 05:06:07.123456", None, 40)


def test_parquet_by_day_prunes_folders(spark, small, tmp_path):
    path = str(tmp_path / "t")
    scored = testdata.scored(spark, small)
    tables.write_parquet(scored, path)
    stored = tables.read_parquet(spark, path)
    assert stored.count() == scored.count()
    plan = stored.filter("day >= 26").select("txn_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    files = list((tmp_path / "t").glob("day=*/part-*"))
    assert len(files) == len(list((tmp_path / "t").glob("day=*")))


def test_policy_file_as_written_by_hand(spark, tmp_path):
    path = tmp_path / "policy.json"
    path.write_text(json.dumps(policy.DEFAULT_POLICY, indent=2))
    assert tables.load_policy(spark, str(path)) == policy.DEFAULT_POLICY


def test_explanations_as_one_indented_array(spark, tmp_path):
    path = tmp_path / "explanations.json"
    document = {
        "transaction_index": 5,
        "predicted_risk_score": 0.5,
        "actual_is_fraud_label": 1,
        "top_risk_drivers": [{"feature": "amount", "shap_impact": 0.1, "actual_value": 2.0}],
    }
    path.write_text(json.dumps([document, document], indent=2))
    got = tables.read_json(spark, str(path), schemas.EXPLANATION, multi_line=True).collect()
    assert [r.asDict(recursive=True) for r in got] == [document, document]


def test_bucketed_table_needs_no_exchange_for_account_windows(spark, small):
    from riskflow.operators import features

    processed = features.preprocess(testdata.transactions(spark, small))
    spark.sql("drop table if exists riskflow_bucketed")
    folder = scratch_dir(spark, "bucketed")
    processed.write.mode("overwrite").option("path", folder).bucketBy(4, "account_id").sortBy("account_id", "step", "txn_id").saveAsTable("riskflow_bucketed")
    table = features.behavior_features(spark.table("riskflow_bucketed"))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert table.count() == 1000
    spark.sql("drop table riskflow_bucketed")


def test_scratch_is_below_the_session_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path != scratch_dir(spark, "x")
    if base:
        assert path.startswith(base)
