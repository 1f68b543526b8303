import pytest
from pyspark.sql import functions as F

from riskflow.operators import explain, policy

SCORED = "txn_id long, score double, isFraud int"
DRIVERS = "txn_id long, score double, isFraud int, drivers array<struct<feature:string,shap_impact:double,actual_value:double>>"


def test_decision_includes_the_threshold_and_needs_a_score(spark):
    df = spark.createDataFrame([(1, 0.09, 0), (2, 0.0899999, 0), (3, None, 0), (4, 0.05, 0)], SCORED)
    got = {r["txn_id"]: r["decision"] for r in policy.apply_policy(df).collect()}
    assert got == {1: "DECLINE", 2: "APPROVE", 3: None, 4: "APPROVE"}
    band = {r["txn_id"]: r["decision"] for r in policy.apply_policy(df, review_band=0.02).collect()}
    assert band == {1: "DECLINE", 2: "REVIEW", 3: None, 4: "APPROVE"}


def test_several_policies_in_one_pass(spark):
    df = spark.createDataFrame([(1, 0.5, 0)], SCORED)
    strict = {**policy.DEFAULT_POLICY, "policy_name": "loose", "threshold": 0.6}
    got = policy.compare_policies(df, [policy.DEFAULT_POLICY, strict])
    assert {r["policy_version"]: r["decision"] for r in got.collect()} == {
        "paysim_behavior_only_v1": "DECLINE",
        "loose": "APPROVE",
    }


def test_report_texts(spark):
    df = spark.createDataFrame([(7, 0.125, 1), (8, 0.001, 0), (9, 0.09, 0)], SCORED)
    got = {r["txn_id"]: r for r in policy.decision_report(df).collect()}
    assert got[7]["queue_label"] == "TXN-7 (Score: 0.12)"
    assert got[7]["distance_text"] == f"{0.125 - 0.09:.3f} over threshold"
    assert got[8]["distance_text"] == "0.089 under threshold"
    assert got[9]["distance_text"] == "0.000 over threshold"
    assert (got[7]["ground_truth"], got[8]["ground_truth"]) == ("Fraudulent", "Legitimate")


def test_inference_log_ids_repeat(spark):
    df = spark.createDataFrame([(1, 0.5, 0), (2, 0.1, 0)], SCORED)
    first = {r["txn_id"]: r["request_id"] for r in policy.inference_log(df).collect()}
    again = {r["txn_id"]: r["request_id"] for r in policy.inference_log(df).collect()}
    assert first == again and len(set(first.values())) == 2


def test_top_risk_and_samples(spark):
    df = spark.range(50).select(F.col("id").alias("txn_id"), (F.col("id") % 5 / 5).alias("score"))
    assert [r["txn_id"] for r in explain.top_risk(df, 3).collect()] == [4, 9, 14]
    assert explain.baseline_sample(df, 2000).count() == 50
    one = {r["txn_id"] for r in explain.baseline_sample(df, 10).collect()}
    assert one == {r["txn_id"] for r in explain.baseline_sample(df.repartition(7), 10).collect()}
    assert one != {r["txn_id"] for r in explain.baseline_sample(df, 10, seed=1).collect()}
    both = [r["txn_id"] for r in explain.explain_sample(df, 3, 10).collect()]
    assert len(both) == len(set(both)) and set(both) == one | {4, 9, 14}


def test_scope(spark):
    df = spark.createDataFrame([(1, 0.5, 0), (2, 0.1, 0), (3, 0.05, 0)], SCORED)
    assert explain.explain_scope(df, "declined", 0.1).count() == 2
    assert explain.explain_scope(df, "top_n", n=1).count() == 1
    with pytest.raises(ValueError, match="scope"):
        explain.explain_scope(df, "all")


def documents(spark):
    rows = [
        (1, 0.9, 1, [("a", 0.1, 1.0), ("b", -0.7, 2.0), ("c", 0.7, 3.0), ("d", 0.0, 4.0), ("e", 0.2, 5.0), ("f", 0.05, 6.0)]),
        (2, 0.9, 0, [("a", -0.3, 1.0)]),
    ]
    return spark.createDataFrame(rows, DRIVERS)


def test_drivers_rank_by_size_whatever_the_sign(spark):
    got = explain.top_drivers(documents(spark)).filter("txn_id = 1").orderBy("rank").collect()
    assert [(r["rank"], r["feature"], r["direction"]) for r in got] == [
        (1, "b", "down"), (2, "c", "up"), (3, "e", "up"), (4, "a", "up"), (5, "f", "up"),
    ]


def test_explanation_documents(spark):
    explained = explain.explanations(documents(spark))
    assert explained.schema.simpleString() == (
        "struct<transaction_index:bigint,predicted_risk_score:double,actual_is_fraud_label:int,"
        "top_risk_drivers:array<struct<feature:string,shap_impact:double,actual_value:double>>>"
    )
    assert explain.riskiest(documents(spark)).first()["transaction_index"] == 1
    shown = explain.driver_table(explained).filter("transaction_index = 1").orderBy("position").collect()
    assert [r["feature"] for r in shown] == ["b", "f", "a", "e", "c"]
    assert shown[0]["shap_text"] == "-0.70"


def test_importance_and_queue(spark):
    ranked = explain.global_importance(documents(spark), 2).collect()
    assert [r["feature"] for r in ranked] == ["b", "c"]
    every = {r["feature"]: r["mean_abs_shap"] for r in explain.global_importance(documents(spark)).collect()}
    assert every["a"] == pytest.approx(0.2)
    explained = explain.explanations(documents(spark))
    assert tuple(explain.queue_summary(explained).first()) == (2, 0.9)
    assert tuple(explain.queue_summary(explained.limit(0)).first()) == (0, 0.0)


def test_unknown_scores_are_never_declined_nor_at_the_top(spark):
    rows = spark.createDataFrame(
        [(1, float("nan"), 0), (2, None, 0), (3, 0.5, 1)], "txn_id long, score double, isFraud int"
    )
    decided = {r["txn_id"]: r["decision"] for r in policy.apply_policy(rows).collect()}
    assert decided == {1: None, 2: None, 3: "DECLINE"}
    assert [r["txn_id"] for r in explain.top_risk(rows, 1).collect()] == [3]
    assert [r["txn_id"] for r in explain.explain_scope(rows, "declined", 0.09).collect()] == [3]
