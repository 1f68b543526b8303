"""Declared schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

RAW = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)

# The raw layout preceded by the unique row id that every order key ends in.
RAW_WITH_ID = T.StructType([T.StructField("txn_id", T.LongType()), *RAW.fields])

DRIVER = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("shap_impact", T.DoubleType()),
        T.StructField("actual_value", T.DoubleType()),
    ]
)

EXPLANATION = T.StructType(
    [
        T.StructField("transaction_index", T.LongType()),
        T.StructField("predicted_risk_score", T.DoubleType()),
        T.StructField("actual_is_fraud_label", T.IntegerType()),
        T.StructField("top_risk_drivers", T.ArrayType(DRIVER)),
    ]
)

POLICY = T.StructType(
    [
        T.StructField("policy_name", T.StringType()),
        T.StructField("model_artifact", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField(
            "decision_labels",
            T.StructType(
                [T.StructField("block", T.StringType()), T.StructField("allow", T.StringType())]
            ),
        ),
        T.StructField("notes", T.StringType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("transaction_index", T.LongType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("decision", T.StringType()),
        T.StructField("llm_latency_ms", T.LongType()),
        T.StructField("guardrail_passed", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("policy_version", T.StringType()),
        T.StructField("prompt_version", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
