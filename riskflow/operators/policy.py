"""Frozen decision policies and their application."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.constants import (
    ALLOW_LABEL,
    BLOCK_LABEL,
    MODEL_ARTIFACT,
    POLICY_NAME,
    POLICY_NOTES,
    POLICY_THRESHOLD,
    REVIEW_LABEL,
)
from riskflow.functions.text import fixed
from riskflow.functions.ids import version_of

DEFAULT_POLICY: dict[str, Any] = {
    "policy_name": POLICY_NAME,
    "model_artifact": MODEL_ARTIFACT,
    "threshold": POLICY_THRESHOLD,
    "decision_labels": {"block": BLOCK_LABEL, "allow": ALLOW_LABEL},
    "notes": POLICY_NOTES,
}


def freeze_policy(
    optimum: DataFrame,
    policy_name: str = POLICY_NAME,
    model_artifact: str = MODEL_ARTIFACT,
    block: str = BLOCK_LABEL,
    allow: str = ALLOW_LABEL,
    notes: str = POLICY_NOTES,
) -> DataFrame:
    """The policy record for the row ``optimal_threshold`` found."""
    return optimum.select(
        F.lit(policy_name).alias("policy_name"),
        F.lit(model_artifact).alias("model_artifact"),
        "threshold",
        F.struct(F.lit(block).alias("block"), F.lit(allow).alias("allow")).alias("decision_labels"),
        F.lit(notes).alias("notes"),
    )


def known(score: Column) -> Column:
    """The score, null when it is NaN: Spark orders NaN above every threshold."""
    return F.when(~F.isnan(score.cast("double")), score)


def decide(
    score: Column, policy: Mapping[str, Any], review_band: float | None = None
) -> Column:
    """Block at or above the threshold, else allow; an unknown score, null or NaN, gives no
    decision.

    With ``review_band`` the scores less than that far below the threshold go to review.
    """
    threshold, labels = float(policy["threshold"]), policy["decision_labels"]
    decision = F.when(known(score).isNull(), F.lit(None).cast("string")).when(
        score >= threshold, F.lit(labels["block"])
    )
    if review_band:
        decision = decision.when(score >= threshold - review_band, F.lit(REVIEW_LABEL))
    return decision.otherwise(F.lit(labels["allow"]))


def apply_policy(
    scored: DataFrame,
    policy: Mapping[str, Any] = DEFAULT_POLICY,
    score: str = "score",
    review_band: float | None = None,
) -> DataFrame:
    """Add the decision; the policy is one small record, so its values go in as literals."""
    return scored.withColumn("decision", decide(F.col(score), policy, review_band))


def compare_policies(
    scored: DataFrame, policies: Sequence[Mapping[str, Any]], score: str = "score"
) -> DataFrame:
    """One row per input row and policy version, in a single pass."""
    versions = F.array(
        *(
            F.struct(
                F.lit(p["policy_name"]).alias("policy_version"),
                F.lit(float(p["threshold"])).alias("threshold"),
                decide(F.col(score), p).alias("decision"),
            )
            for p in policies
        )
    )
    return scored.select("*", F.inline(versions))


def decision_report(
    scored: DataFrame,
    policy: Mapping[str, Any] = DEFAULT_POLICY,
    score: str = "score",
    label: str = "isFraud",
) -> DataFrame:
    """What an analyst sees of each row: queue label, decision, distance to the threshold."""
    value, threshold = known(F.col(score)), F.lit(float(policy["threshold"]))
    distance = F.when(
        value >= threshold, F.concat(fixed(value - threshold, 3), F.lit(" over threshold"))
    ).otherwise(F.concat(fixed(threshold - value, 3), F.lit(" under threshold")))
    return scored.select(
        "txn_id",
        F.concat(
            F.lit("TXN-"), F.col("txn_id").cast("string"), F.lit(" (Score: "), fixed(value, 2), F.lit(")")
        ).alias("queue_label"),
        decide(value, policy).alias("decision"),
        fixed(value, 3).alias("score_text"),
        distance.alias("distance_text"),
        F.when(F.col(label) == 1, "Fraudulent").otherwise("Legitimate").alias("ground_truth"),
    )


def request_id(policy: Mapping[str, Any], txn: str = "txn_id") -> Column:
    """Id of an inference, a function of transaction, model and policy: whoever repeats the
    inference, or reports on it, finds the same one."""
    # A missing id keeps its place: concat_ws would skip it.
    part = F.coalesce(F.col(txn).cast("string"), F.lit(""))
    model = version_of(F.lit(policy["model_artifact"]))
    return F.sha2(F.concat_ws("|", part, model, F.lit(policy["policy_name"])), 256)


def inference_log(
    scored: DataFrame,
    policy: Mapping[str, Any] = DEFAULT_POLICY,
    score: str = "score",
    logged_at: Column | None = None,
    review_band: float | None = None,
) -> DataFrame:
    """One structured entry per inference. The request id is a function of transaction, model
    and policy, so a repeated run logs the same ids. Optional input columns: ``drivers`` (top
    contributing features), ``insight_generated``, ``insight_valid``."""
    model = version_of(F.lit(policy["model_artifact"]))
    has = set(scored.columns)
    top = F.col("drivers.feature") if "drivers" in has else F.lit([]).cast("array<string>")
    flags = [
        (F.coalesce(F.col(c), F.lit(False)) if c in has else F.lit(False)).alias(c)
        for c in ("insight_generated", "insight_valid")
    ]
    return scored.select(
        request_id(policy).alias("request_id"),
        (F.current_timestamp() if logged_at is None else logged_at).alias("timestamp"),
        "txn_id",
        model.alias("model_version"),
        F.lit(policy["policy_name"]).alias("policy_version"),
        F.col(score).alias("risk_score"),
        top.alias("top_features"),
        decide(F.col(score), policy, review_band).alias("recommended_action"),
        *flags,
    )
