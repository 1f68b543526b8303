"""Threshold sweep: confusion counts, money and the best decision threshold.

Every row is read once. It counts for all thresholds up to its score, so rows are grouped by
how many thresholds they reach, and running sums over that short table give the sweep.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from riskflow.constants import (
    FEATURES_V1,
    FRAUD_MULTIPLIER,
    MARGIN_RATE,
    MODEL_ARTIFACT,
    REVIEW_COST,
    THRESHOLDS,
)

#: Scale of the sums; an amount that it cannot hold stops the query instead of being rounded.
MONEY = "decimal(28,8)"
SWEEP_COLUMNS = (
    "threshold",
    "net_profit_tx",
    "net_profit_proxy",
    "revenue_kept_tx",
    "fraud_losses_tx",
    "revenue_kept_proxy",
    "fraud_losses_proxy",
    "fp_penalties",
    "approval_rate_pct",
    "fraud_caught_pct",
    "precision_pct",
    "good_users_blocked",
)


def exact_money(amount: Column, money: str = MONEY) -> Column:
    """``amount`` as a decimal of type ``money``; fails on a value that does not fit it, NaN
    included. Null stays null."""
    value = amount.try_cast(money)
    refusal = F.concat(F.lit(f"amount does not fit {money}: "), amount.cast("string"))
    return F.when(amount.isNull() | (value == amount), value).otherwise(F.raise_error(refusal))


def threshold_confusion(
    scored: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    score: str = "score",
    label: str = "isFraud",
    money: str = MONEY,
) -> DataFrame:
    """tp, fp, tn, fn of the decision ``score >= threshold``, one row per threshold, with the
    amounts of approved legitimate (``tn_amount``) and missed fraudulent (``fn_amount``) rows
    as exact decimals."""
    grid = [float(t) for t in thresholds]
    if sorted(set(grid)) != grid:
        raise ValueError("thresholds must be distinct and ascending")
    # A bucket includes its lower limit, as the decision includes its threshold. A missing
    # score becomes NaN, which the bucketizer refuses.
    reached = Bucketizer(
        splits=[float("-inf"), *grid, float("inf")], inputCol="_score", outputCol="_reached"
    ).transform(
        scored.select(
            F.coalesce(F.col(score).cast("double"), F.lit(float("nan"))).alias("_score"),
            F.col(label).alias("_label"),
            exact_money(F.col("amount"), money).alias("_amount"),
        )
    )
    # One unlabelled row per threshold number keeps the empty ones in the result.
    steps = scored.sparkSession.range(0, len(grid) + 1, 1, 1).select(
        F.col("id").alias("_k"), F.lit(None).alias("_label"), F.lit(None).alias("_amount")
    )
    fraud, legitimate = F.col("_label") == 1, F.col("_label") == 0
    counts = (
        reached.select(F.col("_reached").cast("long").alias("_k"), "_label", "_amount")
        .union(steps)
        .groupBy("_k")
        .agg(
            F.count_if(fraud).alias("_pos"),
            F.count_if(legitimate).alias("_neg"),
            F.sum(F.when(fraud, F.col("_amount"))).alias("_pos_amount"),
            F.sum(F.when(legitimate, F.col("_amount"))).alias("_neg_amount"),
        )
    )
    # From here on one row per threshold. The value k of a row with threshold number k says
    # that rows below k are approved.
    all_rows = W.Window.orderBy("_k")
    below = all_rows.rowsBetween(W.Window.unboundedPreceding, -1)
    whole = all_rows.rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing)
    summed = counts.select(
        "_k",
        *(
            F.coalesce(F.sum(c).over(frame), F.lit(0)).alias(f"{c}{suffix}")
            for c in ("_pos", "_neg", "_pos_amount", "_neg_amount")
            for frame, suffix in ((below, "_below"), (whole, "_whole"))
        ),
    )
    return summed.filter(F.col("_k") > 0).select(
        F.element_at(
            F.expr(f"array({','.join(f'{t}D' for t in grid)})"), F.col("_k").cast("int")
        ).alias("threshold"),
        (F.col("_pos_whole") - F.col("_pos_below")).alias("tp"),
        (F.col("_neg_whole") - F.col("_neg_below")).alias("fp"),
        F.col("_neg_below").alias("tn"),
        F.col("_pos_below").alias("fn"),
        F.col("_neg_amount_below").alias("tn_amount"),
        F.col("_pos_amount_below").alias("fn_amount"),
        F.col("_pos_amount_whole").alias("fraud_amount"),
    )


def threshold_sweep(
    scored: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    margin_rate: str | float = MARGIN_RATE,
    review_cost: str | float = REVIEW_COST,
    fraud_multiplier: str | float = FRAUD_MULTIPLIER,
    avg_fraud_loss: float | None = None,
    score: str = "score",
    label: str = "isFraud",
    money: str = MONEY,
) -> DataFrame:
    """The twelve published columns per threshold; both the economics of the actual amounts
    and of the proxy loss per fraud are always computed."""
    margin, cost, factor = (_number(v) for v in (margin_rate, review_cost, fraud_multiplier))
    counts = threshold_confusion(scored, thresholds, score, label, money)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    loss = (
        F.coalesce(F.try_divide(F.col("fraud_amount").cast("double"), tp + fn), F.lit(0.0))
        if avg_fraud_loss is None
        else F.lit(float(avg_fraud_loss))
    )
    penalties = fp * cost
    kept_proxy = tn * loss * factor.cast("double") * margin.cast("double")
    lost_proxy = fn * loss * factor.cast("double")
    columns = {
        "net_profit_tx": F.col("tn_amount") * margin - F.col("fn_amount") - penalties,
        "net_profit_proxy": kept_proxy - lost_proxy - penalties.cast("double"),
        "revenue_kept_tx": F.col("tn_amount") * margin,
        "fraud_losses_tx": F.col("fn_amount"),
        "revenue_kept_proxy": kept_proxy,
        "fraud_losses_proxy": lost_proxy,
        "fp_penalties": penalties,
    }
    return counts.select(
        "threshold",
        *(value.cast("double").alias(name) for name, value in columns.items()),
        (100.0 * F.try_divide(tn + fn, tp + fp + tn + fn)).alias("approval_rate_pct"),
        _percent(tp, tp + fn).alias("fraud_caught_pct"),
        _percent(tp, tp + fp).alias("precision_pct"),
        fp.alias("good_users_blocked"),
    )


def _number(value: str | float) -> Column:
    return F.lit(Decimal(str(value)))


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * F.try_divide(part, whole)).otherwise(F.lit(0.0))


def top_thresholds(sweep: DataFrame, by: str = "net_profit_tx", n: int = 5) -> DataFrame:
    """The ``n`` best thresholds; the lower threshold wins a tie."""
    return sweep.orderBy(F.desc(by), F.asc("threshold")).limit(n)


def optimal_threshold(sweep: DataFrame, by: str = "net_profit_tx") -> DataFrame:
    """The first maximum of the sweep, one row."""
    return top_thresholds(sweep, by, 1)


def fp_fn_curve(scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Good users blocked against frauds missed, per threshold."""
    return threshold_confusion(scored, thresholds).select(
        "threshold", F.col("fp").alias("good_users_blocked"), F.col("fn").alias("fraud_missed")
    )


def avg_fraud_loss(
    scored: DataFrame, label: str = "isFraud", money: str = MONEY
) -> DataFrame:
    """Mean amount of the frauds, 0 when there are none; exact sum, one row."""
    fraud = F.col(label) == 1
    total = F.sum(F.when(fraud, exact_money(F.col("amount"), money))).cast("double")
    return scored.agg(
        F.coalesce(F.try_divide(total, F.count_if(fraud)), F.lit(0.0)).alias("avg_fraud_loss")
    )


def econ_assumptions(
    scored: DataFrame,
    margin_rate: str | float = MARGIN_RATE,
    review_cost: str | float = REVIEW_COST,
    fraud_multiplier: str | float = FRAUD_MULTIPLIER,
    model_artifact: str = MODEL_ARTIFACT,
    feature_set: Sequence[str] = FEATURES_V1,
    test_window: str = "day >= 26",
    label: str = "isFraud",
    money: str = MONEY,
) -> DataFrame:
    """The one-row record of what a sweep assumed, with the number of rows it saw."""
    fraud = F.col(label) == 1
    total = F.sum(F.when(fraud, exact_money(F.col("amount"), money))).cast("double")
    return scored.agg(
        F.coalesce(F.try_divide(total, F.count_if(fraud)), F.lit(0.0)).alias("AVG_FRAUD_LOSS"),
        F.count(F.lit(1)).alias("num_test_transactions"),
    ).select(
        F.lit(float(margin_rate)).alias("MARGIN_RATE"),
        F.lit(float(review_cost)).alias("REVIEW_COST"),
        F.lit(True).alias("USE_TRANSACTION_AMOUNTS"),
        "AVG_FRAUD_LOSS",
        F.lit(float(fraud_multiplier)).alias("FRAUD_MULTIPLIER"),
        F.lit(model_artifact).alias("model_artifact"),
        F.lit(list(feature_set)).alias("feature_set"),
        F.lit(test_window).alias("test_window"),
        "num_test_transactions",
    )
