"""Chronological split, class balance and the model's input columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.constants import (
    FEATURES_V1,
    TEST_START_DAY,
    TRAIN_END_DAY,
    VAL_END_DAY,
    VAL_START_DAY,
)
from riskflow.functions.timeparts import split_of


def add_split(df: DataFrame) -> DataFrame:
    return df.withColumn("split", split_of(F.col("day")))


def time_split(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows; the day filters reach the scan."""
    day = F.col("day")
    return (
        df.filter(day <= TRAIN_END_DAY),
        df.filter(day.between(VAL_START_DAY, VAL_END_DAY)),
        df.filter(day >= TEST_START_DAY),
    )


def split_sanity(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Rows, frauds and fraud rate in percent of each split; an empty split shows zeros."""
    names = F.array(*(F.lit(n) for n in ("train", "val", "test")))
    every = df.sparkSession.range(0, 1, 1, 1).select(
        F.explode(names).alias("split"), F.lit(None).alias("label"), F.lit(None).alias("row")
    )
    rows = add_split(df).select("split", F.col(label).alias("label"), F.lit(1).alias("row"))
    frauds = F.coalesce(F.sum("label"), F.lit(0))
    return (
        rows.union(every)
        .groupBy("split")
        .agg(
            F.count("row").alias("total"),
            frauds.alias("frauds"),
            F.coalesce(100 * F.try_divide(frauds, F.count("row")), F.lit(0.0)).alias(
                "fraud_rate_pct"
            ),
        )
    )


def class_balance(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Positives, negatives and their ratio, one row."""
    pos = F.coalesce(F.sum(label), F.lit(0))
    neg = F.count(F.lit(1)) - pos
    return df.agg(
        pos.alias("pos"), neg.alias("neg"), (neg / F.greatest(pos, F.lit(1))).alias("neg_per_pos")
    )


def feature_matrix(df: DataFrame) -> DataFrame:
    """Row id, split keys, label and the model columns in their pinned order."""
    missing = [c for c in FEATURES_V1 if c not in df.columns]
    if missing:
        raise ValueError(f"Missing model columns: {missing}")
    return df.select("txn_id", "day", "isFraud", *FEATURES_V1)
