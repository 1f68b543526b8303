"""Time, type and behaviour features, from raw transactions to the model's table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.constants import (
    DEFAULT_SALT,
    RATIO_EPSILON,
    RECENCY_CAP_HOURS,
    REQUIRED_COLUMNS,
    SEQUENCE_GAP_HOURS,
    TXN_TYPES,
)
from riskflow.functions.timeparts import day_of, hour_of, is_night
from riskflow.operators.account_windows import ROLLING, SEQUENCE, account_windows
from riskflow.operators.privacy import drop_leakage, hash_identifiers, require_columns
from riskflow.operators.quality import enforce
from riskflow.operators.skew import HOT_ROWS, HotKeys, hot_keys

PROCESSED_COLUMNS = (
    "txn_id",
    "step",
    *(f"txn_type_{t}" for t in TXN_TYPES),
    "amount",
    "isFraud",
    "isFlaggedFraud",
    "account_id",
    "counterparty_id",
    "hour",
    "day",
    "is_night",
    "txn_count_24h",
    "avg_amount_24h",
    "amount_deviation",
)
FEATURE_COLUMNS = (
    *PROCESSED_COLUMNS,
    "time_since_last_txn_hr",
    "amount_ratio_24h",
    "is_transfer",
    "is_cash_out",
    "transfer_in_last_6h",
    "transfer_then_cashout_6h",
)


def add_time_features(df: DataFrame) -> DataFrame:
    step = F.col("step")
    return df.withColumns(
        {"hour": hour_of(step), "day": day_of(step), "is_night": is_night(hour_of(step))}
    )


def one_hot_types(df: DataFrame, type_col: str = "type") -> DataFrame:
    """Replace the type by one 0/1 column per known value; other or null types are all zero."""
    flags = {
        f"txn_type_{t}": F.coalesce(F.col(type_col) == t, F.lit(False)).cast("byte")
        for t in TXN_TYPES
    }
    return df.withColumns(flags).drop(type_col)


def rolling_features(
    df: DataFrame,
    account: str = "account_id",
    frame: str = "rows",
    hot: HotKeys | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Count and mean of the account's last 24 rows or hours, and the deviation from the mean."""
    windowed = account_windows(df, account, ROLLING, frame, hot=hot, hot_rows=hot_rows)
    return windowed.withColumn("amount_deviation", _deviation())


def behavior_features(
    df: DataFrame, account: str = "account_id", hot: HotKeys | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Recency, amount ratio, type flags and the transfer-then-cash-out sequence, for a
    processed table that has its rolling mean."""
    transfer = F.col("txn_type_TRANSFER") == 1
    windowed = account_windows(
        df, account, SEQUENCE, is_transfer=transfer, hot=hot, hot_rows=hot_rows
    )
    return _finish_behavior(windowed)


def preprocess(
    tx: DataFrame,
    salt: str = DEFAULT_SALT,
    frame: str = "rows",
    hot: HotKeys | None = None,
    hot_rows: int = HOT_ROWS,
    strict: bool = True,
) -> DataFrame:
    """Raw transactions to the processed table; ``tx`` needs a unique ``txn_id``. ``strict``
    makes the job fail on a negative amount or step or an invalid label.

    Windows run on the raw origin name, and hashes, time parts and type flags follow, so that
    the exchange carries neither 64-character digests nor derived columns. Equal names have
    equal hashes, hence the groups are the same.
    """
    raw, hot = _checked(tx, hot, hot_rows, strict)
    rolled = rolling_features(raw, "nameOrig", frame, hot, hot_rows)
    return _describe(rolled, salt).select(*PROCESSED_COLUMNS)


def feature_table(
    tx: DataFrame,
    salt: str = DEFAULT_SALT,
    frame: str = "rows",
    hot: HotKeys | None = None,
    hot_rows: int = HOT_ROWS,
    strict: bool = True,
) -> DataFrame:
    """``preprocess`` and ``behavior_features`` in one plan with a single account exchange."""
    raw, hot = _checked(tx, hot, hot_rows, strict)
    windowed = account_windows(
        raw,
        "nameOrig",
        ROLLING + SEQUENCE,
        frame,
        is_transfer=F.col("type") == "TRANSFER",
        hot=hot,
        hot_rows=hot_rows,
    ).withColumn("amount_deviation", _deviation())
    return _finish_behavior(_describe(windowed, salt)).select(*FEATURE_COLUMNS)


def _checked(
    tx: DataFrame, hot: HotKeys | None, hot_rows: int, strict: bool
) -> tuple[DataFrame, HotKeys]:
    """Raw columns without leakage and the hot accounts. Broken values stop the job before
    the exchange; the search for hot accounts still reads nothing but the names."""
    raw = drop_leakage(require_columns(tx, (*REQUIRED_COLUMNS, "txn_id")))
    hot = hot_keys(raw, "nameOrig", hot_rows) if hot is None else hot
    return enforce(raw) if strict else raw, hot


def _describe(df: DataFrame, salt: str) -> DataFrame:
    return hash_identifiers(one_hot_types(add_time_features(df)), salt)


def _deviation() -> Column:
    return F.col("amount") - F.col("avg_amount_24h")


def _finish_behavior(windowed: DataFrame) -> DataFrame:
    gap = F.col("step_gap")
    recent = F.coalesce(
        F.col("step") - F.col("last_transfer_step") <= SEQUENCE_GAP_HOURS, F.lit(False)
    ).cast("byte")
    flags = {
        "is_transfer": F.coalesce(F.col("txn_type_TRANSFER"), F.lit(0)).cast("byte"),
        "is_cash_out": F.coalesce(F.col("txn_type_CASH_OUT"), F.lit(0)).cast("byte"),
    }
    return windowed.withColumns(
        {
            **flags,
            # ``least`` skips nulls: without the test a first row would get the cap, not 0.
            "time_since_last_txn_hr": F.when(gap.isNull(), 0)
            .otherwise(F.least(gap, F.lit(RECENCY_CAP_HOURS)))
            .cast("int"),
            "amount_ratio_24h": (F.col("amount") / (F.col("avg_amount_24h") + RATIO_EPSILON)).cast(
                "float"
            ),
            "transfer_in_last_6h": recent,
            "transfer_then_cashout_6h": (recent * flags["is_cash_out"]).cast("byte"),
        }
    ).drop("step_gap", "last_transfer_step")
