"""Required columns, leakage columns and identifier hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.constants import DEFAULT_SALT, LEAKAGE_COLUMNS, REQUIRED_COLUMNS
from riskflow.functions.ids import salted_hash
from riskflow.operators.skew import HotKeys, hot_keys


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Fail on the analysed schema, before any job runs, when a column is missing."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def column_report(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """One line per required column: whether the table has it, its values that are not null, and
    the table's rows; in one pass that reads the required columns only."""
    have = [c for c in required if c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count(c).alias(f"_{c}") for c in have))
    lines = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in have).alias("present"),
                (F.col(f"_{c}") if c in have else F.lit(0).cast("long")).alias("known"),
            )
            for c in required
        )
    )
    return counts.select(F.inline(lines), "rows")


def drop_leakage(df: DataFrame) -> DataFrame:
    """Balances reveal the outcome of a transaction; absent ones are ignored."""
    return df.drop(*LEAKAGE_COLUMNS)


def hash_identifiers(df: DataFrame, salt: str = DEFAULT_SALT) -> DataFrame:
    """Replace both raw names by their salted hashes, row by row and without a shuffle."""
    kept = [c for c in df.columns if c not in ("nameOrig", "nameDest")]
    return df.select(
        *kept,
        salted_hash(F.col("nameOrig"), salt).alias("account_id"),
        salted_hash(F.col("nameDest"), salt).alias("counterparty_id"),
    )


def identifier_map(df: DataFrame, salt: str = DEFAULT_SALT) -> DataFrame:
    """Every distinct non-null name of either side with its hash; one scan feeds both sides."""
    names = df.select(F.explode(F.array("nameOrig", "nameDest")).alias("name")).dropna()
    return names.distinct().select("name", salted_hash(F.col("name"), salt).alias("hashed_id"))


def join_identifiers(
    df: DataFrame,
    mapping: DataFrame,
    hot_origins: HotKeys | None = None,
    hot_targets: HotKeys | None = None,
) -> DataFrame:
    """``hash_identifiers`` by joining a stored identifier map to both name columns."""
    origins = hot_keys(df, "nameOrig") if hot_origins is None else hot_origins
    targets = hot_keys(df, "nameDest") if hot_targets is None else hot_targets
    joined = _left_lookup(df, mapping, "nameOrig", "account_id", origins)
    joined = _left_lookup(joined, mapping, "nameDest", "counterparty_id", targets)
    return joined.drop("nameOrig", "nameDest")


def _left_lookup(
    df: DataFrame, mapping: DataFrame, key: str, out: str, hot: HotKeys
) -> DataFrame:
    """Left join on a unique key. Rows of hot keys skip the shuffle that would pile them up:
    the map has one row per key, so its hot part is as short as the list of hot keys."""
    side = mapping.select(F.col("name").alias(key), F.col("hashed_id").alias(out))
    if not hot.values:
        return df.join(side, key, "left")
    is_hot = hot.match(F.col(key))
    few = F.broadcast(side.filter(is_hot))
    return (
        df.filter(~is_hot)
        .join(side, key, "left")
        .unionByName(df.filter(is_hot).join(few, key, "left"))
    )
