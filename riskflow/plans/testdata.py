"""The driver's tables seen as payment data.

The events table plays the transactions, documents play generated narratives; scores and
feature contributions are formulas over them, so every derived table grows with its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.constants import FEATURES_V1
from riskflow.functions.timeparts import day_of, moment_of
from riskflow.operators.boosting import encoded
from riskflow.operators.features import feature_table
from riskflow.schemas import RAW_WITH_ID
from riskflow.sources.models import PORTABLE

_TYPES = {
    "view": "CASH_IN",
    "purchase": "CASH_OUT",
    "error": "DEBIT",
    "click": "PAYMENT",
    "signup": "TRANSFER",
}
# feature, prime of its contribution, multiple of the amount shown as its value
_CONTRIBUTIONS = (
    ("amount", 101, 1),
    ("hour", 103, 2),
    ("is_night", 107, 3),
    ("avg_amount_24h", 109, 4),
    ("is_transfer", 113, 5),
)
NARRATIVE_TERMS = ("license",)

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


# A model as an artifact from elsewhere: trees of (feature, threshold, left, right) down to leaves
# of (prediction, cover). The ratio has gaps, so it has two columns.
FROZEN_TREES = (
    (1.0, ("is_transfer", 0.5,
        ("is_cash_out", 0.5, (-0.98, 620.0), ("amount", 180.25, (-0.9, 150.0), (-0.55, 50.0))),
        ("amount", 150.125, (-0.85, 120.0), ("time_since_last_txn_hr", 10.5, (-0.6, 40.0), (-0.25, 20.0))))),
    (0.05, ("amount_ratio_24h__low", 1.20031,
        ("hour", 5.5, (0.31, 90.0), ("txn_count_24h", 23.5, (-0.42, 300.0), (0.07, 310.0))),
        ("amount_ratio_24h__high", 2.10037, ("transfer_in_last_6h", 0.5, (0.2, 110.0), (0.55, 60.0)), (0.9, 130.0)))),
    (0.05, ("amount", 60.375,
        ("amount", 20.625, (-0.6, 200.0), ("is_transfer", 0.5, (-0.2, 150.0), (0.35, 50.0))),
        ("hour", 18.5, ("transfer_then_cashout_6h", 0.5, (0.1, 350.0), (0.8, 50.0)), (0.45, 200.0)))),
    (0.05, ("amount_deviation", -12.34567, (-0.3, 380.0),
        ("amount_ratio_24h__low", -1e300, (0.77, 70.0), ("txn_type_PAYMENT", 0.5, (0.15, 400.0), (-0.5, 150.0))))),
)


def frozen_nodes() -> list[tuple]:
    """The frozen trees as rows of a portable document: tree, weight, node, feature, threshold,
    left, right, prediction, cover; children follow their parent, the mean of theirs is its own."""
    rows: list[tuple] = []

    def add(tree: int, weight: float, part: tuple) -> tuple[int, float, float]:
        at = sum(r[0] == tree for r in rows)
        if len(part) == 2:
            rows.append((tree, weight, at, None, None, -1, -1, *part))
            return at, *part
        rows.append((tree,))
        place = len(rows) - 1
        left, right = (add(tree, weight, side) for side in part[2:])
        cover = left[2] + right[2]
        mean = (left[1] * left[2] + right[1] * right[2]) / cover
        rows[place] = (tree, weight, at, part[0], part[1], left[0], right[0], mean, cover)
        return at, mean, cover

    for tree, (weight, root) in enumerate(FROZEN_TREES):
        add(tree, weight, root)
    return rows


def frozen_columns() -> list[str]:
    return encoded(FEATURES_V1, ("amount_ratio_24h",))


def frozen_document(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(frozen_columns(), frozen_nodes())], PORTABLE)


def gappy_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, with the ratio unknown for every 13th transaction."""
    table = feature_table(transactions(spark, sf_dir))
    ratio = F.when(F.col("txn_id") % 13 > 0, F.col("amount_ratio_24h"))
    return table.withColumn("amount_ratio_24h", ratio)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions, balances included."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    value = F.col("value")
    type_name = F.lit(None)
    for event, name in _TYPES.items():
        type_name = F.when(kind == event, name).otherwise(type_name)
    days = F.datediff("ts", F.to_date(F.lit("2024-01-01")))
    chosen = kind.isin("signup", "purchase") & (F.col("event_id") * 7919 % 100 < 6)
    return events.select(
        F.col("event_id").alias("txn_id"),
        (days * 24 + F.hour("ts")).cast("long").alias("step"),
        type_name.alias("type"),
        value.alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        (value * 2).alias("oldbalanceOrg"),
        value.alias("newbalanceOrig"),
        F.concat(F.lit("M"), F.get_json_object("props", "$.k")).alias("nameDest"),
        F.lit(0.0).alias("oldbalanceDest"),
        value.alias("newbalanceDest"),
        F.when(chosen, 1).otherwise(0).alias("isFraud"),
        F.when((kind == "signup") & (value > 200), 1).otherwise(0).alias("isFlaggedFraud"),
    )


def skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions with a third of them on one account, some on none, and hours far apart:
    gaps between the transactions of the smaller accounts exceed a week."""
    account = F.when(F.col("txn_id") % 3 == 0, "C0").when(F.col("txn_id") % 50 > 1, F.col("nameOrig"))
    return transactions(spark, sf_dir).withColumns({"nameOrig": account, "step": F.col("step") * 30})


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with scores on a grid of thousandths; many equal a threshold."""
    points = F.col("txn_id") * 104729 % 600 + 390 * F.col("isFraud")
    return transactions(spark, sf_dir).select(
        "txn_id",
        "step",
        day_of(F.col("step")).alias("day"),
        "type",
        "amount",
        "isFraud",
        (points / 1000.0).alias("score"),
    )


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows with one driver per feature; absolute contributions tie on purpose."""
    drivers = F.array(
        *(
            F.struct(
                F.lit(name).alias("feature"),
                ((F.col("txn_id") * prime % 201 - 100) / 100.0).alias("shap_impact"),
                (F.col("amount") * multiple).cast("double").alias("actual_value"),
            )
            for name, prime, multiple in _CONTRIBUTIONS
        )
    )
    return scored(spark, sf_dir).withColumn("drivers", drivers)


def insight_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generator's results with the time they came, each as long after its inference as its
    latency says; texts without a transaction are left out."""
    asked = scored(spark, sf_dir).select("txn_id", moment_of(F.col("step")).alias("asked_at"))
    came = F.col("asked_at") + F.make_dt_interval(secs=F.col("latency_ms") / 1000)
    return narratives(spark, sf_dir).join(asked, "txn_id").select(
        "txn_id", "narrative", "latency_ms", "error", came.alias("insight_at")
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions with every kind of broken value in some of them."""
    n = F.col("txn_id")

    def broken(column: str, *cases: tuple[int, object]) -> Column:
        value = None
        for divisor, wrong in cases:
            wrong = wrong if isinstance(wrong, Column) else F.lit(wrong)
            value = (F if value is None else value).when(n % divisor == 0, wrong)
        return value.otherwise(F.col(column)).alias(column)

    tx = transactions(spark, sf_dir)
    changed = {
        "amount": broken("amount", (19, -F.col("amount") - 1), (23, float("nan")), (29, None)),
        "isFraud": broken("isFraud", (31, 2), (37, None)),
        "step": broken("step", (41, -1 - F.col("step")), (43, None)),
        "type": broken("type", (47, "OTHER"), (53, None)),
        "nameOrig": broken("nameOrig", (59, None)),
        "nameDest": broken("nameDest", (61, None)),
    }
    return tx.select(*(changed.get(c, F.col(c)) for c in tx.columns))


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions as text, some fields of which do not fit their type."""
    n = F.col("txn_id")
    tx = transactions(spark, sf_dir)
    text = {c: F.col(c).cast("string").alias(c) for c in tx.columns}
    text["amount"] = F.when(n % 17 == 0, "n/a").otherwise(text["amount"]).alias("amount")
    text["step"] = F.when(n % 13 == 0, F.concat(text["step"], F.lit("h"))).otherwise(text["step"]).alias("step")
    text["isFraud"] = F.when(n % 11 == 0, "yes").otherwise(text["isFraud"]).alias("isFraud")
    return tx.select(*(text[c] for c in RAW_WITH_ID.names))


#: Texts with each forbidden term, then texts that come near one.
GUARDED_TEXTS = (
    "Sent from another Country.", "A CROSS-BORDER payment.", "Odd merchant category here.", "Unknown Location.",
    "The user identity is open.", "A new IP Address.", "Some device and its location.",
    "Many countries.", "A cross border payment.", "Merchant and category.", "We locate it.",
    "The user's identity.", "An IP, an address.", "We devise it.", "Large amounts at night.", "  ",
)


def guarded_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narratives, each followed by one of ``GUARDED_TEXTS``."""
    ending = F.element_at(F.lit(list(GUARDED_TEXTS)), (F.col("txn_id") % len(GUARDED_TEXTS) + 1).cast("int"))
    told = narratives(spark, sf_dir)
    return told.withColumn("narrative", F.concat("narrative", F.lit(" "), ending))


def narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, latencies and errors of an external text generator."""
    documents = spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")
    return documents.select(
        F.col("doc_id").alias("txn_id"),
        F.col("text").alias("narrative"),
        (F.col("doc_id") * 7919 % 60000).cast("long").alias("latency_ms"),
        F.when(F.col("doc_id") % 20 == 0, F.lit("connection refused")).alias("error"),
    )
