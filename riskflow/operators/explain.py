"""Which rows to explain, and their drivers.

A contribution table has one row per transaction with ``drivers``, an array of feature,
contribution and value: a row never needs a shuffle to gather its own features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.constants import BASELINE_ROWS, IMPORTANCE_ROWS, SEED, TOP_DRIVERS, TOP_RISK_ROWS
from riskflow.functions.text import fixed
from riskflow.operators.policy import known
from riskflow.operators.prefilter import keep_possible


def top_risk(scored: DataFrame, n: int = TOP_RISK_ROWS, score: str = "score") -> DataFrame:
    """The ``n`` highest scores; each task keeps its own ``n`` and no full sort takes place.
    Unknown scores, null or NaN, come last."""
    return scored.orderBy(known(F.col(score)).desc(), F.asc("txn_id")).limit(n)


def baseline_sample(scored: DataFrame, n: int = BASELINE_ROWS, seed: int = SEED) -> DataFrame:
    """``n`` rows, or all if fewer, drawn without replacement by a seeded digest of the id."""
    draw = F.md5(F.concat(F.col("txn_id").cast("string"), F.lit(f"_{seed}")))
    return scored.orderBy(draw, F.asc("txn_id")).limit(n)


def explain_sample(
    scored: DataFrame,
    top_n: int = TOP_RISK_ROWS,
    sample_n: int = BASELINE_ROWS,
    seed: int = SEED,
    score: str = "score",
) -> DataFrame:
    """The riskiest rows and the random baseline, each row once."""
    both = top_risk(scored, top_n, score).union(baseline_sample(scored, sample_n, seed))
    return both.dropDuplicates(["txn_id"])


def explain_scope(
    scored: DataFrame, scope: str, threshold: float | None = None, n: int = TOP_RISK_ROWS
) -> DataFrame:
    """Rows to explain: ``top_n``, or every ``declined`` row however many there are."""
    if scope == "top_n":
        return top_risk(scored, n)
    if scope == "declined":
        return scored.filter((F.col("score") >= float(threshold)) & known(F.col("score")).isNotNull())
    raise ValueError(f"scope must be 'top_n' or 'declined', not {scope!r}")


_DRIVER_FIELDS = ("feature", "shap_impact", "actual_value")


def _strongest(drivers: Column, n: int) -> Column:
    """The ``n`` drivers of largest absolute contribution, ties by feature name. The sort key
    is their first field, so that plain struct ordering sorts them."""
    keyed = F.transform(
        drivers,
        lambda d: F.struct(
            (-F.abs(d["shap_impact"])).alias("order"), *(d[c].alias(c) for c in _DRIVER_FIELDS)
        ),
    )
    return F.slice(F.sort_array(keyed), 1, n)


def ranked_drivers(drivers: Column, n: int = TOP_DRIVERS) -> Column:
    """The ``n`` strongest drivers, whichever way they move the score, strongest first."""
    return F.transform(
        _strongest(drivers, n), lambda d: F.struct(*(d[c].alias(c) for c in _DRIVER_FIELDS))
    )


def lookup(queue: DataFrame, contributions: DataFrame) -> DataFrame:
    """Contributions of the rows of a queue, long or short: contributions that no row of it can
    need are dropped before the join."""
    ids = queue.select("txn_id")
    return keep_possible(contributions, "txn_id", ids).join(ids, "txn_id")


def top_drivers(contributions: DataFrame, n: int = TOP_DRIVERS) -> DataFrame:
    """Long form: one row per transaction and driver, ranked from 1, with the direction in
    which it moves the score."""
    impact = F.col("shap_impact")
    return (
        contributions.select(
            "txn_id", F.posexplode(_strongest(F.col("drivers"), n)).alias("pos", "d")
        )
        .select("txn_id", (F.col("pos") + 1).alias("rank"), *(f"d.{c}" for c in _DRIVER_FIELDS))
        .withColumn(
            "direction", F.when(impact > 0, "up").when(impact < 0, "down").otherwise("none")
        )
    )


def explanations(
    contributions: DataFrame, n: int = TOP_DRIVERS, score: str = "score", label: str = "isFraud"
) -> DataFrame:
    """One nested document per transaction."""
    return contributions.select(
        F.col("txn_id").alias("transaction_index"),
        F.col(score).alias("predicted_risk_score"),
        F.col(label).cast("int").alias("actual_is_fraud_label"),
        ranked_drivers(F.col("drivers"), n).alias("top_risk_drivers"),
    )


def global_importance(contributions: DataFrame, n: int = IMPORTANCE_ROWS) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return (
        contributions.select(F.inline("drivers"))
        .groupBy("feature")
        .agg(F.avg(F.abs("shap_impact")).alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "feature")
        .limit(n)
    )


def riskiest(contributions: DataFrame, score: str = "score") -> DataFrame:
    """The explanation of the highest score, the lowest id of equals; only that one row has
    its drivers ranked."""
    return explanations(top_risk(contributions, 1, score), score=score)


def driver_table(explained: DataFrame) -> DataFrame:
    """Drivers for presentation, weakest push first within a transaction, with texts of two
    decimals."""
    ordered = F.sort_array(
        F.transform(
            "top_risk_drivers",
            lambda d: F.struct(d["shap_impact"].alias("shap_impact"), d["feature"], d["actual_value"]),
        )
    )
    return explained.select("transaction_index", F.posexplode(ordered).alias("position", "d")).select(
        "transaction_index",
        "position",
        "d.feature",
        "d.shap_impact",
        "d.actual_value",
        fixed(F.col("d.shap_impact"), 2).alias("shap_text"),
        fixed(F.col("d.actual_value"), 2).alias("value_text"),
    )


def queue_summary(queue: DataFrame, score: str = "predicted_risk_score") -> DataFrame:
    """Length and mean risk of a queue; 0 for an empty one."""
    return queue.agg(
        F.count(F.lit(1)).alias("queue_size"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("avg_risk_score"),
    )
