"""Connected components of a link table by repeated minimum labels, written out every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Columns id, component (smallest id reachable) for every id in ``links`` (a, b).

    Every round each id takes the smallest label among its own and its neighbours', then the
    label of its label (pointer jumping), so the rounds grow with the logarithm of the longest
    chain. Labels are aggregated before the shuffle, so a hub costs no more than its links.
    """
    edges = stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["id"]).groupBy(F.col("a").alias("to")).agg(F.min("component").alias("near"))
        best = labels.join(near, labels["id"] == near["to"]).select(
            "id", F.least("component", "near").alias("best"), F.col("component").alias("old")
        )
        jump = labels.select(F.col("id").alias("at"), F.col("component").alias("over"))
        step = stored(
            best.join(jump, best["best"] == jump["at"], "left").select(
                "id", F.least("best", F.coalesce("over", "best")).alias("component"), "old"
            ),
            "labels",
        )
        changed = step.where("component <> old").limit(1).count()
        labels = step.select("id", "component")
        if not changed:
            return labels
