import random

import pytest
from pyspark.sql import functions as F

from riskflow.constants import THRESHOLDS
from riskflow.operators import economics, ranking

SCHEMA = "score double, isFraud int, amount double"


def naive_sweep(rows):
    loss = [a for _, y, a in rows if y == 1]
    avg = sum(loss) / len(loss) if loss else 0.0
    out = {}
    for t in THRESHOLDS:
        tn = [a for s, y, a in rows if s < t and y == 0]
        fn = [a for s, y, a in rows if s < t and y == 1]
        fp = sum(1 for s, y, _ in rows if s >= t and y == 0)
        out[t] = (sum(tn) * 0.02 - sum(fn) - fp * 5, len(tn) * avg * 1.5 * 0.02 - len(fn) * avg * 1.5 - fp * 5, fp)
    return out


def random_scored(seed, n=800, points=1000):
    rng = random.Random(seed)
    return [(rng.randrange(points + 1) / points, int(rng.random() < 0.1), rng.randrange(1, 10**6) / 100) for _ in range(n)]


def test_sweep_equals_one_pass_per_threshold(spark):
    rows = random_scored(1)
    got = economics.threshold_sweep(spark.createDataFrame(rows, SCHEMA)).collect()
    want = naive_sweep(rows)
    assert len(got) == 99
    for r in got:
        tx, proxy, fp = want[r["threshold"]]
        assert r["net_profit_tx"] == pytest.approx(tx) and r["net_profit_proxy"] == pytest.approx(proxy)
        assert r["good_users_blocked"] == fp


def test_counts_add_up_and_fall_with_the_threshold(spark):
    counts = economics.threshold_confusion(spark.createDataFrame(random_scored(2), SCHEMA)).orderBy("threshold").collect()
    assert all(r["tp"] + r["fp"] + r["tn"] + r["fn"] == 800 for r in counts)
    for column in ("tp", "fp"):
        values = [r[column] for r in counts]
        assert values == sorted(values, reverse=True)


def test_score_on_the_threshold_is_blocked(spark):
    scores = [0.0, 0.01, 0.0899999, 0.09, 0.29, 0.57, 0.99, 1.0]
    df = spark.createDataFrame([(s, 0, 1.0) for s in scores], SCHEMA)
    got = {r["threshold"]: r["fp"] for r in economics.threshold_confusion(df).collect()}
    assert got == {t: sum(s >= t for s in scores) for t in THRESHOLDS}


def test_custom_grid_and_bad_grid(spark):
    df = spark.createDataFrame(random_scored(3), SCHEMA)
    assert economics.threshold_sweep(df, [0.25, 0.5]).count() == 2
    with pytest.raises(ValueError, match="ascending"):
        economics.threshold_sweep(df, [0.5, 0.25])


def test_empty_input_and_one_class(spark):
    empty = economics.threshold_sweep(spark.createDataFrame([], SCHEMA)).collect()
    assert len(empty) == 99
    assert {(r["approval_rate_pct"], r["fraud_caught_pct"], r["net_profit_tx"]) for r in empty} == {(None, 0.0, 0.0)}
    legit = economics.threshold_sweep(spark.createDataFrame([(0.5, 0, 10.0)], SCHEMA)).collect()
    assert {r["fraud_caught_pct"] for r in legit} == {0.0} and {r["revenue_kept_proxy"] for r in legit} == {0.0}


def test_lowest_of_equal_optima_wins(spark):
    df = spark.createDataFrame([(0.0, 0, 100.0), (1.0, 1, 100.0)], SCHEMA)
    sweep = economics.threshold_sweep(df)
    assert economics.optimal_threshold(sweep).first()["threshold"] == 0.01
    assert [r["threshold"] for r in economics.top_thresholds(sweep).collect()] == [0.01, 0.02, 0.03, 0.04, 0.05]


def test_missing_score_is_refused(spark):
    df = spark.createDataFrame([(None, 0, 1.0)], SCHEMA)
    with pytest.raises(Exception, match="NaN"):
        economics.threshold_sweep(df).collect()


def test_avg_fraud_loss_and_assumptions(spark):
    df = spark.createDataFrame([(0.1, 1, 10.0), (0.1, 1, 20.0), (0.2, 0, 5.0)], SCHEMA)
    assert economics.avg_fraud_loss(df).first()[0] == 15.0
    assert economics.avg_fraud_loss(df.filter("isFraud = 0")).first()[0] == 0.0
    record = economics.econ_assumptions(df).first()
    assert record["AVG_FRAUD_LOSS"] == 15.0 and record["num_test_transactions"] == 3
    assert len(record["feature_set"]) == 17


# -- ranking -------------------------------------------------------------------------------


def naive_auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def naive_ap(rows):
    total = sum(y for _, y in rows)
    ap = 0.0
    for t in sorted({s for s, _ in rows}, reverse=True):
        above = [y for s, y in rows if s >= t]
        ap += sum(y for s, y in rows if s == t) / total * sum(above) / len(above)
    return ap


@pytest.mark.parametrize("points", [5, 40, 10**6])
@pytest.mark.parametrize("ranges", [2, 7, 1024])
def test_metrics_equal_brute_force(spark, points, ranges):
    rng = random.Random(points)
    rows = [(s, rng.randrange(points) / points, int(rng.random() < 0.3)) for s in ("a", "b") for _ in range(150)]
    df = spark.createDataFrame(rows, "split string, score double, isFraud int")
    for r in ranking.ranking_metrics(df, ranges=ranges).collect():
        mine = [(s, y) for k, s, y in rows if k == r["split"]]
        assert r["roc_auc"] == pytest.approx(naive_auc(mine), abs=1e-12)
        assert r["average_precision"] == pytest.approx(naive_ap(mine), abs=1e-12)


def test_one_class_and_null_group(spark):
    df = spark.createDataFrame([("n", 0.2, 0), ("n", 0.3, 0), ("p", 0.1, 1), (None, 0.1, 1), (None, 0.4, 0)], "split string, score double, isFraud int")
    got = {r["split"]: (r["roc_auc"], r["average_precision"]) for r in ranking.ranking_metrics(df).collect()}
    assert got == {"n": (None, 0.0), "p": (None, 1.0), None: (0.0, 0.5)}
    assert ranking.ranking_metrics(df.limit(0)).count() == 0


def test_scores_in_one_narrow_spot_still_spread_over_ranges(spark):
    df = spark.range(20000).select((F.col("id") * 1e-12).alias("score"))
    ranged = ranking.ranged_counts(df.withColumn("isFraud", F.lit(0)), [], "score", "isFraud", 64)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) > 60 and sum(sizes) == 20000 and max(sizes) < 1000
    edges = ranged.groupBy("_range").agg(F.min("_score"), F.max("_score")).orderBy("_range").collect()
    assert all(a[2] < b[1] for a, b in zip(edges, edges[1:]))


def test_rows_are_read_once(spark, tmp_path):
    """Counting, cutting into ranges and ranking take one pass over the rows."""
    path = str(tmp_path / "scored")
    spark.range(5000).select((F.col("id") % 700 / 700).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("isFraud")).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(path).mapInArrow(look, "score double, isFraud int")
    assert ranking.ranking_metrics(rows, by=()).first()["pos"] == 1667
    assert seen.value == 5000


def test_an_unknown_score_is_refused_when_ranked(spark):
    for score in (None, float("nan")):
        rows = spark.createDataFrame([(score, 1), (0.5, 0)], "score double, isFraud int")
        with pytest.raises(Exception, match="null or NaN"):
            ranking.ranking_metrics(rows, by=()).collect()


def test_money_is_not_rounded_and_misfits_stop_the_query(spark):
    rows = spark.createDataFrame([(1.005, 1), (0.004, 1)], "amount double, isFraud int")
    assert economics.avg_fraud_loss(rows).first()[0] == 0.5045
    for amount in (1e-9, 1e25, float("nan")):
        bad = spark.createDataFrame([(amount, 1)], "amount double, isFraud int")
        with pytest.raises(Exception, match="does not fit"):
            economics.avg_fraud_loss(bad).collect()
