"""Account windows against a plain Python loop, on the plain and on the chunked route."""

import random

import pytest
from pyspark.sql import functions as F

from riskflow.operators import features
from riskflow.operators.account_windows import ROLLING, SEQUENCE, account_windows, _with_chunks
from riskflow.operators.skew import HotKeys, hot_keys

SCHEMA = "txn_id long, account string, step long, type string, amount double"


def expected(rows, frame):
    """Per txn_id: count, mean, gap, last transfer step."""
    by_account, out = {}, {}
    for row in rows:
        by_account.setdefault(row[1], []).append(row)
    for history in by_account.values():
        history.sort(key=lambda r: (r[2], r[0]))
        transfer = None
        for i, (txn_id, _, step, kind, _) in enumerate(history):
            if frame == "rows":
                seen = history[max(0, i - 23) : i + 1]
            else:
                seen = [r for r in history if step - 23 <= r[2] <= step]
            if kind == "TRANSFER":
                transfer = step
            known = [r[4] for r in seen if r[4] is not None]
            mean = sum(known) / len(known) if known else None
            gap = step - history[i - 1][2] if i else None
            out[txn_id] = (len(seen), mean, gap, transfer)
    return out


def random_rows(seed, n=1500, accounts=(None, "a", "b", "c"), hours=60, weights=(2, 10, 3, 1)):
    rng = random.Random(seed)
    kinds = ["TRANSFER"] + ["CASH_OUT", "PAYMENT"] * 20
    rows = [
        (
            i * 7,
            rng.choices(accounts, weights)[0],
            min(rng.randrange(hours), rng.randrange(hours)),
            rng.choice(kinds),
            None if rng.random() < 0.02 else rng.randrange(1, 50000) / 100,
        )
        for i in range(n)
    ]
    rng.shuffle(rows)
    return rows


def windows(spark, rows, frame, hot=None, hot_rows=10**9):
    df = spark.createDataFrame(rows, SCHEMA)
    made = account_windows(
        df,
        "account",
        ROLLING + SEQUENCE,
        frame,
        is_transfer=F.col("type") == "TRANSFER",
        hot=hot,
        hot_rows=hot_rows,
    )
    assert made.columns == [*df.columns, *ROLLING, *SEQUENCE]
    return {r["txn_id"]: tuple(r[c] for c in ROLLING + SEQUENCE) for r in made.collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for txn_id, (n, mean, gap, transfer) in want.items():
        assert got[txn_id][0] == n and got[txn_id][2:] == (gap, transfer), txn_id
        assert got[txn_id][1] == (None if mean is None else pytest.approx(mean, abs=1e-9)), txn_id


@pytest.mark.parametrize("frame", ["rows", "hours"])
@pytest.mark.parametrize("hot_rows", [10**9, 300, 20, 3])
def test_windows_equal_python_loop_for_any_split(spark, frame, hot_rows):
    rows = random_rows(1)
    assert_same(windows(spark, rows, frame, hot_rows=hot_rows), expected(rows, frame))


@pytest.mark.parametrize("frame", ["rows", "hours"])
def test_account_with_one_crowded_hour(spark, frame):
    """Nearly all rows in one hour of one account, ids far apart and clustered."""
    rng = random.Random(5)
    rows = [(rng.choice([10**15, 0]) + i, "hot", 5 if i % 50 else i % 9, "TRANSFER" if i % 97 == 1 else "DEBIT", 1.0 * i) for i in range(900)]
    hot = HotKeys(("hot",), 40)
    assert_same(windows(spark, rows, frame, hot=hot), expected(rows, frame))


def test_parts_of_a_crowded_hour_hold_their_share_whatever_the_ids(spark):
    """One id far off, as numbering by file gives, must not gather the others in one part."""
    rows = [("hot", 5, i if i < 9_999 else 2**40, 1.0) for i in range(10_000)]
    df = spark.createDataFrame(rows, "account string, step long, txn_id long, amount double")
    cut, _ = _with_chunks(df, "account", "txn_id", 100)
    sizes = [r["count"] for r in cut.groupBy("account", "_hour", "_part").count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) <= 100
    spans = cut.groupBy("_part").agg(F.min("txn_id"), F.max("txn_id")).orderBy("_part").collect()
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_old_transfer_reaches_over_many_rows(spark):
    rows = [(i, "a", i // 30, "TRANSFER" if i == 0 else "DEBIT", 1.0) for i in range(300)]
    got = windows(spark, rows, "rows", hot=HotKeys(("a",), 10))
    assert {v[3] for v in got.values()} == {0}


def test_carry_over_many_levels(spark, monkeypatch):
    """Some hundred parts, three to a group: the carry passes several levels."""
    monkeypatch.setattr("riskflow.operators.account_windows.FAN", 3)
    rows = random_rows(11, 700, accounts=(None, "a"), weights=(1, 5))
    assert_same(windows(spark, rows, "rows", HotKeys((None, "a"), 12), 12), expected(rows, "rows"))
    old = [(i, "a", i // 30, "TRANSFER" if i == 0 else "DEBIT", 1.0) for i in range(300)]
    got = windows(spark, old, "rows", HotKeys(("a",), 10), 10)
    assert {v[3] for v in got.values()} == {0}


@pytest.mark.parametrize("frame", ["rows", "hours"])
def test_both_routes_agree_to_the_last_bit(spark, frame):
    """Amounts whose sum depends on the order in floating point."""
    rng = random.Random(13)
    rows = [(i, "a", rng.randrange(40), "DEBIT", rng.choice([0.1, 0.7, 1e9 + 0.3, 123456.789])) for i in range(600)]
    plain = windows(spark, rows, frame)
    split = windows(spark, rows, frame, HotKeys(("a",), 30), 30)
    assert plain == split


def test_frames_of_hours_keep_nan_and_null(spark):
    rows = [(1, "a", 0, "DEBIT", None), (2, "a", 1, "DEBIT", 2.0), (3, "a", 2, "DEBIT", float("nan")), (4, "a", 40, "DEBIT", 4.0)]
    for hot in (None, HotKeys(("a",), 2)):
        got = windows(spark, rows, "hours", hot, 2 if hot else 10**9)
        assert got[1][:2] == (1, None) and got[2][:2] == (2, 2.0) and got[4][:2] == (1, 4.0)
        assert got[3][0] == 3 and got[3][1] != got[3][1]


def test_windows_do_not_depend_on_partitions(spark):
    rows = random_rows(3, 400)
    results = []
    for n in (1, 4, 17):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(windows(spark, rows, "rows", hot_rows=100))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1] == results[2]


def test_hot_keys_are_exact_and_count_null_as_a_key(spark):
    rows = [("a",)] * 50 + [(None,)] * 40 + [(str(i),) for i in range(500)] + [("b",)] * 10
    df = spark.createDataFrame(rows, "k string")
    hot = hot_keys(df, "k", 20)
    assert sorted(hot.values, key=str) == [None, "a"] and hot.limit == 20
    marked = df.select("k", hot.match(F.col("k")).alias("hot"))
    assert {(r[0], r[1]) for r in marked.filter("hot").collect()} == {("a", True), (None, True)}
    assert marked.filter("hot is null").count() == 0
    assert hot_keys(df, "k", 60).values == ()
    assert hot_keys(df.limit(0), "k", 60).values == ()


def test_unknown_frame_is_refused(spark):
    with pytest.raises(ValueError, match="frame"):
        account_windows(spark.createDataFrame([], SCHEMA), "account", frame="days")


# -- derived features ---------------------------------------------------------------------

RAW = "txn_id long, step long, type string, amount double, nameOrig string, nameDest string, isFraud int, isFlaggedFraud int"


def table(spark, rows):
    """rows of (txn_id, account, step, type, amount)"""
    raw = [(i, s, t, a, n, "M1", 0, 0) for i, n, s, t, a in rows]
    return {r["txn_id"]: r for r in features.feature_table(spark.createDataFrame(raw, RAW)).collect()}


def test_recency_of_first_row_is_zero_and_gap_is_capped(spark):
    steps = [0, 0, 167, 335, 504]
    got = table(spark, [(i, "C1", s, "DEBIT", 1.0) for i, s in enumerate(steps)])
    assert [got[i]["time_since_last_txn_hr"] for i in range(5)] == [0, 0, 167, 168, 168]


def test_cash_out_within_six_hours_of_a_transfer(spark):
    rows = [(1, "C1", 1, "TRANSFER", 1.0)]
    rows += [(i, "C1", s, "CASH_OUT", 1.0) for i, s in ((2, 3), (3, 7), (4, 8))]
    rows += [(5, "C2", 3, "CASH_OUT", 1.0)]
    got = table(spark, rows)
    assert [got[i]["transfer_in_last_6h"] for i in range(1, 6)] == [1, 1, 1, 0, 0]
    assert [got[i]["transfer_then_cashout_6h"] for i in range(1, 6)] == [0, 1, 1, 0, 0]


def test_ties_in_an_hour_go_by_id(spark):
    rows = [(3, "C1", 5, "CASH_OUT", 30.0), (1, "C1", 5, "CASH_OUT", 10.0), (2, "C1", 5, "TRANSFER", 20.0)]
    got = table(spark, rows)
    assert [got[i]["transfer_then_cashout_6h"] for i in (1, 2, 3)] == [0, 0, 1]
    assert [got[i]["avg_amount_24h"] for i in (1, 2, 3)] == [10.0, 15.0, 20.0]


def test_rows_and_hours_differ_on_a_long_account(spark):
    raw = [(i, 2 * i, "DEBIT", float(i), "C1", "M1", 0, 0) for i in range(1, 31)]
    tx = spark.createDataFrame(raw, RAW)
    by_rows = {r[0]: r[1:] for r in features.preprocess(tx).select("txn_id", "txn_count_24h", "avg_amount_24h").collect()}
    by_hours = {r[0]: r[1] for r in features.preprocess(tx, frame="hours").select("txn_id", "txn_count_24h").collect()}
    assert by_rows[24] == (24, 12.5) and by_rows[25] == (24, 13.5)
    assert by_hours[24] == 12


def test_time_parts_of_negative_steps(spark):
    df = spark.createDataFrame([(-1,), (0,), (5,), (6,), (24,), (743,)], "step long")
    got = [tuple(r) for r in features.add_time_features(df).orderBy("step").collect()]
    assert got == [(-1, 23, -1, 0), (0, 0, 0, 1), (5, 5, 0, 1), (6, 6, 0, 0), (24, 0, 1, 1), (743, 23, 30, 0)]


def test_unseen_type_has_all_zero_flags(spark):
    df = spark.createDataFrame([("TRANSFER",), ("OTHER",), (None,)], "type string")
    got = sorted(sum(r) for r in features.one_hot_types(df).collect())
    assert got == [0, 0, 1]


def test_broken_values_stop_the_job_unless_told_otherwise(spark):
    raw = [(1, 1, "DEBIT", -1.0, "C1", "M1", 0, 0), (2, 1, "DEBIT", None, "C1", "M1", 0, 0)]
    tx = spark.createDataFrame(raw, RAW)
    for build in (features.preprocess, features.feature_table):
        with pytest.raises(Exception, match="Negative transaction amount"):
            build(tx).collect()
        assert build(tx, strict=False).count() == 2
        assert build(tx.filter("txn_id = 2")).count() == 1


def test_a_table_without_ids_is_refused(spark):
    with pytest.raises(ValueError, match="txn_id"):
        features.preprocess(spark.createDataFrame([], RAW).drop("txn_id"))


def test_staged_and_fused_routes_agree(spark, small):
    from riskflow.plans.testdata import transactions

    tx = transactions(spark, small)
    staged = features.behavior_features(features.preprocess(tx))
    fused = features.feature_table(tx)
    assert sorted(staged.columns) == sorted(fused.columns)
    assert staged.select(fused.columns).exceptAll(fused).count() == 0
    split = features.feature_table(tx, hot_rows=30)
    assert split.exceptAll(fused).count() == 0 and split.count() == fused.count()


def test_one_account_exchange_and_one_window(spark, small):
    from riskflow.plans.testdata import transactions

    table = features.feature_table(transactions(spark, small))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Window") == 1
    assert "oldbalance" not in plan
