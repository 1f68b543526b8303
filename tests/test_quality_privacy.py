import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas
from riskflow.operators import privacy, quality, split
from riskflow.operators.skew import HotKeys

RAW = "step long, type string, amount double, nameOrig string, nameDest string, isFraud int, isFlaggedFraud int"
DIRTY = [
    (1, "PAYMENT", -1.0, "C1", "M1", 0, 0),
    (2, "PAYMENT", float("nan"), "C1", "M1", 2, 0),
    (-3, None, None, None, "M1", None, 0),
    (4, "OTHER", 1.0, "C2", None, 1, 0),
]


def test_dq_report_counts_each_violation(spark):
    report = {r[0]: r[1] for r in quality.dq_report(spark.createDataFrame(DIRTY, RAW)).collect()}
    assert report == {
        "negative_amount": 2,
        "null_amount": 1,
        "invalid_label": 1,
        "negative_step": 1,
        "null_step": 0,
        "unknown_type": 2,
        "null_origin": 1,
        "null_target": 1,
    }


def test_dq_report_of_nothing_is_all_zero(spark):
    report = quality.dq_report(spark.createDataFrame([], RAW))
    assert {r["violations"] for r in report.collect()} == {0}


@pytest.mark.parametrize("bad", [DIRTY[0], DIRTY[1], (-1, "DEBIT", 1.0, "a", "b", 0, 0), (1, "DEBIT", 1.0, "a", "b", 7, 0)])
def test_enforce_fails_on_a_violation(spark, bad):
    with pytest.raises(PySparkException, match="Negative transaction amount"):
        quality.enforce(spark.createDataFrame([bad], RAW)).collect()


def test_enforce_passes_nulls_and_empty_input(spark):
    fine = [(1, None, None, None, None, None, None), (0, "DEBIT", 0.0, "a", "b", 1, 0)]
    assert quality.enforce(spark.createDataFrame(fine, RAW)).count() == 2
    assert quality.enforce(spark.createDataFrame([], RAW)).count() == 0


def test_type_checks(spark):
    text = spark.createDataFrame([("1", "x"), ("b", "2.5"), (None, None)], "step string, amount string")
    assert set(quality.schema_mismatches(text)) == {"step", "amount"}
    assert {tuple(r) for r in quality.failed_casts(text).collect()} == {("step", 1), ("amount", 1)}
    assert quality.failed_casts(spark.createDataFrame([], RAW)).count() == 0


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="nameDest"):
        privacy.require_columns(spark.createDataFrame([], RAW).drop("nameDest"))


def test_leakage_columns_go_and_absent_ones_are_ignored(spark):
    df = spark.createDataFrame([], "step long, oldbalanceOrg double")
    assert privacy.drop_leakage(df).columns == ["step"]


def test_hash_equals_hashlib_and_null_stays_null(spark):
    df = spark.createDataFrame([("C1", "M9"), (None, "M1")], "nameOrig string, nameDest string")
    got = privacy.hash_identifiers(df, "s").orderBy("account_id").collect()
    assert got[0]["account_id"] is None
    assert got[1]["account_id"] == hashlib.sha256(b"C1_s").hexdigest()
    assert privacy.hash_identifiers(df).columns == ["account_id", "counterparty_id"]


def test_joined_ids_equal_hashed_ids_with_hot_and_null_names(spark):
    rows = [(i, "hot" if i % 3 else None, f"M{i % 5}") for i in range(90)] + [(99, "C1", None)]
    df = spark.createDataFrame(rows, "txn_id long, nameOrig string, nameDest string")
    want = sorted(map(str, privacy.hash_identifiers(df).collect()))
    mapping = privacy.identifier_map(df)
    for hot in (HotKeys((), 1), HotKeys(("hot", None), 1)):
        got = privacy.join_identifiers(df, mapping, hot, HotKeys(("M1",), 1))
        assert sorted(map(str, got.select("txn_id", "account_id", "counterparty_id").collect())) == want


def test_split_is_total_and_disjoint(spark):
    days = spark.createDataFrame([(d, d % 2) for d in (0, 20, 21, 25, 26, 30)], "day int, isFraud int")
    parts = split.time_split(days)
    assert [p.count() for p in parts] == [2, 2, 2]
    named = {r["day"]: r["split"] for r in split.add_split(days).collect()}
    assert named == {0: "train", 20: "train", 21: "val", 25: "val", 26: "test", 30: "test"}
    rates = {r["split"]: r["fraud_rate_pct"] for r in split.split_sanity(days).collect()}
    assert rates == {"train": 0.0, "val": 100.0, "test": 0.0}
    nothing = split.split_sanity(days.filter("day < 21"))
    assert {tuple(r) for r in nothing.collect()} == {("train", 2, 0, 0.0), ("val", 0, 0, 0.0), ("test", 0, 0, 0.0)}


def test_class_balance(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "isFraud int")
    assert tuple(split.class_balance(df).first()) == (1, 3, 3.0)
    assert tuple(split.class_balance(df.limit(0)).first()) == (0, 0, 0.0)


def test_feature_matrix_names_missing_columns(spark):
    with pytest.raises(ValueError, match="amount"):
        split.feature_matrix(spark.range(1).select(F.col("id").alias("txn_id")))


def test_raw_schema_covers_required_columns():
    from riskflow.constants import LEAKAGE_COLUMNS, REQUIRED_COLUMNS

    assert set(schemas.RAW.names) == set(REQUIRED_COLUMNS) | set(LEAKAGE_COLUMNS)


def test_misfits_are_named_and_counted_while_rows_pass(spark, tmp_path):
    from pyspark.sql import Observation

    from riskflow.sources import tables

    path = str(tmp_path / "raw.csv")
    head = ",".join(schemas.RAW.names)
    lines = [
        "1,PAYMENT,10.5,C1,1,1,M1,0,0,0,0",
        "x,PAYMENT,ten,C1,1,1,M1,0,0,0,0",
        "2,DEBIT,3,C2,1,1,M2,0,0,maybe,0",
        "3,DEBIT,3,C2,1,1,M2,0,0,1,0,9,9",
        ",,,,,,,,,,",
    ]
    (tmp_path / "raw.csv").write_text("\n".join([head, *lines]))
    raw = quality.with_misfits(tables.read_csv(spark, path, T.StructType([]), keep_corrupt=True))
    assert [(f.name, f.dataType) for f in raw.schema.fields][:-2] == [(f.name, f.dataType) for f in schemas.RAW.fields]
    seen = Observation("ingest")
    rows = raw.observe(seen, *quality.ingest_metrics()).collect()
    assert [sorted(r.misfits) for r in rows] == [[], ["amount", "step"], ["isFraud"], ["layout"], []]
    found = {k: v for k, v in seen.get.items() if v}
    assert found == {"lines": 5, "quarantined": 3, "misfit_amount": 1, "misfit_step": 1, "misfit_isFraud": 1, "misfit_layout": 1}
    assert raw.where("size(misfits) > 0").select("nameOrig").count() == 3


def test_prefilter_keeps_every_wanted_row_and_exchanges_few(spark):
    from riskflow.operators import prefilter

    rows = spark.range(100_000).select(F.col("id").alias("txn_id"), (F.col("id") % 7).alias("score"))
    rows = rows.union(spark.createDataFrame([(None, 1)], "txn_id long, score long"))
    wanted = spark.createDataFrame([(i * 997,) for i in range(200)] + [(None,), (5,), (5,)], "txn_id long")
    kept = prefilter.keep_possible(rows, "txn_id", wanted)
    ids = [r.txn_id for r in kept.collect()]
    assert kept.columns == rows.columns and len(ids) == len(set(ids))
    assert {i * 997 for i in range(101)} | {5} <= set(ids) and len(ids) < 120
    assert prefilter.keep_possible(rows, "txn_id", wanted.limit(0)).count() == 0


def test_audit_join_does_not_exchange_the_score_table(spark, tmp_path):
    """The scores meet the bitmap of wanted ids before the first exchange."""
    from riskflow.operators import narrative, policy

    path = str(tmp_path / "scored")
    spark.range(1000).selectExpr("id as txn_id", "id / 1000 as score").write.parquet(path)
    checked = spark.createDataFrame([(i, 5, True, None) for i in (3, 4, 2000)], "txn_id long, latency_ms long, guardrail_passed boolean, error string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        audit = narrative.audit_records(policy.apply_policy(spark.read.parquet(path)), checked)
        plan = audit._jdf.queryExecution().executedPlan().toString()
        rows = {r.transaction_index: r.decision for r in audit.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == {3: "APPROVE", 4: "APPROVE", 2000: None}
    side = plan[plan.index("SortMergeJoin") :]
    scan = side[: side.index("FileScan")]
    assert scan.rindex("BroadcastHashJoin") > scan.rindex("Exchange hashpartitioning(txn_id")
