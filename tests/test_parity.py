"""Every registered query against its SQL, and row counts for those without."""

import pytest

import __spark_entry__ as entry
from parity import differences, duck
from riskflow.plans.oracle import all_sql
from riskflow.plans.queries import all_queries

WITHOUT_SQL = {
    "model_train",
    "model_score",
    "model_metrics",
    "model_contributions",
    "scoring_stream",
}


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_only_model_queries_lack_sql():
    assert set(all_queries()) - set(all_sql()) == WITHOUT_SQL
    assert set(all_queries()) <= set(entry.queries())
    assert set(all_sql()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, small, con, name):
    assert differences(all_queries()[name](spark, small), con, all_sql()[name]) is None


def test_entry_has_one_row_per_threshold(spark):
    assert entry.entry(spark).count() == 99


@pytest.mark.parametrize("sf, rows, accounts, fraud", [("0.001", 1000, 15, 25), ("0.01", 10000, 150, 240)])
def test_transactions_have_the_known_counts(spark, sf, rows, accounts, fraud):
    from pyspark.sql import functions as F

    from riskflow.plans.testdata import transactions

    found = transactions(spark, f"/root/testdata/sf{sf}").agg(
        F.count("*"), F.countDistinct("nameOrig"), F.sum("isFraud")
    )
    assert tuple(found.first()) == (rows, accounts, fraud)
