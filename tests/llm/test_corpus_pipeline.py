"""The pipeline's stages on rows with nulls, repeats, long texts and columns of clashing names."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark, small):
    """The small documents with odd rows; ``gone``, ``hits``, ``rate`` and ``kept_id`` are names the
    stages use themselves."""
    rng = random.Random(1)
    base = spark.read.parquet(f"{small}/documents.parquet").select(*COLUMNS)
    plain = base.first()
    long = "\n".join(" ".join(f"w{rng.randint(0, 9999)}" for _ in range(30)) for _ in range(3000))
    odd = [
        (None, plain.text, "en", None, 1),
        (10**6, None, None, None, None),
        (10**6 + 1, "", "de", "s", 0),
        (10**6 + 2, plain.text, plain.lang, plain.source, plain.n_chars),
        (10**6 + 2, plain.text, plain.lang, plain.source, plain.n_chars),
        (10**6 + 3, long, "en", "s", len(long)),
        (10**6 + 4, "a b " * 5000, "en", "s", 20000),
    ]
    both = base.unionByName(spark.createDataFrame(odd, base.schema))
    return both.selectExpr("*", "1 as gone", "'x' as hits", "0.5D as rate", "7 as kept_id")


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stage(spark, small, docs, number):
    name, stage = corpus_pipeline.STAGES[number]
    rows = stage(spark, docs, small)
    last = number == len(corpus_pipeline.STAGES) - 1
    assert rows.columns[: len(docs.columns)] == docs.columns and len(rows.columns) == len(docs.columns) + last
    ids = [r.doc_id for r in rows.select("doc_id").collect()]
    known = {r.doc_id for r in docs.select("doc_id").collect()}
    assert set(ids) <= known
    if name == "line dedup":
        assert len(ids) == docs.count()
    if name == "n-gram Jaccard join":  # the copies of a document go, rows without words stay
        assert 10**6 + 2 not in ids and {10**6, 10**6 + 1, 10**6 + 3} <= set(ids)
    empty = stage(spark, docs.limit(0), small)
    assert empty.columns == rows.columns and empty.count() == 0
