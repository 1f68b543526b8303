"""Packing against the tokenizers library, whitening against dense eigenvectors."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskflow.llm import packing, queries, whitening

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(text: str | None) -> np.ndarray:
    return np.array(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check_pieces(rows, texts: dict, context: int = 1024) -> Counter:
    """Every id of every document in one piece, sequences gapless; returns the sequences' lengths."""
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by) == set(texts)
    for doc, pieces in by.items():
        ids, at = library_ids(texts[doc]), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert bytes(r.ids) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    lengths: Counter = Counter()
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert len({(r.tier, r.step_group) for r in pieces}) == 1 and pieces[0].tier == at <= context
        lengths[at] += 1
    return lengths


def test_encoder_equals_the_library():
    encode, library = packing.encoder(PATH).encode, Tokenizer.from_file(PATH)
    rng = random.Random(5)
    alphabet = [*"ab'srevldtm  \n\t!?.,19", "é", "ß", "世", "\xa0", "\x1c", "\x85", "😀", "<|endoftext|>", "'re", "----", " ", " "]
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20)))
        assert encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("partitions", [1, 9])
def test_pack(spark, small, partitions):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()} | {-1: None, -2: "", -3: "a b<|endoftext|>  c", -4: "word " * 60_000}
    rows = [(i, t, 1, 1) for i, t in texts.items()]
    table = spark.createDataFrame(rows, "doc_id long, text string, start int, tier int").repartition(partitions)
    lengths = check_pieces(packing.pack(table, PATH).collect(), texts)
    assert all(n & (n - 1) == 0 for n in lengths)  # nothing is padded
    assert sum(k for n, k in lengths.items() if n < 128) <= 7


def test_pack_groups_are_alike(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").coalesce(1)
    rows = packing.pack(docs, PATH, group_tokens=8192).collect()
    tokens, cost, tier = Counter(), Counter(), {}
    for r in rows:
        tokens[r.step_group] += r.length
        cost[r.step_group] += r.length**2
        tier[r.step_group] = r.tier
    assert max(tokens.values()) == 8192 and len(tokens) <= sum(tokens.values()) / 8192 + 8
    each = [cost[g] / tokens[g] for g in tokens if tier[g] == 1024]
    assert len(each) > 8 and max(each) <= 1.3 * min(each)


def test_pack_odd_rows(spark):
    schema = "doc_id long, text string, ids string"
    same = spark.createDataFrame([(None, "one two", "x"), (5, "one two", "x"), (5, "one two", "x")], schema)
    rows = packing.pack(same, PATH).collect()
    size = len(library_ids("one two"))
    assert Counter({None: size, 5: 2 * size}) == sum((Counter({r.doc_id: r.length}) for r in rows), Counter())
    assert packing.pack(spark.createDataFrame([], schema), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(same, PATH, context=1000)


def test_packing_query_digest(spark, small):
    rows = queries.op12_packing(spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in rows[::17]:
        ids = library_ids(texts[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


@pytest.mark.parametrize("kind", ["plain", "graded", "flat", "copies", "identity", "tie"])
@pytest.mark.parametrize("size", [1, 2, 5, 40])
def test_directions(kind, size):
    a = np.random.default_rng(1).standard_normal((90, size))
    if kind == "graded":
        a = a * np.logspace(0, -6, size)
    elif kind == "flat":
        a[:, -1] = 0
    elif kind == "copies" and size > 2:
        a[:, 2] = a[:, 1]
    elif kind == "identity":
        a = np.eye(90, size)
    elif kind == "tie":
        a = np.linalg.qr(a)[0] * np.repeat([3.0, 1.0], [size // 2, size - size // 2])
    squares, vectors = whitening.directions(np.linalg.qr(a, mode="r"), 16)
    true = np.linalg.svd(a, compute_uv=False) ** 2
    assert len(squares) == min(16, int((true > true[0] * 1e-20).sum())) or kind == "flat" and size == 1
    assert squares == pytest.approx(true[: len(squares)], rel=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(len(squares))).max(initial=0) < 1e-10
    assert np.abs(a.T @ (a @ vectors) - vectors * squares).max(initial=0) <= 1e-12 * true[0]


def dense(vectors: dict[int, list[float]], count: int = 16):
    x = {i: np.floor(64 * np.array(v, float)) + 1e6 for i, v in vectors.items()}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, total = len(fit), fit.sum(axis=0)
    cov = (fit - total / n).T @ (fit - total / n) / n
    values, columns = np.linalg.eigh(cov)
    values, columns = values[::-1], columns[:, ::-1][:, :count]
    exact = lambda v: int(((n * v - total).astype(object) ** 2).sum())
    rows = {i: (exact(v), (v - total / n) @ columns / np.sqrt(values[:count])) for i, v in x.items()}
    return n, rows, values[:count] / values.sum()


@pytest.mark.parametrize("partitions", [1, 9])
def test_whiten(spark, small, partitions):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    vectors = {r.vec_id: list(r.embedding) for r in table.collect()}
    vectors |= {1000 + k: vectors[0] for k in range(40)}  # copies count once
    rows = [(i, v, "x", 0.0) for i, v in vectors.items()]
    odd = [(-1, None), (-2, [1.0, None] * 32), (-3, [float("nan")] * 64), (-4, [float("inf")] * 64), (-5, []), (-6, [1.0])]
    schema = "vec_id long, embedding array<float>, x string, deviation double"
    frame = spark.createDataFrame(rows + [(i, v, "x", 0.0) for i, v in odd], schema).repartition(partitions)
    n, true, explained = dense(vectors)
    got = defaultdict(dict)
    for r in whitening.whiten(frame).collect():
        got[r.vec_id][r.component] = r
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
    assert set(got) == set(vectors) and all(sorted(g) == list(range(1, 17)) for g in got.values())
    signs = np.sign(sum(true[i][1] * [got[i][k].whitened for k in range(1, 17)] for i in vectors))
    for i, (deviation, whitened) in true.items():
        assert got[i][1].deviation == deviation
        assert signs * [got[i][k].whitened for k in range(1, 17)] == pytest.approx(whitened, abs=1e-8)


def test_whiten_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    line = spark.createDataFrame([(1, [0.0, 1.0]), (None, [4.0, 1.0]), (3, [1e19, 1.0])], schema)  # no long for 1e19
    rows = {r.vec_id: r for r in whitening.whiten(line).collect()}
    assert set(rows) == {1, None} and rows[1].component == 1 and rows[1].explained == pytest.approx(1.0)
    assert abs(rows[1].whitened) == pytest.approx(1.0) and rows[1].deviation == 256**2
    far = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1e15, 1.0])], schema)  # squares beyond a long
    assert {(r.deviation, round(abs(r.whitened), 9)) for r in whitening.whiten(far).collect()} == {(None, 1.0)}
