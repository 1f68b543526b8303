"""Models are learned from all their training rows."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import common, language_model, mixing, quality, symbols, toxicity


def test_language_model_learns_from_rare_triples():
    """A triple that next to none of a drawn sample would hold still moves its symbols."""
    size, width = language_model.SIZE, language_model.WIDTH
    rng = np.random.default_rng(1)
    p = {k: rng.normal(0, 0.1, s).astype(np.float32) for k, s in {"r": (size, width), "q": (size, width)}.items()}
    p |= {"ca": np.eye(width, dtype=np.float32), "cb": np.eye(width, dtype=np.float32), "bias": np.zeros(size, np.float32)}
    grams, counts = np.array([(1 * size + 2) * size + 3, (4 * size + 5) * size + 6]), np.array([100_000, 1])
    noise = np.full(size, 1 / size)
    new = language_model.train_shard(p, grams, counts, noise, 0)
    moved = {i for i in range(size) if (new["r"][i] != p["r"][i]).any()}
    assert moved == {1, 2, 4, 5}
    doubled = language_model.train_shard(p, grams, 2 * counts, noise, 0)
    assert all(np.allclose(new[k], doubled[k], atol=1e-6) for k in p)


def test_quality_learns_from_all_trusted_texts(spark, monkeypatch):
    n = 20_100
    docs = spark.range(n).selectExpr("id as doc_id", "'alpha beta' as text", "'en' as lang")
    labels = spark.range(n).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    found = []
    monkeypatch.setattr(quality, "kneser_ney", lambda triples, size: found.append(triples.agg(F.sum("n")).first()[0]))
    quality.fit(docs, labels)
    assert found == [2 * n]


def test_labels_of_all_documents_are_used(spark):
    n = 20_100
    docs = spark.range(n).selectExpr("id as doc_id", "if(id % 4 = 0, 'alpha blarg', 'alpha beta') as text", "'en' as lang")
    labels = spark.range(n).selectExpr("id as doc_id", "int(id % 3 > 0) as quality", "int(id % 4 = 0) as toxic")
    model = mixing.fit_classifier(docs, labels)
    sizes = {d: round(math.exp(p) * (n + 2) - 1) for d, p in zip(model.domains, model.log_prior, strict=True)}
    assert sizes == {"en": n * 2 // 3, "poor": n // 3}
    lexicon = toxicity.fit(docs, common.chosen_labels(labels, "toxic"))
    weight = math.log((n // 4 + 0.5) / (n // 4 + 1)) - math.log(0.5 / (n - n // 4 + 1))
    assert lexicon.weights[" blar"] == pytest.approx(weight, rel=1e-12)


@pytest.mark.parametrize("key", ["long", "int", "string"])
def test_only_labelled_texts_are_exchanged(spark, tmp_path, key):
    """Whatever the size of the labels; a document without label leaves before the exchange."""
    docs = spark.range(4000).selectExpr(f"cast(id as {key}) as doc_id", "string(id) as text", "'en' as lang")
    docs = docs.union(docs.where("text < '20'")).union(docs.selectExpr("null", "text", "lang").limit(3))
    docs.write.parquet(f"{tmp_path}/docs")
    labels = spark.range(0, 8000, 5).selectExpr("id as doc_id", "int(id % 3 > 0) as quality", "null as toxic")
    labels = common.chosen_labels(labels, "quality")
    if key == "long":
        docs = spark.read.parquet(f"{tmp_path}/docs")
    plain = docs.join(labels, docs["doc_id"] == labels["label_id"]).select("text", "label")
    found = common.labelled(docs, labels, "text")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    assert found.count() > 800
    if key == "long":
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan
        exchanged = common.keep_possible(docs.withColumnRenamed("doc_id", "label_id"), "label_id", labels).count()
        assert found.count() <= exchanged < 1.1 * found.count()


def test_rounds_of_the_mix_fold_over_few_steps(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(1, 50)), rng.dirichlet([0.3, 0.3, 0.3]).tolist()) for _ in range(60)]
    scored = spark.createDataFrame(rows, "tokens long, posterior array<double>")
    lengths, plain = [], mixing._stepped
    monkeypatch.setattr(mixing, "_stepped", lambda p, vectors, start: lengths.append(len(vectors)) or plain(p, vectors, start))
    mix = mixing.fit_rates(scored, ["a", "b", "c"], {"a": 0.98, "b": 0.01, "c": 0.01}, rounds=15, tolerance=1e-14)
    assert len(mix.steps) == len(lengths) > mixing.STORE_EVERY == max(lengths)
    rated = scored.withColumn("rate", mixing.rate(F.col("posterior"), mix)).collect()
    sums = [sum(r.tokens * r.rate * r.posterior[i] for r in rated) for i in range(3)]
    assert mix.reached == pytest.approx(sums, rel=1e-9)


def test_rates_are_worked_out_once(spark):
    docs = spark.range(40).selectExpr(
        "id as doc_id", "if(id % 4 = 0, 'alpha blarg', concat('beta gamma ', id)) as text", "if(id % 4 = 0, 'de', 'en') as lang"
    )
    docs = docs.union(docs.limit(2)).union(docs.selectExpr("null", "null", "lang").limit(1))
    labels = spark.range(40).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    rated = mixing.add_rate(docs, labels, "rate", {"en": 1.0, "de": 0.0})
    kept = mixing.wanted(rated, "rate")
    hashes = [df._jdf.queryExecution().optimizedPlan().toString().count("xxhash64") for df in (rated, kept)]
    assert hashes[0] == hashes[1] and kept.columns == rated.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in rated.collect() if r.rate > 0)
    assert 0 < kept.count() < rated.count()


def test_quality_tells_all_words_apart(spark, monkeypatch):
    """Texts of the same symbols differ by their words, however rare; each word's probability is
    its discounted count, without the document's own; kept counts and joined ones agree."""
    rng = np.random.default_rng(5)
    vocabulary = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, 6)) for _ in range(1500)]
    texts = [" ".join(vocabulary[min(int(rng.zipf(1.3)) - 1, 1499)] for _ in range(60)) for _ in range(200)]
    trusted = [*texts, "seldom twice", "seldom thrice", "lonely words"]
    extra = ["seldom", "never", "never never", "", None]
    rows = [(i, t, "en") for i, t in enumerate([*trusted, *extra])] + [(None, "seldom", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(trusted))], "doc_id long, quality int, toxic int")

    def found():
        return [tuple(r) for r in quality.report(docs, labels).orderBy("doc_id").collect()]

    plain = found()
    by_id = {r[0]: r for r in plain}
    at = len(trusted)
    assert by_id[at][3] * 1.5 < by_id[at + 1][3]  # one symbol, yet one word is known
    assert by_id[None][3] == by_id[at][3] and by_id[at + 3][3] is None

    model, counts, _ = quality.fit(docs, labels)
    known = Counter(w for t in trusted for w in quality.fresh_words(t.encode()))
    assert counts.count() == len(known) and counts.agg(F.sum("n")).first()[0] == sum(known.values())
    frequent = {w for w in known if symbols.word_hash(w) in model.frequent}
    classed = {w: n for w, n in known.items() if w not in frequent}
    of_class = Counter()
    for w, n in classed.items():
        of_class[quality.shape(w)] += n
    off = dict(enumerate(model.discounts, 1))
    freed = Counter()
    for w, n in classed.items():
        freed[quality.shape(w)] += off[min(n, 3)]
    encode = quality.encoder(model.frequent)
    for i, text in enumerate([*trusted, *extra[:3]]):
        s, words = encode(text.encode()), text.encode().split()
        log = sum(float(model.table[a, b, c]) for a, b, c in zip(s, s[1:], s[2:]))
        own = Counter(quality.fresh_words(text.encode())) if i < len(trusted) else Counter()
        for a, w in zip([None, *words], words):
            if w != a and w not in frequent:
                k, n = quality.shape(w), known[w] - own[w]
                log += math.log10(((n - off[min(n, 3)] if n else 0) + freed[k] / (len(known) + 1)) / of_class[k])
        assert by_id[i][3] == pytest.approx(10 ** (-log / len(words)), rel=1e-6)

    monkeypatch.setattr(quality, "COMMON", 50)
    joined = found()
    assert [r[:3] + r[4:] for r in joined] == [r[:3] + r[4:] for r in plain]
    assert all(a[3] == pytest.approx(b[3], rel=1e-9) for a, b in zip(joined, plain) if a[3])
    kept = quality.keep_good(docs, labels, reject_empty=True)
    assert kept.columns == docs.columns
    wanted = [(r[0], r[2]) for r in plain if not r[4] and r[2]]
    assert sorted((r.doc_id or -1, len(r.text.split())) for r in kept.collect()) == sorted((i or -1, n) for i, n in wanted)
