"""Mixing sources to target weights by soft domain membership, with DataFrame operations only.

1. A naive Bayes classifier over hashed words is trained on all labelled documents; it gives every document a posterior over the domains. The table of
   log-likelihoods has buckets * domains numbers and is a literal of the plan.
2. Every document gets a nonnegative rate, how often it is to be seen. With t the document's
   tokens, p its posterior and M = sum_d t_d p_d p_d', the rates r minimise the squared length, in
   the metric of M's inverse, of sum_d r_d t_d p_d - target. Projected gradient: from rate 1, every
   document steps against the gradient in the metric of its tokens and is cut at 0. A step depends
   on a document only through p, so the rate after k steps is a fold over k vectors: each round is
   one aggregation to as many sums as there are domains; nothing else is shuffled. Rates are
   stored every few rounds, so that a round folds over the steps since then only.

Domains are the languages of well labelled documents and one for poor ones. Target weights default
to equal shares; a domain that given weights leave out keeps its share. Weights are scaled to sum
to 1 and the total of tokens stays the same. If no nonnegative rates reach the targets, the rates
are the best in the sense above. A null
or empty text has no tokens, its posterior is the prior and its rate is fitted like all others.
Rows are independent; repeated rows get equal rates. Without labelled rows there is one domain
and every rate is 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import chosen_labels, free_name, labelled, stored

BUCKETS = 1024
MAX_ROUNDS = 60
#: Rounds after which the rates are stored; until then they are worked out on the way.
STORE_EVERY = 6
TOLERANCE = 1e-4


class Classifier(NamedTuple):
    domains: list[str]
    log_prior: list[float]
    log_likelihood: list[list[float]]  # by domain, then bucket


class Mix(NamedTuple):
    domains: list[str]
    steps: list[list[float]]
    totals: list[float]
    targets: list[float]
    reached: list[float]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it. (The optimizer
    merges projections, and would repeat the value's expression at every use.)"""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_buckets(text: Column, buckets: int) -> Column:
    """Hash bucket of every word of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of all labelled documents with their domain: ``poor`` if labelled of low quality,
    else their language, ``other`` without one."""
    domain = F.when(F.col("label") == 0, "poor").otherwise(F.coalesce("lang", F.lit("other")))
    return labelled(docs, chosen_labels(labels, "quality"), "text", "lang").select("text", domain.alias("domain"))


def fit_classifier(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> Classifier:
    known = labelled_domains(docs, labels)
    # Presence per document, so that one long text does not outweigh the others.
    words = known.select("domain", F.explode_outer(F.array_distinct(word_buckets(F.col("text"), buckets))).alias("bucket"))
    counts = words.groupBy("domain", "bucket").agg(F.count("*").alias("n")).collect()
    sizes = {r.domain: r.n for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(sizes) or ["all"]
    seen = {(r.domain, r.bucket): r.n for r in counts if r.bucket is not None}
    everyone = sum(sizes.values())
    prior = [math.log((sizes.get(d, 0) + 1) / (everyone + len(domains))) for d in domains]
    likelihood = []
    for d in domains:
        total = sum(seen.get((d, b), 0) for b in range(buckets)) + buckets
        likelihood.append([math.log((seen.get((d, b), 0) + 1) / total) for b in range(buckets)])
    return Classifier(domains, prior, likelihood)


def add_posterior(docs: DataFrame, name: str, model: Classifier) -> DataFrame:
    """Add struct ``name``: tokens, posterior (array over the model's domains).

    Scores are averaged over a document's words and scaled by the root of their number, as words
    of one text are far from independent.
    """
    buckets, k = len(model.log_likelihood[0]), len(model.domains)
    base = model.log_likelihood[0]
    # One table of structs against the first domain: only differences matter to the posterior.
    tables = [F.array(*[F.lit(x - y) for x, y in zip(row, base, strict=True)]) for row in model.log_likelihood[1:]]

    def summed(words: Column, table: Column) -> Column:
        return F.aggregate(words, F.lit(0.0), lambda s, b: s + F.get(table, b))

    def scores(words: Column) -> Column:
        damp = F.sqrt(F.greatest(F.size(words), F.lit(1)).cast("double"))
        rest = [F.lit(model.log_prior[i + 1]) + summed(words, t) / damp for i, t in enumerate(tables)]
        return F.array(F.lit(model.log_prior[0]), *rest)

    def normal(powers: Column) -> Column:
        total = sum((powers[i] for i in range(1, k)), powers[0])
        return F.transform(powers, lambda v: v / total) if k > 1 else F.array(F.lit(1.0))

    def result(words: Column) -> Column:
        powers = _let(scores(words), lambda z: _let(F.array_max(z), lambda top: F.transform(z, lambda v: F.exp(v - top))))
        return F.struct(F.size(words).cast("long").alias("tokens"), _let(powers, normal).alias("posterior"))

    return docs.withColumn(name, _let(word_buckets(F.col("text"), buckets), result))


def rate(posterior: Column, mix: Mix) -> Column:
    """The fitted rate: from 1 on, one projected step for every vector of ``mix.steps``."""
    return _stepped(posterior, mix.steps, F.lit(1.0))


def _stepped(posterior: Column, vectors: list[list[float]], start: Column) -> Column:
    """The rate after further projected steps."""
    if not vectors:
        return start
    k = len(vectors[0])
    steps = F.array(*[F.array(*[F.lit(float(v)) for v in step]) for step in vectors])

    def advance(r: Column, step: Column) -> Column:
        along = sum((posterior[i] * step[i] for i in range(1, k)), posterior[0] * step[0])
        return F.greatest(F.lit(0.0), r - along)

    return F.aggregate(steps, start, advance)


def fit_rates(
    scored: DataFrame,
    domains: list[str],
    weights: dict[str, float] | None = None,
    rounds: int = MAX_ROUNDS,
    tolerance: float = TOLERANCE,
) -> Mix:
    """Fit the rates of ``scored`` (columns tokens, posterior). Stops when all domain totals are
    within ``tolerance`` of the overall total, or after ``rounds``."""
    k = len(domains)
    p, tokens = F.col("posterior"), F.col("tokens")

    def sums(values: list[Column]) -> np.ndarray:
        row = scored.agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(f"s{i}") for i, v in enumerate(values)]).first()
        return np.array(row, float)

    moments = sums([tokens * p[i] * p[j] for i in range(k) for j in range(k)]).reshape(k, k)
    totals = moments.sum(axis=1)  # posteriors sum to 1
    everything = totals.sum()
    now = totals / everything if everything else np.full(k, 1 / k)
    shares = np.array([(weights or {}).get(d, now[i] if weights else 1 / k) for i, d in enumerate(domains)])
    targets = everything * shares / shares.sum() if shares.sum() else totals
    # Errors are weighed by the inverse of the moments, so a full step solves the problem wherever
    # no rate is cut, and no step can overshoot.
    metric = np.linalg.pinv(moments + 1e-9 * max(everything, 1e-300) * np.eye(k), hermitian=True)
    steps: list[list[float]] = []
    reached, base, done = totals, scored.select("tokens", "posterior", F.lit(1.0).alias("rate")), 0
    for _ in range(rounds):
        gaps = reached - targets
        if not everything or np.abs(gaps).max() <= tolerance * everything:
            break
        steps.append((metric @ gaps).tolist())
        held = base.withColumn("rate", _stepped(p, steps[done:], F.col("rate")))
        row = held.agg(
            *[F.coalesce(F.sum(tokens * F.col("rate") * p[i]), F.lit(0.0)).alias(f"s{i}") for i in range(k)]
        ).first()
        after = np.array(row, float)
        if np.abs(after - reached).max() <= 0.01 * tolerance * everything:
            reached = after
            break  # nothing moves any more: the targets lie outside what nonnegative rates reach
        reached = after
        if len(steps) - done == STORE_EVERY:
            base, done = stored(held, "mixing-rates"), len(steps)
    return Mix(domains, steps, totals.tolist(), targets.tolist(), reached.tolist())


def mixed(
    docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None
) -> tuple[DataFrame, Mix, Classifier]:
    """Per document: doc_id, tokens, posterior, rate; the fitted mix and the classifier."""
    model = fit_classifier(docs, labels)
    scored = add_posterior(docs.select("doc_id", "text"), "score", model)
    scored = stored(scored.select("doc_id", "score.tokens", "score.posterior"), "mixing-scores")
    mix = fit_rates(scored, model.domains, weights)
    return scored.withColumn("rate", rate(F.col("posterior"), mix)), mix, model


def add_rate(docs: DataFrame, labels: DataFrame, name: str, weights: dict[str, float] | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the fitted rate as column ``name``."""
    _, mix, model = mixed(docs, labels, weights)
    score = free_name(docs, "score")
    scored = add_posterior(docs, score, model)
    return scored.withColumn(name, _let(F.col(f"`{score}`.posterior"), lambda p: rate(p, mix))).drop(score)


def wanted(rated: DataFrame, name: str) -> DataFrame:
    """The rows whose rate ``name`` is above 0. (A condition on the rate would be put below the
    projection that works the rate out, which then happened twice.)"""
    positive = F.explode(F.filter(F.array(F.col(f"`{name}`")), lambda r: r > 0))
    return rated.select(*[positive.alias(c) if c == name else F.col(f"`{c}`") for c in rated.columns])
