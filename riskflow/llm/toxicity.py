"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding lower-cases, removes accents, and maps homoglyphs (Cyrillic, Greek, full-width) and digit
substitutions to the letters they imitate; everything that is no letter becomes a space. Lexicon
entries are word beginnings or whole words, so one stem covers its inflections. The score of a
text comes from the summed weights of its toxic words, damped by its length, through a logistic
curve.

Lexicon, weights, exception phrases and curve are learned from labelled texts only: a stem is
taken if its share of toxic documents is well above its share of the others, its weight is the
log-ratio of the shares. An exception phrase is a toxic word with a neighbour that occurs in
clean documents and not in toxic ones; a match inside one does not count. The fit uses all
labelled rows: stems and phrases are counted, and the curve is fitted, by aggregations, and only
what enters the lexicon reaches the driver; what it finds does not depend on how rows are dealt to
tasks.

A null or empty text has no matches and the lowest score. Without toxic labels the lexicon is
empty and every score is the prior. Rows are independent; repeated rows give repeated results.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import free_name, labelled, stored

STEM_SIZES = (4, 5, 6, 7, 8)
MIN_TOXIC_DOCS = 4
MIN_LOG_RATIO = 2.5
MIN_EVIDENCE = 12.0
MIN_EXCEPTION_DOCS = 3

# Characters that imitate Latin letters, as pairs of look-alike and letter.
HOMOGLYPHS = (
    "аa вb еe ёe кk мm нh оo рp сc тt уy хx іi јj ѕs ԁd ԛq ԝw һh ӏl ɡg "
    "αa βb εe ηn ιi κk νv οo ρp τt υu χx ωw ıi ſs 0o 1i 3e 4a 5s 7t @a $s"
)


def fold_table() -> dict[int, str]:
    """Code point to folded letter for everything below U+3000 and full-width forms."""
    table: dict[int, str] = {}
    for code in [*range(0x3000), *range(0xFF00, 0xFF5F)]:
        plain = unicodedata.normalize("NFKD", chr(code)).casefold()
        letters = "".join(c for c in plain if c.isalpha())
        table[code] = letters if letters else "" if unicodedata.combining(chr(code)) else " "
    for pair in HOMOGLYPHS.split():
        for c in {pair[0], pair[0].upper()}:
            table[ord(c)] = pair[1]
    return table


_FOLD = fold_table()


def fold(text: str | None) -> str:
    """Folded text; words are single-spaced and the text begins and ends with a space."""
    return f" {' '.join(text.translate(_FOLD).split())} " if text else " "


def stems(words: set[str]) -> set[str]:
    found: set[str] = set()
    for word in words:
        found.add(f" {word} ")
        for size in STEM_SIZES:
            if len(word) >= size:
                found.add(f" {word[:size]}")
    return found


class Lexicon(NamedTuple):
    weights: dict[str, float]
    exceptions: frozenset[str]
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.automaton = ahocorasick.Automaton()
        for pattern, weight in lexicon.weights.items():
            self.automaton.add_word(pattern, (len(pattern), weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
        self.usable = len(self.automaton) > 0
        if self.usable:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """Start of each toxic word to its largest weight, words of exception phrases left out."""
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if self.usable:
            for end, (size, weight) in self.automaton.iter(folded):
                start = end - size + 1
                if weight is None:
                    spared.append((start, end))
                elif weight > found.get(start, 0.0):
                    found[start] = weight
        if spared:
            found = {s: w for s, w in found.items() if not any(a <= s < b for a, b in spared)}
        return found

    def features(self, text: str | None) -> tuple[float, float]:
        """Log of the summed weights, and the same damped by the number of words."""
        folded = fold(text)
        total = sum(self.hits(folded).values())
        words = max(1, folded.count(" ") - 1)
        return math.log1p(total), math.log1p(total / math.sqrt(words))


def probability(curve: tuple[float, float, float], features: tuple[float, float]) -> float:
    z = curve[0] + curve[1] * features[0] + curve[2] * features[1]
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and clean documents of every stem; a task hands on a stem again if it has seen many."""
    counts: dict[str, list[int]] = {}

    def block() -> pa.RecordBatch:
        columns = [pa.array(counts, pa.string()), *[pa.array([n[k] for n in counts.values()], pa.int64()) for k in (1, 0)]]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, ["stem", "toxic", "clean"])

    for batch in batches:
        for text, label in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            side = int(label > 0)
            for stem in stems(set(fold(text).split())):
                counts.setdefault(stem, [0, 0])[side] += 1
            if len(counts) > 300_000:
                yield block()
    yield block()


def _phrase_counts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, counts = Matcher(shared.value), (Counter(), Counter())
        for batch in batches:
            for text, label in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                folded = fold(text)
                found = set()
                for start in matcher.hits(folded):
                    before = folded[:start].rsplit(" ", 1)[-1]
                    word, _, rest = folded[start + 1 :].partition(" ")
                    after = rest.split(" ", 1)[0]
                    found |= {f"{before} {word}"} if before else set()
                    found |= {f"{word} {after}"} if after else set()
                counts[label > 0].update(found)
        # Toxic occurrences count wherever they are: another task may have seen the clean ones.
        names = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in counts[::-1]]],
            ["phrase", "toxic", "clean"],
        )

    return run


def _feature_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            texts, labels = (c.to_pylist() for c in batch.columns)
            rows = [matcher.features(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()), pa.array(labels, pa.int32())],
                ["a", "b", "label"],
            )

    return run


def fit_curve(rows: DataFrame) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps over rows of features a, b, label and their number
    n; no slope is negative. A step is one aggregation, to exact sums of decimals."""
    use = ["a", "b"]
    while True:
        x = [F.lit(1.0), *map(F.col, use)]
        k = len(x)
        pairs = [(i, j) for i in range(k) for j in range(i + 1)]
        w, ridge = np.zeros(k), np.diag([1e-6] + [0.05] * len(use)) + 1e-9 * np.eye(k)
        for _ in range(60):
            z = sum((c * float(v) for c, v in zip(x[1:], w[1:], strict=True)), F.lit(float(w[0])))
            p = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))
            miss = F.when(F.col("label") > 0, 1.0).otherwise(0.0) - F.col("p")
            spread = F.col("p") * (1 - F.col("p"))
            terms = [miss * c for c in x] + [spread * x[i] * x[j] for i, j in pairs]
            sums = [F.sum((F.col("n") * t).cast("decimal(38,18)")).alias(f"s{i}") for i, t in enumerate(terms)]
            found = [float(v or 0) for v in rows.withColumn("p", p).agg(*sums).first()]
            curvature = np.zeros((k, k))
            for (i, j), v in zip(pairs, found[k:], strict=True):
                curvature[i, j] = curvature[j, i] = v
            step = np.linalg.solve(curvature + ridge, np.array(found[:k]) - ridge @ w)
            w = np.clip(w + np.clip(step, -2, 2), -40, 40)
            if np.abs(step).max() < 1e-8:
                break
        slopes = dict(zip(use, w[1:].tolist(), strict=True))
        if all(v >= 0 for v in slopes.values()):
            return float(w[0]), slopes.get("a", 0.0), slopes.get("b", 0.0)
        use = [c for c in use if slopes[c] >= 0]


def fit(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Learn from all rows of ``labels`` (label_id, label), such as common.chosen_labels gives."""
    context = docs.sparkSession.sparkContext
    rows = stored(labelled(docs, labels, "text"), "toxicity-texts")
    sizes = {r.toxic: r.n for r in rows.groupBy((F.col("label") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        prior = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return Lexicon({}, frozenset(), (math.log(prior / (1 - prior)), 0.0, 0.0))
    counts = rows.mapInArrow(_stem_counts, "stem string, toxic long, clean long")
    counts = counts.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # Only stems that are taken, or nearly so, are sent to the driver, which decides.
    weigh = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    taken = (weigh >= MIN_LOG_RATIO - 1e-6) & (F.col("toxic") * weigh >= MIN_EVIDENCE - 1e-6)
    found = {r.stem: (r.toxic, r.clean) for r in counts.where((F.col("toxic") >= MIN_TOXIC_DOCS) & taken).collect()}
    weights: dict[str, float] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        a, b = found[stem]
        weight = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))
        if weight < MIN_LOG_RATIO or a * weight < MIN_EVIDENCE:
            continue
        # A longer stem is kept only if it says more than the shorter one it begins with.
        shorter = max((weights[stem[:k]] for k in range(2, len(stem)) if stem[:k] in weights), default=None)
        if shorter is None or weight > shorter + 1:
            weights[stem] = weight
    plain = Lexicon(weights, frozenset())
    phrases = rows.mapInArrow(_phrase_counts(context.broadcast(plain)), "phrase string, toxic long, clean long")
    phrases = phrases.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    phrases = phrases.where((F.col("clean") >= MIN_EXCEPTION_DOCS) & (F.col("toxic") == 0))
    spared = frozenset(r.phrase for r in phrases.collect())
    lexicon = Lexicon(weights, spared)
    features = rows.mapInArrow(_feature_rows(context.broadcast(lexicon)), "a double, b double, label int")
    features = stored(features.groupBy("a", "b", "label").agg(F.count("*").alias("n")), "toxicity-features")
    return lexicon._replace(curve=fit_curve(features))


def add_score(docs: DataFrame, name: str, lexicon: Lexicon) -> DataFrame:
    """Add double ``name``: the probability that a text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher, curve = Matcher(shared.value), shared.value.curve
        for batch in batches:
            scores = [probability(curve, matcher.features(t)) for t in batch.to_pylist()]
            yield pa.array(scores, pa.float64())

    return docs.withColumn(name, F.arrow_udf(run, returnType="double")("text"))


def scores(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """Per document: doc_id, score, predicted (1 from ``threshold`` on)."""
    score = free_name(docs, "score")
    scored = add_score(docs.select("doc_id", "text"), score, lexicon)
    return scored.select(
        "doc_id", F.col(score).alias("score"), (F.col(score) >= threshold).cast("int").alias("predicted")
    )
