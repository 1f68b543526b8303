"""LM scoring: a log-bilinear model trained by noise-contrastive estimation.

Tokens are lower-cased (A-Z) words between white space, and one end per text. All training words
are counted exactly. The neural model works on a bounded vocabulary of symbols: the end, the most
frequent words, and classes of all other words by their last two bytes. Its context vector is a
linear map of the vectors of the two symbols before; the score of a symbol is the product with its
own vector plus a bias. It is trained on the counts of all symbol triples of all training texts:
in every round each shard of contexts takes gradient steps of noise-contrastive estimation (the
expectation of noise from the symbols' frequencies) over all its triples, each weighted by its
count, from the same parameters, and the results are averaged.

As there are at most size² contexts, one batched matrix product gives the normalised
log-probabilities of all of them, a bounded table that every token is looked up in. A word in a
class has the class's probability times its add-one share of the class, in which one place is kept
for all unknown words of the class. So log-probabilities are normalised over all words.

Counts of the ``COMMON`` most frequent words are sent to the tasks; the others are joined on the
word's hash. A null or empty text is one end token. A row without id is never held out. Repeated
rows are scored and counted each time. Without training texts the model falls back to a uniform one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import space_words, stored
from riskflow.llm.symbols import WordTable, triple_counts, word_counts

SIZE, FREQUENT, WIDTH = 192, 127, 24
COMMON = 65_536
ROUNDS, SHARDS, NOISE, RATE = 5, 12, 16, 0.1
PASSES, STEPS = 2, 192  # of a shard in a round

Parameters = dict[str, np.ndarray]


def word_class(word: bytes) -> int:
    """Symbol of a word that is not frequent."""
    return FREQUENT + 1 + zlib.crc32(word[-2:]) % (SIZE - FREQUENT - 1)


def _framed(symbols: np.ndarray) -> np.ndarray:
    """Symbols between two starts and the end."""
    out = np.zeros(symbols.size + 3, np.int64)
    out[2:-1] = symbols
    return out


def train_shard(p: Parameters, grams: np.ndarray, counts: np.ndarray, noise: np.ndarray, seed: int) -> Parameters:
    """Passes of noise-contrastive steps (with per-number learning rates) over all of a shard's triples.

    Every triple counts as often as it occurs, and the noise with its expectation; nothing is drawn
    but the order of the contexts.
    """
    rng = np.random.default_rng(seed)
    p = {k: v.astype(np.float64) for k, v in p.items()}
    seen = {k: np.full(v.shape, 1e-3) for k, v in p.items()}
    contexts, row = np.unique(grams // SIZE, return_inverse=True)
    table = np.zeros((contexts.size, SIZE))  # occurrences of each symbol after each context
    np.add.at(table, (row, grams % SIZE), counts)
    a, b, mass = contexts // SIZE, contexts % SIZE, table.sum(1)
    log_noise, share = np.log(NOISE * noise), mass.sum() / STEPS
    for _ in range(PASSES):
        order = rng.permutation(contexts.size)
        # Steps take contexts of about equal mass; one that is heavier than that has its own step.
        cuts = np.searchsorted(np.cumsum(mass[order]), share * np.arange(1, STEPS))
        for i in np.split(order, cuts):
            if not i.size:
                continue
            ra, rb = p["r"][a[i]], p["r"][b[i]]
            context = ra @ p["ca"] + rb @ p["cb"]
            scores = context @ p["q"].T + p["bias"] - log_noise
            is_word = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            g = (table[i] * (1 - is_word) - mass[i, None] * (NOISE * noise) * is_word) / share
            g_context = g @ p["q"]
            grads = {"q": g.T @ context, "bias": g.sum(0), "ca": ra.T @ g_context, "cb": rb.T @ g_context}
            grads["r"] = np.zeros_like(p["r"])
            np.add.at(grads["r"], a[i], g_context @ p["ca"].T)
            np.add.at(grads["r"], b[i], g_context @ p["cb"].T)
            for k, v in grads.items():
                seen[k] += v * v
                p[k] += RATE * v / np.sqrt(seen[k])
    return {k: v.astype(np.float32) for k, v in p.items()}


def _pack(p: Parameters) -> bytes:
    return b"".join(np.ascontiguousarray(p[k], np.float32).tobytes() for k in sorted(p))


def _unpack(data: bytes, like: Parameters) -> Parameters:
    out, at = {}, 0
    for k in sorted(like):
        size = like[k].size * 4
        out[k] = np.frombuffer(data[at : at + size], np.float32).reshape(like[k].shape)
        at += size
    return out


def _shard_step(shared, noise: np.ndarray, seed: int):
    def run(key, table):
        grams, counts = table["gram"].to_numpy(), table["n"].to_numpy()
        order = np.argsort(grams)
        new = train_shard(shared.value, grams[order], counts[order], noise, seed + key[0].as_py())
        return pa.table({"p": pa.array([_pack(new)], pa.binary()), "n": pa.array([counts.sum()], pa.int64())})

    return run


def train(triples: DataFrame, symbol_totals: np.ndarray, rounds: int = ROUNDS) -> Parameters:
    """Fit the model to a stored table of triple counts (gram, n)."""
    rng = np.random.default_rng(7)
    noise = (symbol_totals + 1) / (symbol_totals + 1).sum()
    p: Parameters = {
        "r": rng.normal(0, 0.1, (SIZE, WIDTH)).astype(np.float32),
        "q": rng.normal(0, 0.1, (SIZE, WIDTH)).astype(np.float32),
        "ca": (0.5 * np.eye(WIDTH)).astype(np.float32),
        "cb": np.eye(WIDTH, dtype=np.float32),
        "bias": np.log(noise).astype(np.float32),
    }
    context = triples.sparkSession.sparkContext
    sharded = triples.withColumn("shard", F.pmod(F.xxhash64(F.floor(F.col("gram") / SIZE)), F.lit(SHARDS)).cast("int"))
    sharded = stored(sharded.repartition(SHARDS, "shard"), "lm-triples")

    for number in range(rounds):
        run = _shard_step(context.broadcast(p), noise, 1000 * number)
        # All shards together have at most SIZE ** 3 rows, whatever the corpus.
        rows = sharded.groupBy("shard").applyInArrow(run, "p binary, n long").collect()
        if not rows:
            break
        total = sum(r.n for r in rows)
        found = sorted((bytes(r.p), r.n) for r in rows)
        p = {k: sum(_unpack(d, p)[k].astype(np.float64) * (n / total) for d, n in found).astype(np.float32) for k in p}
    return p


def log_table(p: Parameters) -> np.ndarray:
    """Log10 probability of every symbol after every pair of symbols: SIZE² rows."""
    first, second = p["r"] @ p["ca"], p["r"] @ p["cb"]
    out = np.empty((SIZE, SIZE, SIZE), np.float32)
    for a in range(SIZE):
        z = (first[a] + second) @ p["q"].T + p["bias"]
        z -= z.max(axis=1, keepdims=True)
        out[a] = (z - np.log(np.exp(z).sum(axis=1, keepdims=True))) / np.log(10)
    return out.reshape(-1)


_ROW = (
    "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, "
    "rare array<struct<w:long,n:int>>"
)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = stored(word_counts(training, space_words, word_class), "lm-words")
    top = counts.orderBy(F.desc("n"), "w").limit(COMMON).collect()
    frequent = {r.w: i + 1 for i, r in enumerate(top[:FREQUENT])}
    ends = training.count()
    whole = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    n_train, n_types = whole.n + ends, whole.v + (1 if ends else 0)
    per_class = np.ones(SIZE)  # the place for unknown words
    for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        per_class[r["class"]] += r.n + r.v
    totals = np.zeros(SIZE)
    totals[0] = ends
    for r in top[:FREQUENT]:
        per_class[r["class"]] -= r.n + 1
        totals[frequent[r.w]] = r.n
    for k in range(FREQUENT + 1, SIZE):
        totals[k] = per_class[k]

    def encode():
        table = WordTable(frequent, word_class)
        return lambda text: _framed(table.read(space_words(text))[1])

    parameters = train(triple_counts(training, encode, SIZE), totals)
    common = sorted((r.w, r.n) for r in top)
    model = (
        parameters,
        frequent,
        np.array([w for w, _ in common], np.int64),
        np.log10(np.array([n for _, n in common], np.float64) + 1),
        np.log10(per_class),
        float(np.log10(n_train + n_types + 1)),
        float(np.log10(ends + 1)),
        bool(ends),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, frequent, words_known, logs_known, log_class, log_all, log_end, end_known = shared.value
        words, table = WordTable(frequent, word_class), log_table(p)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(2).to_pylist():
                h, own = words.read(space_words(text))
                s = _framed(own)
                inside = float(table[(s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:]].sum(dtype=np.float64))
                logs, is_common = np.zeros(h.size), np.zeros(h.size, bool)
                if words_known.size and h.size:
                    spot = np.minimum(np.searchsorted(words_known, h), words_known.size - 1)
                    is_common = words_known[spot] == h
                    logs[is_common] = logs_known[spot[is_common]]
                in_class = own > FREQUENT
                rare, n = np.unique(h[~is_common], return_counts=True)
                out[0].append(h.size + 1)
                out[1].append(int(is_common.sum()) + end_known)
                out[2].append(float(logs.sum()) + log_end - (h.size + 1) * log_all)
                out[3].append(inside + float(logs[in_class].sum()) - float(log_class[own[in_class]].sum()))
                out[4].append([{"w": w, "n": k} for w, k in zip(rare.tolist(), n.tolist(), strict=True)])
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("w", pa.int64()), ("n", pa.int32())]))]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], ["doc_id", "held_out", "n_tokens", "known", "base", "score", "rare"]
            )

    local = rows.select("doc_id", "held_out", F.col("text").cast("binary")).mapInArrow(run, _ROW)
    # The row number is written with the rows, so it stays the same for every later pass.
    local = stored(local.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = local.select("row", F.explode("rare").alias("x")).select("row", "x.w", "x.n")
    found = rare.join(counts.select(F.col("w").alias("cw"), F.col("n").alias("c")), F.col("w") == F.col("cw"))
    sums = found.groupBy(F.col("row").alias("sum_row")).agg(
        F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log")
    )
    joined = local.drop("rare").join(sums, local["row"] == sums["sum_row"], "left")
    extra = F.coalesce("rare_log", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"),
        (F.col("score") + extra).alias("score"),
    )
