"""Line dedup by an exact set-similarity join of all lines: later matches of a line go.

A line's set holds its distinct lower-cased words; lines with fewer than ``min_words`` are left
alone. Order is by document id, then line number. A line is removed if an earlier line anywhere has
an equal set or one of Jaccard similarity ``percent`` or more (judged on the input, so the result
does not depend on what else is removed).

The join. Words are put in one order for the whole corpus, rare ones first: the ``FREQUENT`` words
that occur most often come last, by their exact counts over all documents, and all others before
them, by their hash. Two sets of the required similarity share a word among the first
n - ceil(n * percent / 100) + 1 of each, their prefixes; so a line is listed under the words of its
prefix only. Equal lines form one class first.

1. Each class meets the earliest line on each of its lists; of these the one met most often is
   verified.
2. Classes still without an earlier match meet every earlier line of their lists that passes three
   filters: sizes no further apart than the similarity allows; position, as the words before and
   after a common word limit the overlap; and parity bitmaps, whose differing bits never exceed the
   differing words. All such pairs are verified.

So a family of near copies gives one pair per line in step 1 and nothing in step 2, and no match
is missed. Null texts and documents without id take no part; repeated rows of an id are one
document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskflow.llm.common import LOWER, HashCache, free_name, stored

PERCENT = 90
MIN_WORDS = 5
BROADCAST_IDS = 1_000_000
#: Words that come last in the order; their ranks are sent to all tasks.
FREQUENT = 32_768

_SCHEMA = "doc_id long, line int, k1 long, k2 long, n int, prefix array<long>, b1 long, b2 long"
_TYPE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("line", pa.int32()),
        ("k1", pa.int64()),
        ("k2", pa.int64()),
        ("n", pa.int32()),
        ("prefix", pa.list_(pa.int64())),
        ("b1", pa.int64()),
        ("b2", pa.int64()),
    ]
)


def line_set(line: bytes, cache: HashCache) -> set[int]:
    """Hashes of the distinct words."""
    return {cache[w] for w in line.translate(LOWER).split()}


def matches(x: set[int], y: set[int], percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(x & y)
    return 100 * common >= percent * (len(x) + len(y) - common)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class WordOrder(dict):
    """Word to a slot of two arrays: its hash, and its place in the corpus order as one number,
    half its hash for a rare word and above all these for a frequent one."""

    def __init__(self, ranks: dict[int, int], limit: int = 400_000, limit_bytes: int = 32 << 20) -> None:
        self.ranks, self.limit, self.limit_bytes, self.bytes = ranks, limit, limit_bytes, 0
        self.hashes, self.places = np.zeros(limit, np.uint64), np.zeros(limit, np.int64)

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self)
        if slot >= self.hashes.size:
            self.hashes, self.places = (np.concatenate([a, np.zeros_like(a)]) for a in (self.hashes, self.places))
        h = xxhash.xxh3_64_intdigest(word)
        rank = self.ranks.get(h)
        self.hashes[slot], self.places[slot] = h, h >> 2 if rank is None else (1 << 62) + rank
        self.bytes += len(word)
        return slot

    def settle(self) -> None:
        """Forget words, between texts, if they are too many or too long."""
        if len(self) > self.limit or self.bytes > self.limit_bytes:
            self.clear()
            self.bytes = 0


def line_columns(sizes: list[int], words: list[bytes], order: WordOrder, percent: int, min_words: int) -> tuple:
    """Of lines given by their number of words and all words in a row: which lines have a set of
    ``min_words`` or more, and of these the keys, the set size, the prefix (offsets and hashes) and
    the parity bitmap."""
    order.settle()
    slots = np.fromiter(map(order.__getitem__, words), np.int64, len(words))
    line = np.repeat(np.arange(len(sizes)), sizes)
    place = order.places[slots]
    sorting = np.lexsort((place, line))
    line, place, h = line[sorting], place[sorting], order.hashes[slots[sorting]]
    new = np.ones(line.size, bool)
    new[1:] = (line[1:] != line[:-1]) | (place[1:] != place[:-1])
    line, h = line[new], h[new]
    n = np.bincount(line, minlength=len(sizes))
    enough = n >= min_words
    h, n = h[enough[line]], n[enough]
    if not n.size:
        none = np.zeros(0, np.int64)
        return np.flatnonzero(enough), none, none, none, np.zeros(1, np.int64), none, none, none
    starts = np.cumsum(n) - n
    spot = (h >> np.uint64(57)).astype(np.int64)
    bit = np.uint64(1) << (spot % 64).astype(np.uint64)
    halves = [np.bitwise_xor.reduceat(np.where(spot // 64 == k, bit, np.uint64(0)), starts) for k in (0, 1)]
    keys = [np.add.reduceat(h, starts), np.add.reduceat(h * (h >> np.uint64(32) | np.uint64(1)), starts)]
    # A set of n shares one of its first n + 1 - ceil(n * percent / 100) words with any match.
    wanted = n + 1 + -n * percent // 100
    first = np.arange(h.size) - np.repeat(starts, n) < np.repeat(wanted, n)
    offsets = np.concatenate([[0], np.cumsum(wanted)])
    as_long = [x.view(np.int64) for x in (*keys, h[first], *halves)]
    return np.flatnonzero(enough), as_long[0], as_long[1], n, offsets, *as_long[2:]


def frequent_words(docs: DataFrame, limit: int = FREQUENT) -> dict[int, int]:
    """Hashes of the most frequent words of all texts to their rank, the least frequent first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def block() -> pa.RecordBatch:
            hashes = pa.array([signed(xxhash.xxh3_64_intdigest(w)) for w in counts], pa.int64())
            out = pa.RecordBatch.from_arrays([hashes, pa.array(list(counts.values()), pa.int64())], ["h", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(text.translate(LOWER).split())
                if len(counts) > 400_000:
                    yield block()
        yield block()

    texts = docs.select(F.col("text").cast("binary").alias("text")).where("text is not null")
    counts = texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(limit).collect()
    return {r.h & (1 << 64) - 1: len(top) - i for i, r in enumerate(top)}


def line_rows(docs: DataFrame, percent: int, min_words: int, ranks: dict[int, int]) -> DataFrame:
    """A row for every line that can match."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = WordOrder(shared.value)
        owners, numbers, sizes, words = [], [], [], []

        def block() -> pa.RecordBatch:
            kept, k1, k2, n, offsets, prefix, b1, b2 = line_columns(sizes, words, order, percent, min_words)
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(prefix, pa.int64()))
            ids, lines = np.array(owners, np.int64)[kept], np.array(numbers, np.int32)[kept]
            columns = [pa.array(c) for c in (ids, lines, k1, k2, n.astype(np.int32))]
            columns += [listed, pa.array(b1), pa.array(b2)]
            for c in (owners, numbers, sizes, words):
                c.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_TYPE)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for number, line in enumerate(text.translate(LOWER).split(b"\n")):
                    found = line.split()
                    if len(found) >= min_words:
                        owners.append(doc_id)
                        numbers.append(number)
                        sizes.append(len(found))
                        words += found
                if len(words) > 300_000:
                    yield block()
        yield block()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.where("doc_id is not null and text is not null").mapInArrow(run, _SCHEMA)


def _same(percent: int):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        cache = HashCache()
        for first, second in batches:
            pairs = zip(first.to_pylist(), second.to_pylist(), strict=True)
            yield pa.array(
                [a is not None and b is not None and matches(line_set(a, cache), line_set(b, cache), percent) for a, b in pairs],
                pa.bool_(),
            )

    return F.arrow_udf(run, returnType=T.BooleanType())


def verified(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (doc_id, line, to_doc, to_line) those whose lines match: their doc_id and line.

    Only texts of documents in the pairs are shuffled if their ids are few enough to be sent out.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("text_id"), "text")
    wanted = pairs.select("doc_id").union(pairs.select("to_doc")).distinct()
    wanted = wanted.withColumnRenamed("doc_id", "wanted_id")
    if wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(wanted), texts["text_id"] == wanted["wanted_id"], "left_semi")

    def line(number: str) -> Column:
        return F.get(F.split(F.col("text"), "\n", -1), F.col(number)).cast("binary")

    one = pairs.join(texts, pairs["doc_id"] == texts["text_id"]).withColumn("one", line("line")).drop("text", "text_id")
    both = one.join(texts, one["to_doc"] == texts["text_id"]).withColumn("two", line("to_line"))
    return both.where(_same(percent)("one", "two")).select("doc_id", "line").distinct()


def removed_lines(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Columns doc_id, line (from 0) of the lines to remove."""
    lines = stored(line_rows(docs, percent, min_words, frequent_words(docs)), "line-sets")
    firsts = lines.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "line")).alias("first"),
        *(F.first(c).alias(c) for c in ("n", "b1", "b2", "prefix")),
    )
    shape = ["doc_id", "line", "n", "b1", "b2", "at"]
    postings = firsts.select("first.*", "n", "b1", "b2", F.posexplode("prefix").alias("at", "s"))
    on_list = Window.partitionBy("s")
    postings = postings.select(
        "s", *shape, F.min(F.struct(*shape)).over(on_list).alias("y"), F.max(F.struct("doc_id", "line")).over(on_list).alias("high")
    )
    shared = stored(postings.where("y.doc_id <> high.doc_id or y.line <> high.line").select("s", *shape, "y"), "line-lists")
    met = shared.select("s", F.struct(*shape).alias("x"), "y").where(_later() & _bounds(percent) & _position(percent))
    votes = met.groupBy("x.doc_id", "x.line", F.struct("y.doc_id", "y.line").alias("to")).agg(F.count("*").alias("lists"))
    earliest = F.struct("lists", (-F.col("to.doc_id")).alias("d"), (-F.col("to.line")).alias("l"))
    best = votes.groupBy("doc_id", "line").agg(F.max_by("to", earliest).alias("to"))
    pairs = best.select("doc_id", "line", F.col("to.doc_id").alias("to_doc"), F.col("to.line").alias("to_line"))
    pairs = stored(pairs, "line-pairs")
    matched = stored(verified(docs, pairs, percent), "line-matches")
    rest = shared.drop("y")
    open_lines = rest.join(matched, ["doc_id", "line"], "left_anti")
    more = open_lines.alias("x").join(
        rest.alias("y"), (F.col("x.s") == F.col("y.s")) & _later() & _bounds(percent) & _position(percent)
    )
    more = more.select("x.doc_id", "x.line", F.col("y.doc_id").alias("to_doc"), F.col("y.line").alias("to_line")).distinct()
    more = stored(more, "line-pairs")
    near = matched
    if more.limit(1).count():
        near = near.unionByName(verified(docs, more, percent))
    near = near.withColumnRenamed("doc_id", "near_doc").withColumnRenamed("line", "near_line")
    # A class is out from its second line on, or altogether if its first line has an earlier match.
    firsts = lines.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("times"))
    told = firsts.join(
        near, (F.col("first.doc_id") == F.col("near_doc")) & (F.col("first.line") == F.col("near_line")), "left"
    ).where("times > 1 or near_doc is not null")
    told = told.select("k1", "k2", "first", F.col("near_doc").isNotNull().alias("matched"))
    found = lines.select("doc_id", "line", "k1", "k2").join(told, ["k1", "k2"])
    is_first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("line") == F.col("first.line"))
    return found.where(F.col("matched") | ~is_first).select("doc_id", "line").distinct()


def _later() -> Column:
    """Whether line x comes after line y."""
    return (F.col("x.doc_id") > F.col("y.doc_id")) | ((F.col("x.doc_id") == F.col("y.doc_id")) & (F.col("x.line") > F.col("y.line")))


def _bounds(percent: int) -> Column:
    """Length and bitmap bounds on pairs x, y: differing bits never exceed differing words."""
    nx, ny = F.col("x.n"), F.col("y.n")
    differing = F.bit_count(F.col("x.b1").bitwiseXOR(F.col("y.b1"))) + F.bit_count(F.col("x.b2").bitwiseXOR(F.col("y.b2")))
    common = F.ceil((nx + ny) * percent / (100 + percent) - 1e-9)
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & (differing <= nx + ny - 2 * common)


def _position(percent: int) -> Column:
    """Positional bound on pairs x, y that meet in a word: what they share before it lies before it
    in both, and what they share after it lies after it in both."""
    nx, ny = F.col("x.n"), F.col("y.n")
    most = F.least("x.at", "y.at") + 1 + F.least(nx - F.col("x.at"), ny - F.col("y.at")) - 1
    return most >= F.ceil((nx + ny) * percent / (100 + percent) - 1e-9)


def report(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, removed (line numbers from 0, ascending)."""
    removed = removed_lines(docs, percent, min_words).groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    sizes = docs.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"))
    joined = sizes.join(removed, "doc_id", "left")
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(gone).cast("long").alias("n_removed"), gone.alias("removed"))


@F.arrow_udf(T.StringType())
def _without(text: pa.Array, removed: pa.Array) -> pa.Array:
    out = []
    for t, gone in zip(text.to_pylist(), removed.to_pylist(), strict=True):
        if t is not None and gone:
            drop = set(gone)
            t = "\n".join(line for i, line in enumerate(t.split("\n")) if i not in drop)
        out.append(t)
    return pa.array(out, pa.string())


def remove_lines(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs``; removed lines are gone from the text, and n_chars, if
    there is such a column, follows. A text may become empty; its row stays."""
    removed = removed_lines(docs, percent, min_words).groupBy(F.col("doc_id").alias("removed_id")).agg(F.collect_set("line").alias("gone"))
    id_name, name = free_name(docs, "removed_id"), free_name(docs, "gone")
    removed = removed.select(F.col("removed_id").alias(id_name), F.col("gone").alias(name))
    out = docs.join(removed, docs["doc_id"] == removed[id_name], "left").withColumn("text", _without("text", name))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(name).isNull(), F.col("n_chars")).otherwise(F.char_length("text")))
    return out.select(*[f"`{c}`" for c in docs.columns])
