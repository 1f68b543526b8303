"""Words, all counted, and a bounded set of symbols that they follow each other in.

There are at most ``size`` symbols whatever the corpus, so tables over pairs and triples of symbols
are bounded too and may be sent to every task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class WordTable(dict):
    """Word to a slot of two arrays, its hash and its symbol: one lookup per word of a text.

    ``frequent`` gives the symbols of hashes, ``other`` those of all other words. Words are
    forgotten between texts once there are more than ``limit`` of them or they hold more than
    ``limit_bytes``; within a text all stay.
    """

    def __init__(self, frequent: dict[int, int], other: Callable[[bytes], int], limit: int = 400_000, limit_bytes: int = 32 << 20) -> None:
        self.frequent, self.other, self.limit, self.limit_bytes, self.bytes = frequent, other, limit, limit_bytes, 0
        self.hashes, self.symbols = np.zeros(limit, np.int64), np.zeros(limit, np.int64)

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self)
        if slot >= self.hashes.size:
            self.hashes, self.symbols = (np.concatenate([a, np.zeros_like(a)]) for a in (self.hashes, self.symbols))
        h = self.hashes[slot] = word_hash(word)
        self.symbols[slot] = self.frequent.get(int(h)) or self.other(word)
        self.bytes += len(word)
        return slot

    def slots(self, words: list[bytes]) -> np.ndarray:
        """The slots of a text's words."""
        if len(self) > self.limit or self.bytes > self.limit_bytes:
            self.clear()
            self.bytes = 0
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and symbols of a text's words."""
        slots = self.slots(words)
        return self.hashes[slots], self.symbols[slots]


def word_hash(word: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def word_counts(docs: DataFrame, split: Callable[[bytes | None], list[bytes]], other: Callable[[bytes], int]) -> DataFrame:
    """Columns w (hash), class (by ``other``), n of all words of all texts, none left out. A task
    hands on one row per distinct word, or several if it has seen very many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def block() -> pa.RecordBatch:
            words = list(counts)
            columns = [
                pa.array([word_hash(w) for w in words], pa.int64()),
                pa.array([other(w) for w in words], pa.int32()),
                pa.array([counts[w] for w in words], pa.int64()),
            ]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["w", "class", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(split(text))
                if len(counts) > 300_000:
                    yield block()
        yield block()

    rows = docs.select(F.col("text").cast("binary")).mapInArrow(run, "w long, class int, n long")
    return rows.groupBy("w").agg(F.first("class").alias("class"), F.sum("n").alias("n"))


def triple_counts(
    docs: DataFrame, encode: Callable[[], Callable[[bytes | None], np.ndarray]], size: int
) -> DataFrame:
    """Counts of symbol triples over all texts: columns gram (a * size² + b * size + c), n.

    ``encode()`` gives a function from text to its symbols, two start symbols in front. A task
    counts in one array of size³ numbers and hands on the triples it has seen.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, counts, waiting, held = encode(), np.zeros(size**3, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                s = symbols(text)
                if s.size > 2:
                    waiting.append((s[:-2] * size + s[1:-1]) * size + s[2:])
                    held += s.size
                    if held > 2_000_000:
                        np.add.at(counts, *np.unique(np.concatenate(waiting), return_counts=True))
                        waiting, held = [], 0
        if waiting:
            np.add.at(counts, *np.unique(np.concatenate(waiting), return_counts=True))
        grams = np.flatnonzero(counts)
        for i in range(0, grams.size, 100_000):
            part = grams[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], ["gram", "n"])

    counts = docs.select(F.col("text").cast("binary")).mapInArrow(run, "gram long, n long")
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))
