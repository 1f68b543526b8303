"""Benchmark decontamination: exact containment of item windows, found by a rare-token prefix.

A window is ``width`` consecutive words of an item (the whole item if it is shorter). Full
containment means that any single word of a window must occur, so the prefix of a window is its
rarest word over the documents. A document word that is some window's prefix word gives a
candidate; its position must leave room for the words before and after (positional and length
bound), and the words there must equal the window.

The index of windows is built from blocks of items of bounded bytes. With one block (the usual
case) documents are matched in one pass without any shuffle; with more, every block is matched
in a pass of its own, hits are gathered per distinct text and joined back.

Null or empty texts have no words and no hits. Repeated rows give repeated rows. Items without
words match nothing; an item without id is named by an empty string.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm.common import alnum_words, free_name

WIDTH = 10
BLOCK_BYTES = 16_000_000
_HITS = "struct<n_words:long,spans:array<struct<start:int,stop:int>>,items:array<string>>"
_HITS_TYPE = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)

Index = dict[bytes, list[tuple[int, int, dict[bytes, list[str]]]]]


def windows(words: list[bytes], width: int) -> list[list[bytes]]:
    if not words:
        return []
    return [words[i : i + width] for i in range(max(1, len(words) - width + 1))]


def build_index(items: list[tuple[str, bytes]], frequency: dict[bytes, int], width: int) -> Index:
    """Prefix word -> (words before it, window length, window text -> items)."""
    index: dict[bytes, dict[tuple[int, int], dict[bytes, set[str]]]] = defaultdict(dict)
    for item, text in items:
        for window in windows(alnum_words(text), width):
            before = min(range(len(window)), key=lambda i: (frequency.get(window[i], 0), window[i], i))
            places = index[window[before]].setdefault((before, len(window)), {})
            places.setdefault(b" ".join(window), set()).add(item)
    return {
        word: [(before, size, {k: sorted(v) for k, v in texts.items()}) for (before, size), texts in places.items()]
        for word, places in index.items()
    }


def match(words: list[bytes], index: Index) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged word spans inside occurring windows, and the items these belong to."""
    found: list[tuple[int, int]] = []
    items: set[str] = set()
    for i, word in enumerate(words):
        if word in index:
            for before, size, texts in index[word]:
                start = i - before
                if start < 0 or start + size > len(words):
                    continue
                owners = texts.get(b" ".join(words[start : start + size]))
                if owners:
                    found.append((start, start + size))
                    items.update(owners)
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged, items


def _matcher(shared):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        for batch in batches:
            rows = []
            for text in batch.to_pylist():
                words = alnum_words(text)
                spans, items = match(words, index)
                rows.append(
                    {
                        "n_words": len(words),
                        "spans": [{"start": a, "stop": b} for a, b in spans],
                        "items": sorted(items),
                    }
                )
            yield pa.array(rows, _HITS_TYPE)

    return run


def _counter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, totals = shared.value, defaultdict(int)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in alnum_words(text):
                    if word in vocabulary:
                        totals[word] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())],
            ["word", "n"],
        )

    return run


def word_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """Occurrences of the given words in all documents; one row per word and task is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    counts = docs.select(F.col("text").cast("binary")).mapInArrow(_counter(shared), "word binary, n long")
    return {bytes(r.word): r.n for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def add_hits(
    docs: DataFrame, benchmark: DataFrame, name: str, width: int = WIDTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Add struct ``name``: n_words, spans (word ranges inside item windows), items (their ids)."""
    context = docs.sparkSession.sparkContext
    texts = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.col("text").cast("binary").alias("text"),
    ).where("text is not null")
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))

    def matched(block: int, source: DataFrame) -> DataFrame:
        part = texts.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        items = [(r.item, bytes(r.text)) for r in part.collect()]
        vocabulary = {w for _, text in items for w in alnum_words(text)}
        index = build_index(items, word_frequencies(docs, vocabulary), width)
        udf = F.arrow_udf(_matcher(context.broadcast(index)), returnType=_HITS)
        return source.withColumn(name, udf(F.col("text").cast("binary")))

    if blocks == 1:
        return matched(0, docs)
    empty = benchmark.sparkSession.sparkContext.broadcast({})
    key = free_name(docs, "text_key")
    counted = docs.withColumn(
        name, F.arrow_udf(_matcher(empty), returnType=_HITS)(F.col("text").cast("binary"))
    ).withColumn(key, F.sha2(F.coalesce("text", F.lit("")), 256))
    distinct = docs.select("text").where("text is not null").distinct()
    hits = None
    for block in range(blocks):
        part = matched(block, distinct).where(F.size(f"`{name}`.items") > 0)
        part = part.select(F.sha2("text", 256).alias(key), F.col(name).alias("part"))
        hits = part if hits is None else hits.unionByName(part)
    merged = hits.groupBy(key).agg(
        F.flatten(F.collect_list("part.spans")).alias("all_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("part.items")))).alias("all_items"),
    )
    merged = merged.select(F.col(key).alias("hit_key"), "all_items", _merge_spans("all_spans").alias("all_spans"))
    joined = counted.join(merged, counted[key] == merged["hit_key"], "left")
    return joined.withColumn(
        name,
        F.struct(
            F.col(f"`{name}`.n_words").alias("n_words"),
            F.coalesce("all_spans", f"`{name}`.spans").alias("spans"),
            F.coalesce("all_items", f"`{name}`.items").alias("items"),
        ),
    ).drop(key, "hit_key", "all_spans", "all_items")


@F.arrow_udf(
    T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))
)
def _merge_spans(spans: pa.Array) -> pa.Array:
    rows = []
    for found in spans.to_pylist():
        merged: list[list[int]] = []
        for start, stop in sorted((s["start"], s["stop"]) for s in found):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(stop, merged[-1][1])
            else:
                merged.append([start, stop])
        rows.append([{"start": a, "stop": b} for a, b in merged])
    return pa.array(rows, _HITS_TYPE.field("spans").type)


def hit_report(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit, n_items, item_ids, spans."""
    found = add_hits(docs.select("doc_id", "text"), benchmark, "hits", width, block_bytes)
    return found.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        F.aggregate("hits.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.col("hits.items").alias("item_ids"),
        F.col("hits.spans").alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """Documents in which no item window occurs, with all their columns."""
    name = free_name(docs, "hits")
    found = add_hits(docs, benchmark, name, width)
    return found.where(F.size(f"`{name}`.items") == 0).select(*[f"`{c}`" for c in docs.columns])
