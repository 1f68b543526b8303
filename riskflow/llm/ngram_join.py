"""N-gram Jaccard join of all documents, by T-occurrence search on inverted lists.

A document's set holds the hashes of its distinct shingles. Two sets x, y reach similarity s only
if they share T = s / (1 + s) * (|x| + |y|) or more members, and at least s * |x|. DivideSkip:
of the lists of x, all but the T - 1 longest are merged (the short lists: the first
|x| - T + 1 members in an order that puts frequent shingles last); whoever is met there is checked
by binary probes into the long ones, that is, into its sorted set.

Documents with equal sets form one class first, so copies cost one row each and nothing more.
Classes are then linked in two steps, so that large families of near copies never give all their
pairs:

1. Each class meets, on each short list, the smallest id of the list; the id met on most lists is
   its candidate. One candidate per class is probed; links found here contract families.
2. In rounds, neighbours on a list that lie in different components are probed, which adds at most
   one pair per class and list; the links contract components further. Each round puts a list in
   the order of another minimum hash of the short members, so near copies are often neighbours,
   and rounds end when few probes find a link: what they miss is left to the last step.
3. A list on which all ids are in one component cannot add anything. On the others, classes of
   different components meet if length and parity-bitmap bounds allow the required overlap
   (each differing member flips one bit, so differing bits never exceed differing members).
   Bitmaps grow with their sets, as one that is small for its set is alike for all sets: sets meet
   by size, those of each bitmap size with those that are small enough larger.
   All pairs met are probed. No link between different components is missed: a linked pair shares
   a member of both short lists, and the bounds are exact.

Texts are lower-cased (A-Z); words lie between spaces and control white space. Fewer words than
``width`` give one shingle of the whole sequence. Null and empty texts have an empty set and link
with nothing, each is its own component. A null id takes part in nothing and has no component.
Repeated rows are one document, and each row gets its result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskflow.llm.common import HashCache, space_words, stored
from riskflow.llm.components import components

WIDTH = 3
PERCENT = 90
HEAVY = 4096
#: Words of the smallest bitmap, and of the one from which on a bit stands for up to two members.
BITMAP_WORDS, WIDE_WORDS = 4, 32
BROADCAST_ROWS = 100_000
#: Rounds of contraction go on while more than one probe in so many finds a link.
FEW = 2

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: bytes | None, width: int, cache: HashCache) -> np.ndarray:
    """Sorted distinct shingle hashes (int64)."""
    words = space_words(text)
    if not words:
        return np.empty(0, np.int64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64).view(np.int64)
    h = np.array([cache[w] for w in words], np.uint64)
    n = len(words) - width + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(width):
        mixed = (mixed ^ h[i : i + n]) * _M1
        mixed ^= mixed >> np.uint64(29)
    mixed *= _M2
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def needed(n: int, percent: int) -> int:
    """Fewest common members of a set of ``n`` with any set it links with."""
    return -(-n * percent // 100)


def bitmap_words(n: int) -> int:
    """Words of the bitmap of a set of ``n``, a power of two."""
    words = BITMAP_WORDS
    while largest_set(words) < n:
        words *= 2
    return words


def largest_set(words: int) -> int:
    """Size of the largest set that has a bitmap of ``words``."""
    return 64 * words if words < WIDE_WORDS else 128 * words


def parity_bitmap(members: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of members fall on them, as int64 words. Halves fold
    onto each other by exclusive or, which gives the bitmap of half the size."""
    size = 64 * bitmap_words(members.size)
    spots = (members.view(np.uint64) >> np.uint64(24)).astype(np.int64) % size
    odd = (np.bincount(spots, minlength=size) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    while bitmap.size > words:
        bitmap = bitmap[: bitmap.size // 2] ^ bitmap[bitmap.size // 2 :]
    return bitmap


_SET_SCHEMA = "doc_id long, k1 long, k2 long, n int, short array<long>, map array<long>"
_SET_TYPE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("k1", pa.int64()),
        ("k2", pa.int64()),
        ("n", pa.int32()),
        ("short", pa.list_(pa.int64())),
        ("map", pa.list_(pa.int64())),
    ]
)


def heavy_shingles(docs: DataFrame, width: int, limit: int = HEAVY) -> np.ndarray:
    """At most ``limit`` of the most frequent shingles; they come last in the order.

    A task hands on shingles that occur in at least a 1 / (8 * limit) share of its members, which
    bounds its rows. The choice affects how long lists get, never which links are found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, kept, waiting, total = HashCache(), {}, [], 0

        def settle() -> None:
            values, counts = np.unique(np.concatenate(waiting), return_counts=True)
            often = counts > 1
            for v, c in zip(values[often].tolist(), counts[often].tolist(), strict=True):
                kept[v] = kept.get(v, 0) + c
            if len(kept) > 400_000:
                for v in [v for v, c in kept.items() if c * 32 * limit < total]:
                    del kept[v]
            waiting.clear()

        held = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                members = shingles(text, width, cache)
                waiting.append(members)
                held += members.size
                total += members.size
                if held > 2_000_000:
                    settle()
                    held = 0
        if waiting:
            settle()
        often = [(v, c) for v, c in kept.items() if c > 8 and c * 8 * limit >= total]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v for v, _ in often], pa.int64()), pa.array([c for _, c in often], pa.int64())], ["s", "n"]
        )

    counts = docs.select(F.col("text").cast("binary")).mapInArrow(run, "s long, n long").groupBy("s")
    top = counts.agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(limit)
    return np.sort(np.array([r.s for r in top.collect()], np.int64))


def document_sets(docs: DataFrame, width: int, percent: int, heavy: np.ndarray) -> DataFrame:
    """Per document: set key, set size, members of its short lists, parity bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, last = HashCache(), shared.value
        for batch in batches:
            rows: list[list] = [[] for _ in _SET_TYPE]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                members = shingles(text, width, cache)
                n = members.size
                if n:
                    spot = np.minimum(np.searchsorted(last, members), max(0, last.size - 1))
                    frequent = last[spot] == members if last.size else np.zeros(n, bool)
                    order = np.concatenate([members[~frequent], members[frequent]])
                    short = order[: n - needed(n, percent) + 1].tolist()
                    key = xxhash.xxh3_128_digest(members.tobytes())
                    k1, k2 = np.frombuffer(key, np.int64).tolist()
                    bitmap = parity_bitmap(members).tolist()
                else:
                    short, k1, k2, bitmap = [], 0, 0, []
                for column, value in zip(rows, (doc_id, k1, k2, n, short, bitmap), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _SET_TYPE, strict=True)], schema=_SET_TYPE)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).where("doc_id is not null").mapInArrow(run, _SET_SCHEMA)


def within_bounds(percent: int):
    """Arrow function over two set sizes and bitmaps: whether the sets can reach the similarity."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            sizes_a, maps_a, sizes_b, maps_b = batch
            maps = [[m.values.to_numpy() for m in c] for c in (maps_a, maps_b)]
            for na, a, nb, b in zip(sizes_a.to_pylist(), maps[0], sizes_b.to_pylist(), maps[1], strict=True):
                words = min(a.size, b.size)
                x, y = (folded(v, words).view(np.uint64) for v in (a, b))
                differing = int(np.bitwise_count(x ^ y).sum())
                common = -(-(na + nb) * percent // (100 + percent))
                out.append(100 * min(na, nb) >= percent * max(na, nb) and differing <= na + nb - 2 * common)
            yield pa.array(out, pa.bool_())

    return F.arrow_udf(run, returnType=T.BooleanType())


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the length and bitmap bounds."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("map").alias("map_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("map").alias("map_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(within_bounds(percent)("na", "map_a", "nb", "map_b")).select("a", "b")


def probe(width: int, percent: int):
    """Arrow function: whether two texts reach the similarity, by probes into the sorted set."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        cache = HashCache()
        held: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.int64))
        for first, second in batches:
            out = []
            for a, b in zip(first.to_pylist(), second.to_pylist(), strict=True):
                if held[0] != b:
                    held = b, shingles(b, width, cache)
                x, y = shingles(a, width, cache), held[1]
                common = 0
                if x.size and y.size:
                    spot = np.minimum(np.searchsorted(y, x), y.size - 1)
                    common = int((y[spot] == x).sum())
                out.append(common > 0 and 100 * common >= percent * (x.size + y.size - common))
            yield pa.array(out, pa.bool_())

    return F.arrow_udf(run, returnType=T.BooleanType())


def verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity.

    Both joins read one exchange of the texts by id; few pairs are sent to the texts instead.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("text_id"), F.col("text").cast("binary").alias("body"))
    if pairs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct()
        texts = texts.join(F.broadcast(wanted), texts["text_id"] == wanted["w"], "left_semi")
    left = texts.select(F.col("text_id").alias("a_id"), F.col("body").alias("a_body"))
    right = texts.select(F.col("text_id").alias("b_id"), F.col("body").alias("b_body"))
    both = pairs.join(left, pairs["a"] == left["a_id"]).join(right, F.col("b") == right["b_id"])
    return both.where(probe(width, percent)("a_body", "b_body")).select("a", "b").distinct()


def _allowed(nx: Column, ny: Column, percent: int) -> Column:
    """Most members in which two linked sets may differ: common >= s / (1 + s) * (nx + ny)."""
    together = nx + ny
    return together - 2 * F.ceil(together * percent / (100 + percent) - 1e-9)


def _folded(bitmap: Column, words: int) -> Column:
    """A bitmap folded to ``words``."""
    return F.aggregate(
        F.sequence(F.lit(1), F.size(bitmap), F.lit(words)),
        F.array_repeat(F.lit(0).cast("long"), words),
        lambda done, at: F.zip_with(done, F.slice(bitmap, at, words), lambda a, b: a.bitwiseXOR(b)),
    )


def _differing(x: Column, y: Column, words: int) -> Column:
    """Bits in which two bitmaps of ``words`` differ. Only the smallest are written out word by word:
    a longer expression is not compiled to machine code."""
    if words == BITMAP_WORDS:
        return sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(words)), F.lit(0))
    bits = F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def _met(lists: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components on a common list that pass length and bitmap bounds,
    the smaller set with a bitmap of ``words``."""
    above = largest_set(words // 2) if words > BITMAP_WORDS else 0
    within = (F.col("n") > above) & (F.col("n") * percent <= 100 * largest_set(words))
    maps = sets.where(within).select("doc_id", _folded(F.col("map"), words).alias("map"))
    held = lists.where(within).join(maps, "doc_id")
    x, y = held.alias("x"), held.alias("y")
    pairs = x.join(
        y,
        (F.col("x.s") == F.col("y.s"))
        & (F.col("x.doc_id") > F.col("y.doc_id"))
        & (F.col("x.root") != F.col("y.root"))
        & (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
        & (F.least("x.n", "y.n") <= largest_set(words))
        & (_differing(F.col("x.map"), F.col("y.map"), words) <= _allowed(F.col("x.n"), F.col("y.n"), percent)),
    )
    return pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists (doc_id, n, s) that hold more than one component, with each id's component."""
    owned = lists.join(labels, lists["doc_id"] == labels["id"], "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("root"), "n", "s"
    )
    ends = owned.groupBy(F.col("s").alias("list")).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return owned.join(ends.where("low <> high"), F.col("s") == F.col("list")).select("doc_id", "root", "n", "s")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of consecutive rows (doc_id, root, s) of one list that lie in different components."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if last is not None:
            rows = np.concatenate([last, rows], axis=1)
        last = rows[:, -1:]
        doc, root, s = rows
        meet = (s[1:] == s[:-1]) & (root[1:] != root[:-1])
        ends = np.sort(np.stack([doc[:-1][meet], doc[1:][meet]]), axis=0)
        ends = np.unique(ends, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(ends[1]), pa.array(ends[0])], ["a", "b"])


def link_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, class_id (smallest id with an equal set)."""
    docs = docs.select("doc_id", "text")
    sets = stored(document_sets(docs, width, percent, heavy_shingles(docs, width)), "ngram-sets")
    some = sets.where("n > 0")
    classes = some.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    reps = some.join(classes.select("rep"), some["doc_id"] == F.col("rep"), "left_semi").dropDuplicates(["doc_id", "k1", "k2"])
    reps = stored(reps.select("doc_id", "n", "short", "map"), "ngram-classes")
    lists = reps.select("doc_id", F.explode("short").alias("s"))
    on_list = Window.partitionBy("s")
    met = lists.withColumn("center", F.min("doc_id").over(on_list)).where("center <> doc_id")
    votes = met.groupBy("doc_id", "center").agg(F.count("*").alias("lists"))
    best = votes.groupBy("doc_id").agg(F.max(F.struct("lists", (-F.col("center")).alias("minus"))).alias("best"))
    pairs = best.select(F.col("doc_id").alias("a"), (-F.col("best.minus")).alias("b"))
    pairs = stored(possible(pairs, reps, percent), "ngram-candidates")
    links = stored(verified(docs, pairs, width, percent), "ngram-links")
    lists, labels, turn = reps.select("doc_id", "n", F.explode("short").alias("s")), components(links), 0
    while True:
        apart = stored(_open_lists(lists, labels), "ngram-open")
        mark = F.array_min(F.transform("short", lambda m: F.xxhash64(m, F.lit(turn))))
        marked = apart.join(reps.select("doc_id", mark.alias("mark")), "doc_id")
        pairs = marked.repartitionByRange("s", "mark", "root").sortWithinPartitions("s", "mark", "root", "doc_id")
        pairs = pairs.select("doc_id", "root", "s").mapInArrow(_neighbours, "a long, b long").distinct()
        pairs = stored(possible(pairs, reps, percent), "ngram-candidates")
        found = stored(verified(docs, pairs, width, percent), "ngram-links")
        n_found, turn = found.count(), turn + 1
        if n_found:
            links = links.unionByName(found)
            labels = components(links)
        if n_found * FEW <= pairs.count():
            break
        lists = apart.drop("root")
    if n_found:
        apart = stored(_open_lists(apart.drop("root"), labels), "ngram-open")
    largest = apart.agg(F.max("n")).first()[0]
    if largest is not None:
        steps = [BITMAP_WORDS << i for i in range((bitmap_words(largest) // BITMAP_WORDS).bit_length())]
        met = [_met(apart, reps, words, percent) for words in steps]
        more = reduce(DataFrame.unionByName, met).distinct()
        more = stored(possible(more, reps, percent), "ngram-candidates")
        if more.limit(1).count():
            links = links.unionByName(verified(docs, more, width, percent))
            labels = components(stored(links, "ngram-links"))
    # Copies look their class up by their set; sets without members are classes of their own.
    named = classes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "rep")
    own = (F.col("n") > 0) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))
    result = sets.select("doc_id", "n", F.when(F.col("n") > 0, F.col("k1")).otherwise(F.xxhash64("doc_id")).alias("k1"), "k2")
    result = result.join(named, own, "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("class_id"))
    result = result.join(labels, result["class_id"] == labels["id"], "left")
    return result.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "class_id").alias("component_id"),
        "class_id",
    )


def keep_one(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One document (the smallest id) of every component, with all columns; rows without id stay,
    and of rows repeated under one id a single one stays."""
    found = link_components(docs, width, percent)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    named = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.join(kept, named["doc_id"] == kept["kept_id"], "left_semi").unionByName(docs.where("doc_id is null"))
