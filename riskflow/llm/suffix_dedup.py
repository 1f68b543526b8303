"""Removal of repeated byte strings with sorted suffixes.

Every byte covered by a string of ``length`` bytes that also starts anywhere else is removed.

Only suffixes at anchors are sorted. The anchor of a start p is the leftmost position of the least
8-byte hash among p .. p + reach - 1, so equal strings have their anchors at equal offsets, and an
anchor stands for a run of up to ``reach`` starts. The block of length - reach + 1 bytes at an
anchor lies inside all strings of its run: an anchor whose block occurs nowhere else has no
repeated string. For the others the text around the run is cut out; equal cuts form one class, so
copies cost one row. A class with two members is repeated as a whole.

The classes' suffixes (from the anchor on) are range-partitioned by their leading bytes between
sampled splitters, which keeps equal leading bytes together: neighbours across a boundary differ
within these bytes, far before a block ends, so a boundary never parts a match. Each partition
sorts by multikey quicksort; where neighbours share ``length - o`` bytes, the ``o`` bytes before
their anchors are compared.

Null and empty texts have no bytes and lose none. Rows without id are left out; rows repeated under
one id are one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored

LENGTH, REACH, LEAD = 400, 200, 32


def starts_by_anchor(data: bytes, length: int, reach: int) -> list[tuple[int, int, int]]:
    """(anchor, first start, last start) for all starts of strings of ``length`` bytes."""
    n = len(data) - length + 1
    if n <= 0:
        return []
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    m = n + reach - 1
    h = np.zeros(m, np.uint64)
    for i in range(8):
        h = (h ^ raw[i : i + m]) * np.uint64(0x9E3779B97F4A7C15)
    key = (h >> np.uint64(32)) << np.uint64(32) | np.arange(m, dtype=np.uint64)
    padded = np.full(-(-m // reach) * reach, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = key
    rows = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    anchor = (np.minimum(behind[:n], ahead[reach - 1 : reach - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(anchor)) + 1
    first = np.concatenate([[0], cuts])
    last = np.concatenate([cuts, [n]]) - 1
    return list(zip(anchor[first].tolist(), first.tolist(), last.tolist(), strict=True))


def multikey_sorted(suffixes: list[bytes]) -> list[int]:
    """Order of the suffixes: three-way quicksort on eight bytes at a time."""
    order: list[int] = []
    stack = [(list(range(len(suffixes))), 0)]
    while stack:
        part, depth = stack.pop()
        if len(part) < 2 or depth >= max(len(suffixes[i]) for i in part):
            order += part
            continue
        pivot = suffixes[part[len(part) // 2]][depth : depth + 8]
        less, same, more = [], [], []
        for i in part:
            word = suffixes[i][depth : depth + 8]
            (less if word < pivot else more if word > pivot else same).append(i)
        stack += [(more, depth), (same, depth + 8), (less, depth)]
    return order


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax())


def repeated_starts(cuts: list[tuple[bytes, int, int]], length: int) -> list[list[int]]:
    """For classes (cut, offset of the anchor, number of starts): starts that occur in two of them."""
    suffixes = [cut[at : at + length] for cut, at, _ in cuts]
    order = multikey_sorted(suffixes)
    shared = [common_prefix(suffixes[a], suffixes[b]) for a, b in zip(order, order[1:], strict=False)]
    found: list[list[int]] = [[] for _ in cuts]
    for before in range(max((at for _, at, _ in cuts), default=0) + 1):
        run: dict[bytes, list[int]] = {}
        for place, i in enumerate(order):
            if place and shared[place - 1] < length - before:
                run = {}
            cut, at, starts = cuts[i]
            start = at - before
            if 0 <= start < starts:
                met = run.setdefault(cut[start:at], [])
                if len(met) < 2:
                    met.append(i)
                    if len(met) == 2:
                        found[met[0]].append(start_of(cuts[met[0]], before))
                        found[i].append(start)
                else:
                    found[i].append(start)
    return found


def start_of(cut: tuple[bytes, int, int], before: int) -> int:
    return cut[1] - before


def _anchors(length: int, reach: int):
    block = length - reach + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, hashes = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for anchor, _, _ in starts_by_anchor(text or b"", length, reach):
                    ids.append(doc_id)
                    at.append(anchor)
                    hashes.append(xxhash.xxh3_64_intdigest(text[anchor : anchor + block]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(at, pa.int32()), pa.array(np.array(hashes, np.uint64).view(np.int64))],
                ["doc_id", "anchor", "block"],
            )

    return run


def runs_of(starts: list[int]) -> list[dict[str, int]]:
    """Ascending starts as runs of neighbours."""
    out: list[dict[str, int]] = []
    for start in sorted(starts):
        if out and start == out[-1]["high"] + 1:
            out[-1]["high"] = start
        else:
            out.append({"low": start, "high": start})
    return out


_RUNS = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
_FOUND_DDL = "k1 long, k2 long, found array<struct<low:int,high:int>>"
_CUT = pa.schema(
    [("k1", pa.int64()), ("k2", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int32())]
    + [("at", pa.int32()), ("starts", pa.int32()), ("cut", pa.binary())]
)
_CUT_DDL = "k1 long, k2 long, block long, doc_id long, first int, at int, starts int, cut binary"
BROADCAST_IDS = 1_000_000
#: Cuts sent on at a time; bounds what a Python worker holds.
OUT_ROWS = 5_000


def _cuts(length: int, reach: int, with_cut: bool):
    block = length - reach + 1

    def packed(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _CUT, strict=True)], schema=_CUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[] for _ in _CUT]
        for batch in batches:
            for doc_id, text, anchors in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                wanted = set(anchors)
                for anchor, first, last in starts_by_anchor(text, length, reach):
                    if anchor in wanted:
                        cut = text[first : last + length]
                        k1, k2 = np.frombuffer(xxhash.xxh3_128_digest(cut, seed=anchor - first), np.int64).tolist()
                        near = xxhash.xxh3_64_intdigest(text[anchor : anchor + block])
                        near = near - (1 << 64) if near >> 63 else near
                        values = k1, k2, near, doc_id, first, anchor - first, last - first + 1, cut if with_cut else None
                        for column, value in zip(rows, values, strict=True):
                            column.append(value)
                if len(rows[0]) >= OUT_ROWS:
                    yield packed(rows)
                    rows = [[] for _ in _CUT]
        yield packed(rows)

    return run


def _compare(length: int, block: int):
    """Over rows sorted by their leading bytes: starts of each class that another class has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def settle() -> pa.RecordBatch:
            groups: dict[bytes, list[tuple]] = {}
            for row in held:
                groups.setdefault(row[2][row[3] : row[3] + block], []).append(row)
            out: list[list] = [[], [], []]
            for group in groups.values():
                if len(group) > 1:
                    found = repeated_starts([(cut, at, starts) for _, _, cut, at, starts in group], length)
                    for row, starts in zip(group, found, strict=True):
                        if starts:
                            for column, value in zip(out, (row[0], row[1], runs_of(starts)), strict=True):
                                column.append(value)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], _RUNS)], ["k1", "k2", "found"]
            )

        lead = None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row[0] != lead and len(held) > 2_000:
                    yield settle()
                lead = row[0]
                held.append(row[1:])
        yield settle()

    return run


def _merged(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Byte runs covered by strings whose starts lie in the given ranges."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(starts):
        stop = high + length
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((low, stop))
    return out


_KEPT = "struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary,kept_sha256:string>"


def _keep(length: int, with_text: bool):
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in batches:
            rows = []
            for text, found in zip(texts.to_pylist(), ranges.to_pylist(), strict=True):
                text = text or b""
                runs = _merged([(r["low"], r["high"]) for r in found or []], length)
                at, parts = 0, []
                for low, stop in runs:
                    parts.append(text[at:low])
                    at = stop
                kept = b"".join([*parts, text[at:]])
                rows.append(
                    {"n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(runs), "kept": kept if with_text else None, "kept_sha256": hashlib.sha256(kept).hexdigest()}
                )
            yield pa.array(
                rows,
                pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())]),
            )

    return F.arrow_udf(run, returnType=_KEPT)


def _cut_out(texts: DataFrame, wanted: DataFrame, length: int, reach: int, with_cut: bool) -> DataFrame:
    """A row for each wanted (doc_id, anchor). Only the texts of wanted documents are shuffled if
    their ids are few enough to be sent out."""
    wanted = stored(wanted.groupBy(F.col("doc_id").alias("wanted_id")).agg(F.collect_set("anchor").alias("anchors")), "suffix-wanted")
    ids = wanted.select(F.col("wanted_id").alias("sent_id"))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(ids), texts["doc_id"] == ids["sent_id"], "left_semi")
    some = texts.join(wanted, texts["doc_id"] == wanted["wanted_id"]).select("doc_id", "text", "anchors")
    return some.mapInArrow(_cuts(length, reach, with_cut), _CUT_DDL)


def repeated_ranges(docs: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """Columns doc_id, ranges (array of low, high): starts of strings that also start elsewhere."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = texts.where("doc_id is not null")
    anchors = texts.mapInArrow(_anchors(length, reach), "doc_id long, anchor int, block long")
    anchors = stored(anchors, "suffix-anchors")
    often = anchors.groupBy("block").agg(F.count("*").alias("n")).where("n > 1").select(F.col("block").alias("often"))
    wanted = anchors.join(often, anchors["block"] == often["often"], "left_semi").select("doc_id", "anchor")
    cuts = _cut_out(texts, wanted, length, reach, False).drop("cut").dropDuplicates(["doc_id", "first"])
    cuts = stored(cuts, "suffix-cuts")
    # Classes alone with their block have nobody to be compared with; the others send one cut each.
    classes = cuts.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "first", "at", "block")).alias("one"))
    crowded = classes.groupBy("one.block").agg(F.count("*").alias("n")).where("n > 1").select(F.col("block").alias("crowded"))
    ones = classes.join(crowded, classes["one.block"] == crowded["crowded"], "left_semi")
    ones = ones.select(F.col("one.doc_id").alias("doc_id"), (F.col("one.first") + F.col("one.at")).alias("anchor"))
    blobs = _cut_out(texts, ones, length, reach, True).dropDuplicates(["doc_id", "first"])
    blobs = blobs.select("k1", "k2", "cut", "at", "starts", F.expr(f"substring(cut, at + 1, {LEAD})").alias("lead"))
    parted = blobs.repartitionByRange("lead").sortWithinPartitions("lead").select("lead", "k1", "k2", "cut", "at", "starts")
    found = parted.mapInArrow(_compare(length, length - reach + 1), _FOUND_DDL)
    several = cuts.groupBy("k1", "k2").agg(F.count("*").alias("members")).where("members > 1")
    light = cuts.select("k1", "k2", "doc_id", "first", "starts")
    whole = light.join(several, ["k1", "k2"], "left_semi").select(
        "doc_id", F.struct(F.col("first").alias("low"), (F.col("first") + F.col("starts") - 1).alias("high")).alias("range")
    )
    single = light.join(found, ["k1", "k2"]).select("doc_id", "first", F.explode("found").alias("s"))
    single = single.select("doc_id", F.struct((F.col("first") + F.col("s.low")).alias("low"), (F.col("first") + F.col("s.high")).alias("high")).alias("range"))
    return whole.unionByName(single).groupBy("doc_id").agg(F.collect_list("range").alias("ranges"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, reach: int = REACH, with_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256."""
    ranges = repeated_ranges(docs, length, reach).withColumnRenamed("doc_id", "range_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).where("doc_id is not null")
    joined = rows.join(ranges, rows["doc_id"] == ranges["range_id"], "left")
    return joined.select("doc_id", _keep(length, with_text)("text", "ranges").alias("r")).select("doc_id", "r.*")
