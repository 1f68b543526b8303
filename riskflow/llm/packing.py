"""Hierarchical multi-length packing of documents into training sequences.

Sequences have the length of a tier: the context size, or a half, quarter, eighth of it. A document
is cut into windows of the context size, which are sequences of their own; what is left of it is
routed to the tier that just holds it. Tiers are packed from long to short: a window takes the
longest piece routed to it, then whole pieces of shorter tiers, the longest that fits first, and
when none fits, the head of one more piece closes the gap; its rest is routed again. So every
window is full, and at most one document is cut per window.

Documents are packed where they are read, without a shuffle: a task keeps a pool of some thousand
pieces. The few tokens that fill no window at a task's end (fewer than the shortest tier) are
stored with the rest and packed by a second, small job; what is left there, too, is cut into
sequences whose lengths are powers of two. Nothing is padded.

Step groups: sequences of one tier are dealt to groups of ``group_tokens`` tokens so that the
groups of a round cost alike (the sum of squared piece lengths, as attention within documents
does); the last groups of a task are smaller.

A null or empty text is a document of the end token alone. Rows are independent: repeated rows are
packed each, under their own id, null or not. Other columns than ``doc_id`` and ``text`` are not
read. Very long texts take memory in proportion to the longest. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from riskflow.llm.common import stored
from riskflow.llm.token_counts import byte_letters

CONTEXT, TIERS = 1024, 4
GROUP_TOKENS = 64 * CONTEXT
#: Pieces in a task's pool, pieces of a batch of results, step groups dealt at a time.
POOL, BATCH, ROUND = 4096, 4096, 32
END = np.array([0], "<u4").tobytes()
# The published pre-tokenizer pattern of byte-level BPE.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_TWO_WHITE = re.compile(r"\s\s")
_CACHED_CHARS, _CACHED_WORDS = 48, 400_000


class Encoder(dict):
    """Texts to ids, each an unsigned little-endian 32-bit number, as the tokenizers library gives
    them for a byte-level BPE file, without added tokens; special strings become their ids.

    No token spans the place before a single space, so words are encoded one by one, with the
    space before them, and kept for the next text. Texts with two white characters in a row are
    encoded whole. Where a vocabulary's ids follow its merges, words that are not kept yet are
    encoded by tiktoken, which gives the same ids sooner; otherwise by the library itself.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        if merged == sorted(merged):
            ranks = {raw(t): i for t, i in vocab.items() if t not in special}
            fast = tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.plain = fast.encode_ordinary
        else:
            library = Tokenizer.from_file(path)
            self.plain = lambda text: library.encode(text, add_special_tokens=False).ids
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def __missing__(self, word: str) -> bytes:
        ids = self._bytes(" " + word)
        if len(word) <= _CACHED_CHARS:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def _bytes(self, text: str) -> bytes:
        return np.array(self.plain(text), "<u4").tobytes()

    def _part(self, text: str) -> bytes:
        if not text or _TWO_WHITE.search(text):
            return self._bytes(text)
        first, *rest = text.split(" ")  # a space at the end stands alone, before an empty word
        return self._bytes(first) + b"".join(map(self.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            return self._part(text)
        return b"".join(self.special.get(p) or self._part(p) for p in self.split.split(text) if p)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and Python process, so kept words serve all tasks there."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """Packs the pieces of one task, (doc_id, start, ids, doc_tokens) each. ``base`` keeps its
    sequence and group ids apart from other tasks'."""

    def __init__(self, context: int, tiers: int, group_tokens: int, base: int) -> None:
        self.context, self.group_tokens = context, group_tokens
        self.tiers = [context >> k for k in range(tiers)]
        self.pool: list[list[tuple]] = [[] for _ in range(context + 1)]
        self.mask = self.total = self.pieces = 0  # sizes present, tokens and pieces in the pool
        self.next_sequence = self.next_group = base
        self.waiting: dict[int, list[list[tuple]]] = {}
        self.done: list[tuple] = []  # piece, sequence, offset, tier, group

    def add(self, doc: object, start: int, ids: bytes, doc_tokens: int) -> None:
        """Take a document or a piece of one; windows of the context size are done at once."""
        step = 4 * self.context
        for at in range(0, len(ids) - step + 1, step):
            self._sequence([(doc, start + at // 4, ids[at : at + step], doc_tokens)], self.context)
        if rest := len(ids) % step:
            self._put((doc, start + (len(ids) - rest) // 4, ids[-rest:], doc_tokens))

    def _put(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        self.pool[size].append(piece)
        self.mask |= 1 << size
        self.total += size
        self.pieces += 1

    def _take(self, size: int) -> tuple:
        bucket = self.pool[size]
        piece = bucket.pop()
        if not bucket:
            self.mask &= ~(1 << size)
        self.total -= size
        self.pieces -= 1
        return piece

    def _fitting(self, room: int) -> tuple:
        """The longest whole piece within ``room``, or the head of the shortest longer one."""
        if within := self.mask & ((2 << room) - 1):
            return self._take(within.bit_length() - 1)
        longer = self.mask >> (room + 1) << (room + 1)
        doc, start, ids, doc_tokens = self._take((longer & -longer).bit_length() - 1)
        self._put((doc, start + room, ids[4 * room :], doc_tokens))
        return doc, start, ids[: 4 * room], doc_tokens

    def pack(self, last: bool = False) -> None:
        """Fill windows, long tiers first. Fewer tokens than the shortest tier stay in the pool,
        unless ``last``: then they leave as sequences of the powers of two they add up to."""
        below = [self.tiers[-1] >> k for k in range(1, self.tiers[-1].bit_length())] if last else []
        for tier in [*self.tiers, *below]:
            # Shorter pieces open no window of this tier; from the shortest tier on, all do.
            opens = tier // 2 if tier > self.tiers[-1] else 0
            while self.total >= tier and self.mask >> (opens + 1):
                window, room = [], tier
                while room:
                    window.append(self._fitting(room))
                    room -= len(window[-1][2]) // 4
                self._sequence(window, tier)

    def _sequence(self, window: list[tuple], tier: int) -> None:
        waiting = self.waiting.setdefault(tier, [])
        waiting.append(window)
        if len(waiting) * tier >= ROUND * self.group_tokens:
            self._deal(tier)

    def _deal(self, tier: int) -> None:
        """Number the waiting sequences of a tier and deal them to groups of like cost: by falling
        cost, forth and back over the groups."""
        windows = self.waiting.pop(tier, [])
        groups = -(-len(windows) * tier // self.group_tokens)
        cost = [sum(len(p[2]) ** 2 for p in w) for w in windows]
        for rank, k in enumerate(sorted(range(len(windows)), key=lambda k: -cost[k])):
            turn, column = divmod(rank, groups)
            group = self.next_group + (column if turn % 2 == 0 else groups - 1 - column)
            offset = 0
            for piece in windows[k]:
                self.done.append((piece, self.next_sequence, offset, tier, group))
                offset += len(piece[2]) // 4
            self.next_sequence += 1
        self.next_group += groups

    def finish(self, last: bool) -> None:
        self.pack(last)
        for tier in list(self.waiting):
            self._deal(tier)
        if not last:
            rest = [p for bucket in self.pool for p in bucket]
            self.done += [(piece, None, None, None, None) for piece in rest]


def _table(done: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    rows = [
        (doc, start, len(ids) // 4, ids, doc_tokens, sequence, offset, tier, group)
        for (doc, start, ids, doc_tokens), sequence, offset, tier, group in done
    ]
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _schemas(doc_type: T.DataType) -> T.StructType:
    names = {"start": T.LongType(), "length": T.LongType(), "ids": T.BinaryType(), "doc_tokens": T.LongType()}
    names |= {"sequence_id": T.LongType(), "offset": T.LongType(), "tier": T.IntegerType(), "step_group": T.LongType()}
    return T.StructType([T.StructField("doc_id", doc_type), *(T.StructField(n, t) for n, t in names.items())])


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    context: int = CONTEXT,
    tiers: int = TIERS,
    group_tokens: int = GROUP_TOKENS,
    end: bytes = END,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (unsigned little-endian 32-bit), doc_tokens,
    sequence_id, offset, tier (length of its sequence) and step_group.

    ``context`` is a power of two; ``tokenizer_path`` a byte-level BPE file every executor has.
    Which documents share a sequence depends on how the input is split; that every token is in
    one piece and every sequence full does not.
    """
    if context & (context - 1) or context >> tiers < 1:
        raise ValueError("context must be a power of two with room for the tiers")
    schema = _schemas(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, encode = to_arrow_schema(schema), encoder(tokenizer_path).encode
        packer = Packer(context, tiers, group_tokens, (level << 24) + TaskContext.get().partitionId() << 32)
        for batch in batches:
            if level:
                for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True):
                    packer.add(*row)
            else:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = encode(text.as_py() or "") + end
                    packer.add(doc, 0, ids, len(ids) // 4)
                    if packer.pieces >= POOL:
                        packer.pack()
                    if len(packer.done) >= BATCH:
                        yield _table(packer.done, arrow)
                        packer.done = []
        packer.finish(last=level > 0)
        if packer.done:
            yield _table(packer.done, arrow)

    packed = stored(docs.select("doc_id", "text").mapInArrow(lambda b: run(b, 0), schema), "packed")
    rest = packed.where("sequence_id is null")
    tasks = 1 + rest.count() // 65536
    spread = rest.repartition(tasks).sortWithinPartitions("doc_id", "start", F.crc32("ids"))
    return packed.where("sequence_id is not null").unionByName(spread.mapInArrow(lambda b: run(b, 1), schema))
