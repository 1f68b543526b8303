"""Exact byte-pair token counts at every prefix of a text, by dynamic programming.

For a byte string s let t(i) be the last token of the encoding of s[:i]. Byte-pair encoding has
the property that a token sequence is the encoding of its bytes exactly if every two neighbours
are the encoding of theirs. So t(i) is the one token ending at i whose start j is 0 or whose
predecessor t(j) may stand before it, and count(i) = count(j) + 1. One pass over a piece gives
the count of all its prefixes.

A text is cut before each run of white space; no token spans such a cut, so the counts of a
chunk's prefixes depend on the chunk alone and are kept for the next text that has it. A text's
table holds, for every code point, by how much the count changes when the prefix grows by it: one
signed byte each. The count of any prefix is the sum of its bytes, and the longest prefix within a
budget of tokens is read off the same table, or off the one chunk in which it ends; neither encodes
anything again. A prefix that ends within a special string counts it as ordinary text, and the
whole string as the one token it is.

A null or empty text has no tokens and an empty table. Rows are independent: repeated rows give
repeated results. No shuffle, no model to send: each task reads the vocabulary file.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT = 1024
_WHITE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
# The published pre-tokenizer pattern of byte-level BPE, without its white-space alternatives.
_PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
)
_SUFFIXES = ("'re", "'ve", "'ll")
_CACHED_CHARS, _CACHED_CHUNKS = 48, 600_000
#: Prefixes of these lengths, in bytes, keep their state for later pieces that begin alike.
_SHARED_BYTES, _SHARED_PREFIXES = (9, 7, 5), 300_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others take the code points from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[raw(left), raw(right)] = rank
        tokens = {raw(t) for t in spec["model"]["vocab"] if all(c in letters for c in t)}
        # Only tokens that the merges give for their own bytes can occur. Each has the two parts of
        # its last merge, and that merge's rank.
        self.parts: dict[bytes, tuple[bytes, bytes, int]] = {}
        self.tokens = {t for t in tokens if len(t) == 1 or self._is_whole(t)}
        # With ranks that rise from parts to wholes, merges happen in the order of their ranks.
        self.rising = all(
            p not in self.parts or self.parts[p][2] < rank for *both, rank in self.parts.values() for p in both
        )
        self.longest = max(map(len, self.tokens))
        # The longest token that ends with each byte.
        self.sizes: dict[int, int] = {}
        for t in self.tokens:
            self.sizes[t[-1]] = max(len(t), self.sizes.get(t[-1], 0))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.allowed: dict[tuple[bytes, bytes], bool] = {}
        self.pieces: dict[bytes, list[int]] = {}
        self.begun: dict[bytes, tuple[list[int], list[bytes]]] = {}
        self.chunks: dict[str, tuple[bytes, int]] = {}

    def _is_whole(self, token: bytes) -> bool:
        """Whether the merges give the token for its own bytes; notes its last merge."""
        last = self.merged(token, 2)
        rank = self.ranks.get(tuple(last)) if len(last) == 2 else None
        if rank is not None:
            self.parts[token] = (*last, rank)
        return rank is not None

    def merged(self, data: bytes, down_to: int = 1) -> list[bytes]:
        """Plain byte-pair encoding: merge the pair of the lowest rank until none is left, or until
        ``down_to`` parts are."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            ranks = [self.ranks.get(pair, 1 << 60) for pair in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == 1 << 60:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def may_follow(self, left: bytes, right: bytes) -> bool:
        known = self.allowed.get((left, right))
        if known is None:
            if len(self.allowed) > 1_000_000:
                self.allowed.clear()
            if self.rising:
                known = self._stay_apart(left, right)
            else:
                known = self.merged(left + right) == [left, right]
            self.allowed[left, right] = known
        return known

    def _stay_apart(self, left: bytes, right: bytes) -> bool:
        """Whether no merge joins two neighbouring tokens: undoes their merges, the latest first (of
        equal ones the right one, as merges go from left to right), and looks whether the parts that
        then meet would have been joined before the merge undone."""
        ranks, parts = self.ranks, self.parts
        a, b = parts.get(left), parts.get(right)
        limit = len(ranks)
        while True:
            rank = ranks.get((left, right))
            if rank is not None and rank < limit:
                return False
            if a is not None and (b is None or a[2] > b[2]):
                left, limit = a[1], a[2]
                a = parts.get(left)
            elif b is not None:
                right, limit = b[0], b[2] + 1
                b = parts.get(right)
            else:
                return True

    def piece_counts(self, data: bytes) -> list[int]:
        """Token count of every byte prefix of a piece that the pre-tokenizer leaves whole."""
        known = self.pieces.get(data)
        if known is not None:
            return known
        size = len(data)
        tokens, allowed, sizes, begun = self.tokens, self.allowed, self.sizes, self.begun
        counts, last = [0], [b""]
        for shared in _SHARED_BYTES:
            if size > shared and (state := begun.get(data[:shared])) is not None:
                counts, last = state[0].copy(), state[1].copy()
                break
        resumed = len(counts)
        for end in range(resumed, size + 1):
            # The longest token is tried first: it is nearly always the right one.
            for start in range(max(0, end - sizes[data[end - 1]]), end):
                token = data[start:end]
                if token in tokens:
                    if start:
                        before = last[start]
                        ok = allowed.get((before, token))
                        if ok is None:
                            ok = self.may_follow(before, token)
                        if not ok:
                            continue
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        if size <= _CACHED_CHARS:
            if len(self.pieces) >= _CACHED_CHUNKS:
                self.pieces.clear()
            self.pieces[data] = counts
        for shared in _SHARED_BYTES:
            if resumed <= shared < size:
                if len(begun) >= _SHARED_PREFIXES:
                    begun.clear()
                begun[data[:shared]] = counts[: shared + 1], last[: shared + 1]
        return counts

    def at_chars(self, piece: str) -> list[int]:
        """Token count of every code-point prefix of a piece, from its first code point on."""
        data = piece.encode()
        counts = self.piece_counts(data)
        if len(data) == len(piece):
            return counts[1:]
        ends = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)[1:].tolist()
        return [counts[e] for e in ends] + [counts[-1]]

    def chunk(self, chunk: str) -> tuple[bytes, int]:
        """Count at each code point, modulo 256, and the count of the whole chunk."""
        known = self.chunks.get(chunk)
        if known is not None:
            return known
        body = chunk.lstrip()
        white = len(chunk) - len(body)
        if white and not all(c in _WHITE_SET for c in chunk[:white]):  # lstrip() strips more
            white = next((i for i, c in enumerate(chunk) if c not in _WHITE_SET), len(chunk))
        # Letters, with one space before them or none, are one piece.
        if (not white or chunk[:white] == " ") and body.isalpha():
            counts = self.at_chars(chunk)
            return self._kept(chunk, counts)
        counts = self.at_chars(chunk[:white]) if white else []
        base, at = 0, white
        if white < len(chunk):
            # The last space of the run belongs to the next piece; another last character of
            # white space is a piece of its own.
            if white > 1:
                base = counts[white - 2]
            if white and chunk[white - 1] != " ":
                base += self.at_chars(chunk[white - 1])[0]
            elif white:
                at = white - 1
        while at < len(chunk):
            piece = chunk[at:] if chunk[white:].isalpha() else _PIECE.match(chunk, at).group()
            steps = self.at_chars(piece)
            if piece in _SUFFIXES:
                steps = [steps[0], steps[0] + self.at_chars(piece[1])[0], steps[2]]
            skip = max(0, white - at)
            counts += [base + n for n in (steps[skip:] if skip else steps)]
            base += steps[-1]
            at += len(piece)
        return self._kept(chunk, counts)

    def _kept(self, chunk: str, counts: list[int]) -> tuple[bytes, int]:
        """The counts of a chunk at every code point, remembered if it is short."""
        # Counts of up to 31 code points lie within 0 and 124, so steps fit; those of up to 63 within 252.
        if len(chunk) > 31:
            steps = [n - m for n, m in zip(counts, [0, *counts], strict=False)]
            if min(steps) < -128 or max(steps) > 127:
                raise OverflowError("a step of the prefix table does not fit a byte")
        result = bytes(counts if len(chunk) < 64 else [n & 255 for n in counts]), counts[-1]
        if len(chunk) <= _CACHED_CHARS:
            if len(self.chunks) >= _CACHED_CHUNKS:
                self.chunks.clear()
            self.chunks[chunk] = result
        return result

    def _plain(self, text: str) -> tuple[list[bytes], list[int]]:
        """The counts of each chunk, and at its end."""
        known, make = self.chunks.get, self.chunk
        found = [known(c) or make(c) for c in _CHUNK.findall(text)]
        return [t for t, _ in found], [n for _, n in found]

    def table(self, text: str) -> tuple[bytes, int]:
        """The prefix table of a text, and its token count."""
        if not self._has_special(text):
            counts, ends = self._plain(text)
            return _steps(counts), sum(ends)
        out: list[bytes] = []
        total, parts = 0, self.special_split.split(text)
        for plain, special in zip(parts[::2], [*parts[1::2], ""], strict=True):
            counts, ends = self._plain(plain)
            count = sum(ends)
            if special:
                partly, before = self._plain(plain + special[:-1])
                out.append(_steps(partly))
                out.append(np.int8(count + 1 - sum(before)).tobytes())
                count += 1
            else:
                out.append(_steps(counts))
            total += count
        return b"".join(out), total

    def _has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def count_within(self, text: str, budget: int) -> tuple[int, int]:
        """The token count of a text, and the code points of its longest prefix within ``budget``."""
        if self._has_special(text):
            table, total = self.table(text)
            return total, prefix_length(table, budget)
        counts, ends = self._plain(text)
        ends = list(accumulate(ends))
        total = ends[-1] if ends else 0
        if total <= budget:
            return total, len(text)
        # Any prefix that ends in a later chunk has a token more than all up to this one.
        last = bisect_left(ends, budget)
        rest = budget - (ends[last - 1] if last else 0)
        return total, sum(map(len, counts[:last])) + prefix_length(_steps(counts[last : last + 1]), rest)


def _steps(counts: list[bytes]) -> bytes:
    """By how much the count grows at each code point, from the counts of successive chunks."""
    if not counts:
        return b""
    at = np.frombuffer(b"".join(counts), np.uint8)
    steps = at.copy()
    steps[1:] -= at[:-1]
    starts = np.fromiter(accumulate(map(len, counts[:-1]), initial=0), np.int64, len(counts))
    steps[starts] = at[starts]
    return steps.tobytes()


_WHITE_SET = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{_WHITE}]", c))
_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per file and Python process, so its tables serve all tasks there."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_length(table: bytes, budget: int) -> int:
    """Code points of the longest prefix whose tokens do not exceed ``budget``."""
    counts = np.cumsum(np.frombuffer(table, np.int8), dtype=np.int64)
    within = np.flatnonzero(counts <= budget)
    return int(within[-1]) + 1 if within.size else 0


def add_prefix_table(docs: DataFrame, name: str, tokenizer_path: str) -> DataFrame:
    """Add binary ``name``: the prefix table of each text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        prefixes = counter(tokenizer_path)
        for batch in batches:
            yield pa.array([prefixes.table(t or "")[0] for t in batch.to_pylist()], pa.binary())

    return docs.withColumn(name, F.arrow_udf(run, returnType="binary")("text"))


@F.arrow_udf(T.LongType())
def tokens_of_prefix(table: pa.Array, n_chars: pa.Array) -> pa.Array:
    """Tokens of the first ``n_chars`` code points, from a prefix table."""
    pairs = zip(table.to_pylist(), n_chars.to_pylist(), strict=True)
    return pa.array([int(np.frombuffer(t[: max(0, n)], np.int8).sum(dtype=np.int64)) for t, n in pairs], pa.int64())


@F.arrow_udf(T.LongType())
def longest_prefix(table: pa.Array, budget: pa.Array) -> pa.Array:
    """Code points of the longest prefix within ``budget`` tokens, from a prefix table."""
    pairs = zip(table.to_pylist(), budget.to_pylist(), strict=True)
    return pa.array([prefix_length(t, b) for t, b in pairs], pa.int64())


_COUNTS_TYPE = pa.struct([("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_chars_within", pa.int64())])


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: n_bytes, n_tokens, over_limit, and the code points that fit the limit.

    Only the chunk in which the limit falls is looked into for the latter.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        prefixes = counter(tokenizer_path)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.fill_null("")).cast(pa.int64())
            found = [prefixes.count_within(text or "", limit) for text in batch.to_pylist()]
            columns = [sizes, *(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))]
            yield pa.StructArray.from_arrays(columns, fields=list(_COUNTS_TYPE))

    counts = F.arrow_udf(run, returnType="struct<n_bytes:long,n_tokens:long,n_chars_within:long>")
    return docs.select("doc_id", counts("text").alias("c")).select(
        "doc_id",
        "c.n_bytes",
        "c.n_tokens",
        (F.col("c.n_tokens") > limit).alias("over_limit"),
        F.col("c.n_chars_within").alias("chars_within_limit"),
    )
