"""Repair of conversation structure by a generalised LR parser with weighted edits.

The grammar of the role initials, ``(s?(ua)+)?``, is turned into an LR automaton. A parser reads
the rows of a conversation in order and, for every row, tries to keep it (0), to give it the role
user or assistant (1) or to delete it (2), after inserting empty rows of these roles (5 each) where
that helps. Its stacks form a graph: a stack is a node with a state on top and a link to the node
below. Nodes with equal tops are merged, and the one with the smallest (cost, audit) stays; what
may follow depends on the top alone, so nothing is lost. Blank rows and repetitions must go, and a
truncated row that stays costs 5 more.

Audits are compared without being written out: among nodes that have read the same rows no audit
is the beginning of another (each ends with an edit of the last row), so their order follows from
the order of the nodes before and the edits made since. That also lets a conversation be parsed in
parts: a part of at most ``PART_ROWS`` rows or ``PART_BYTES`` bytes of text is summed up by the
cost and order of its exits from every possible stack, a fold over the parts of a conversation
picks the stack at each of their borders, and each part is then traced on its own. Rows are dealt
to tasks by sampled ranges of (conversation, turn, ...), so a conversation of any length spreads
over tasks, and only conversations that touch a border need more than the task they are in.

Rules for odd rows. A null role or text counts as one space, a null turn comes first and has no
part in gaps, a null id is a conversation of its own. Equal turns are ordered by role, then the
first 100 characters of the text, then its hash; rows equal in all of that are interchangeable.
Roles keep their text unless they are changed; a role's initial is its first character, and none
for an empty role. Repeated rows are duplicates. Conversations without rows have an empty audit. An
empty table gives an empty result; columns other than the four are not read. A single text is held
in memory whole, so very long texts cost as much memory as they are long.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskflow.llm.common import stored

PART_ROWS, PART_BYTES = 4096, 4 << 20
#: Left and right sides of the role grammar; lower-case letters are role initials.
RULES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
RENAMED = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL_PAIRS = ("su", "ua", "au")
#: Codes of rows: an initial (x for any other), upper case if truncated; a dash must be deleted.
MUST_GO = "-"
_BLANK = " \t\n\v\f\r"
_END = "$"


# -- the parser ----------------------------------------------------------------------------------


class Automaton:
    """LR states of a grammar, its finitely many stacks, and the stack graph's moves.

    ``moves[i][terminal]`` is the stack that stack ``i`` becomes by shifting a terminal, all
    reductions done; ``tops[i]`` is its top state. Only grammars whose stacks are bounded, as
    left-recursive ones for regular languages are, have such a table.
    """

    def __init__(self, rules: tuple[tuple[str, str], ...] = RULES) -> None:
        self.rules = [("", rules[0][0]), *rules]
        self.follow = self._follow()
        first = self._closure({(0, 0)})
        self.states, self.edges = [first], {}
        for number, items in enumerate(self.states):  # grows while it is read
            for symbol in sorted({self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}):
                after = self._closure({(r, d + 1) for r, d in items if self.rules[r][1][d : d + 1] == symbol})
                if after not in self.states:
                    self.states.append(after)
                self.edges[number, symbol] = self.states.index(after)
        self.stacks: list[tuple[int, ...]] = [(0,)]
        self.moves: list[dict[str, int]] = []
        terminals = sorted({x for _, right in self.rules for x in right if x.islower()})
        for stack in self.stacks:
            moves = {}
            for t in terminals:
                if (after := self._shift(stack, t)) is not None:
                    if after not in self.stacks:
                        self.stacks.append(after)
                    moves[t] = self.stacks.index(after)
            self.moves.append(moves)
            if len(self.stacks) > 1000:
                raise ValueError("the grammar's stacks are not bounded")
        self.tops = [s[-1] for s in self.stacks]
        self.accepted = [self._reduce(s, _END) == (0, self.edges[0, rules[0][0]]) for s in self.stacks]
        self.inserts = [self._inserts(i) for i in range(len(self.stacks))]

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        while True:
            wanted = {self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}
            more = items | {(k, 0) for k, (left, _) in enumerate(self.rules) if left in wanted}
            if more == items:
                return frozenset(items)
            items = more

    def _follow(self) -> dict[str, set[str]]:
        names = {left for left, _ in self.rules}
        empty: set[str] = set()
        first: dict[str, set[str]] = {n: set() for n in names}
        follow: dict[str, set[str]] = {n: set() for n in names} | {"": {_END}}
        while True:
            before = (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))
            for left, right in self.rules:
                if all(x in empty for x in right):
                    empty.add(left)
                for x in right:
                    first[left] |= first.get(x, {x})
                    if x not in empty:
                        break
                after = set(follow[left])
                for x in reversed(right):
                    if x in names:
                        follow[x] |= after
                        after = (after if x in empty else set()) | first[x]
                    else:
                        after = {x}
            if before == (len(empty), sum(map(len, first.values())), sum(map(len, follow.values()))):
                return follow

    def _reduce(self, stack: tuple[int, ...], ahead: str | None) -> tuple[int, ...]:
        """Reduce while the terminal ahead asks for it; without one, only where the state leaves
        no other choice."""
        while True:
            items = self.states[stack[-1]]
            whole = [r for r, d in items if r and d == len(self.rules[r][1])]
            if ahead is None:
                whole = whole if len(items) == 1 else []
            else:
                whole = [r for r in whole if ahead in self.follow[self.rules[r][0]]]
            if not whole:
                return stack
            left, right = self.rules[whole[0]]
            stack = stack[: len(stack) - len(right)]
            stack = (*stack, self.edges[stack[-1], left])

    def _shift(self, stack: tuple[int, ...], terminal: str) -> tuple[int, ...] | None:
        stack = self._reduce(stack, terminal)
        state = self.edges.get((stack[-1], terminal))
        return None if state is None else self._reduce((*stack, state), None)

    def _inserts(self, start: int) -> dict[int, tuple[int, str]]:
        """Stacks that inserted rows lead to, with their number and initials."""
        found, edge = {start: (0, "")}, [start]
        for i in edge:
            for t in RENAMED:
                if (j := self.moves[i].get(t)) is not None and j not in found:
                    found[j] = (found[i][0] + 1, found[i][1] + t)
                    edge.append(j)
        return found


class Step(NamedTuple):
    """What one row, and rows inserted before it, can do to a stack."""

    stack: int
    cost: int
    edits: str
    roles: str  # initials of the rows it leaves, inserted ones included


class Node(NamedTuple):
    """A stack that some edits of the rows so far lead to; ``rank`` orders the nodes by audit."""

    stack: int
    cost: int
    rank: int


@cache
def automaton() -> Automaton:
    return Automaton()


@cache
def steps(code: str, stack: int) -> list[Step]:
    """The cheapest steps of a row, one per top; equal costs go by the edits' letters."""
    lr, own = automaton(), code.lower()
    found = [Step(stack, DELETE, "D", "")]  # inserting first and deleting then is never smaller
    if code != MUST_GO:
        more = TRUNCATED if code.isupper() else 0
        for i, (count, inserted) in lr.inserts[stack].items():
            for initial, j in lr.moves[i].items():
                if initial == own:
                    found.append(Step(j, INSERT * count + more, "I" * count + "K", inserted + initial))
                elif initial in RENAMED:
                    found.append(Step(j, INSERT * count + REROLE + more, "I" * count + "R", inserted + initial))
    best: dict[int, Step] = {}
    for step in found:
        top = lr.tops[step.stack]
        if top not in best or step[1:3] < best[top][1:3]:
            best[top] = step
    return list(best.values())


class Parse:
    """The node graph over a part's rows, entered with one stack."""

    def __init__(self, codes: str, entry: int) -> None:
        tops = automaton().tops
        self.trail: list[dict[int, tuple[int, Step]]] = []  # per row and top: the top before, the step
        alive = {tops[entry]: Node(entry, 0, 0)}
        for code in codes:
            found: dict[int, tuple[tuple, int, Step]] = {}
            for top, node in alive.items():
                for step in steps(code, node.stack):
                    key = (node.cost + step.cost, node.rank, step.edits)
                    to = tops[step.stack]
                    if to not in found or key < found[to][0]:
                        found[to] = (key, top, step)
            order = sorted(found, key=lambda to: found[to][0][1:])
            alive = {to: Node(found[to][2].stack, found[to][0][0], rank) for rank, to in enumerate(order)}
            self.trail.append({to: (top, step) for to, (_, top, step) in found.items()})
        self.exits = list(alive.values())

    def trace(self, stack: int) -> list[Step]:
        """The steps, one per row, that lead to an exit."""
        top, out = automaton().tops[stack], []
        for row in reversed(self.trail):
            top, step = row[top]
            out.append(step)
        return out[::-1]


def ending(exits: list[Node]) -> tuple[Node, str]:
    """The exit of the whole conversation, and the initials of the rows inserted at its end."""
    lr = automaton()
    return min(
        ((node, inserted) for node in exits for j, (_, inserted) in lr.inserts[node.stack].items() if lr.accepted[j]),
        key=lambda x: (x[0].cost + INSERT * len(x[1]), x[0].rank, "I" * len(x[1])),
    )


def fold(parts: list[list[list[list[int]]]]) -> tuple[list[tuple[int, int]], str, int]:
    """Entry and exit stack of each part, the initials inserted at the end, and the cost.

    A part is given by its exits [stack, cost, rank] from each stack it may be entered with.
    """
    tops = automaton().tops
    alive, trail = [Node(0, 0, 0)], []
    for part in parts:
        found: dict[int, tuple[tuple[int, int, int], int, int]] = {}
        for node in alive:
            for stack, cost, rank in part[node.stack]:
                key = (node.cost + cost, node.rank, rank)
                if tops[stack] not in found or key < found[tops[stack]][0]:
                    found[tops[stack]] = (key, node.stack, stack)
        order = sorted(found.values(), key=lambda x: x[0][1:])
        alive = [Node(stack, key[0], rank) for rank, (key, _, stack) in enumerate(order)]
        trail.append({stack: entry for _, entry, stack in order})
    last, inserted = ending(alive)
    at, out = last.stack, []
    for part in reversed(trail):
        out.append((part[at], at))
        at = part[at]
    return out[::-1], inserted, last.cost + INSERT * len(inserted)


# -- parts of conversations ----------------------------------------------------------------------


def code_rows(roles: list[str], texts: list[str], seen: frozenset[int] = frozenset()) -> tuple[str, int, int, int]:
    """Codes of a part's rows and how many are blank, duplicate and truncated. ``seen`` are the
    places of rows that an earlier part has."""
    known: set[tuple[str, str]] = set()
    codes, blank, duplicate, truncated = [], 0, 0, 0
    for k, (role, text) in enumerate(zip(roles, texts, strict=True)):
        body = text.rstrip(_BLANK)
        code = role[0] if role[:1] in ("s", "u", "a") else "x"
        if not body:
            blank += 1
            code = MUST_GO
        elif k in seen or (role, text) in known:
            duplicate += 1
            code = MUST_GO
        elif body[-1] not in ".!?":
            truncated += 1
            code = code.upper()
        known.add((role, text))
        codes.append(code)
    return "".join(codes), blank, duplicate, truncated


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL_PAIRS for a, b in zip(roles, roles[1:], strict=False))


def _repaired(roles: list[str], texts: list[str], trace: list[Step], inserted: str) -> tuple[str, list[str], list[str]]:
    """Audit, roles and texts of a part after its edits."""
    audit, out_roles, out_texts = [], [], []
    for role, text, step in zip(roles, texts, trace, strict=True):
        audit.append(step.edits)
        kept = step.edits[-1] != "D"
        new = step.roles[: len(step.roles) - kept]
        out_roles += [RENAMED[i] for i in new]
        out_texts += [""] * len(new)
        if kept:
            out_roles.append(role if step.edits[-1] == "K" else RENAMED[step.roles[-1]])
            out_texts.append(text)
    audit.append("I" * len(inserted))
    return "".join(audit), [*out_roles, *(RENAMED[i] for i in inserted)], [*out_texts, *("" for _ in inserted)]


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(rows: DataFrame) -> DataFrame:
    """The test damage of conversation rows: by crc32("conv_id:turn") % 20 a row is dropped (0; it
    stays as a mark of its conversation), loses its text (1) or its ends of sentences (2), is
    repeated (3) or set to user (4)."""
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    kind = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"))
    return kind.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _parts(rows: DataFrame) -> DataFrame:
    """Rows in order, as parts: conv_id, part, whole (the conversation has no other part), roles,
    texts, turns (nulls left out)."""
    schema = T.StructType(
        [
            T.StructField("conv_id", rows.schema["conv_id"].dataType),
            T.StructField("part", T.LongType()),
            T.StructField("whole", T.BooleanType()),
            T.StructField("roles", T.ArrayType(T.StringType())),
            T.StructField("texts", T.ArrayType(T.StringType())),
            T.StructField("turns", T.ArrayType(T.LongType())),
        ]
    )
    order = ["conv_id", "turn", "role", F.substring("text", 1, 100), F.xxhash64("text")]
    # The last key parts rows that are alike in everything else.
    dealt = rows.repartitionByRange(*order, F.xxhash64(F.monotonically_increasing_id())).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        number = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        out_bytes = 0
        conv, open_, edge, size = None, False, True, 0
        roles, texts, turns = [], [], []

        def close(whole: bool) -> None:
            nonlocal number, roles, texts, turns, size, out_bytes
            out.append((conv, number, whole, roles, texts, turns))
            out_bytes += size
            number += 1
            roles, texts, turns, size = [], [], [], 0

        for batch in batches:
            for this, turn, role, text, dropped in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if open_ and this != conv:
                    close(not edge)
                    edge = False  # the first conversation of a task may have begun in another
                elif open_ and (len(roles) >= PART_ROWS or size >= PART_BYTES):
                    close(False)
                    edge = True
                conv, open_ = this, True
                if not dropped:
                    roles.append(role)
                    texts.append(text)
                    size += len(text)
                    if turn is not None:
                        turns.append(turn)
            if len(out) >= 4096 or out_bytes >= PART_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                out, out_bytes = [], 0
        if open_:
            close(False)  # the last one may go on in another
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """Parts of repaired conversations: conv_id, part, whole, audit, roles and texts after the
    repair, and of the whole conversation gaps, blank, duplicate, truncated, illegal and cost.

    ``rows`` has conv_id, turn, role and text; where an optional column ``dropped`` is true, a row
    only names its conversation. Parts follow one another in the order of ``part``.
    """
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    read = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        dropped.alias("dropped"),
    )
    parts = stored(_parts(read), "conversation-parts")
    conv = parts.schema["conv_id"]
    longs = lambda names: [T.StructField(n, T.LongType()) for n in names]
    strings = T.ArrayType(T.StringType())
    head = [conv, parts.schema["part"]]
    result = T.StructType([*head, T.StructField("audit", T.StringType()), T.StructField("roles", strings), T.StructField("texts", strings), *longs(_FIGURES)])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(result)
        for batch in batches:
            out = []
            for conv_id, part, roles, texts, turns in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                codes, *faults = code_rows(roles, texts)
                parse = Parse(codes, 0)
                last, inserted = ending(parse.exits)
                done = _repaired(roles, texts, parse.trace(last.stack), inserted)
                gaps = turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0
                out.append((conv_id, part, *done, gaps, *faults, _illegal(roles), last.cost + INSERT * len(inserted)))
            yield from _batch(out, arrow)

    whole = parts.where("whole").select("conv_id", "part", "roles", "texts", "turns").mapInArrow(alone, result)
    shared = _shared(parts.where("not whole").drop("whole"), result)
    return whole.withColumn("whole", F.lit(True)).unionByName(shared.withColumn("whole", F.lit(False)))


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


_EXITS = "array<array<array<long>>>"


def _shared(parts: DataFrame, result: T.StructType) -> DataFrame:
    """Repair conversations of several parts: rows that an earlier part has, summaries of the
    parts, the fold over them, and the trace of each part."""
    conv_key = F.concat(F.col("conv_id").isNull().cast("string"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    row_key = lambda r: F.sha2(F.concat(conv_key, F.lit("|"), F.length(r["roles"]).cast("string"), F.lit("|"), r["roles"], r["texts"]), 256)
    keyed = parts.withColumn("row_keys", F.transform(F.arrays_zip("roles", "texts"), row_key))
    # Once per part and row key, so that a common row counts a few thousandths.
    listed = keyed.select("part", F.explode(F.array_distinct("row_keys")).alias("row_key"))
    spread = listed.groupBy("row_key").agg(F.min("part").alias("first"), F.max("part").alias("last")).where("last > first")
    earlier = listed.join(spread, "row_key").where("part > first").groupBy("part").agg(F.collect_list("row_key").alias("earlier"))

    summary = T.StructType(
        [
            *result.fields[:2],
            T.StructField("codes", T.StringType()),
            T.StructField("exits", T.StringType()),
            *(T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal", "distinct", "first_turn", "last_turn")),
            T.StructField("ends", T.ArrayType(T.StringType())),
        ]
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, stacks = to_arrow_schema(summary), range(len(automaton().stacks))
        for batch in batches:
            out = []
            for conv_id, part, roles, texts, turns, keys, before in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                before = frozenset(before or ())
                codes, *faults = code_rows(roles, texts, frozenset(k for k, key in enumerate(keys) if key in before))
                exits = [[list(node) for node in Parse(codes, entry).exits] for entry in stacks]
                ends = [roles[0][:1], roles[-1][:1]] if roles else None
                bounds = (turns[0], turns[-1]) if turns else (None, None)
                out.append((conv_id, part, codes, repr(exits), *faults, _illegal(roles), len(set(turns)), *bounds, ends))
            yield from _batch(out, arrow)

    inputs = keyed.join(earlier, "part", "left").select("conv_id", "part", "roles", "texts", "turns", "row_keys", "earlier")
    sums = stored(inputs.mapInArrow(summed, summary), "part-summaries")

    planned = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("entry", T.IntegerType()),
            T.StructField("exit", T.IntegerType()),
            T.StructField("inserted", T.StringType()),
            *(T.StructField(n, T.LongType()) for n in _FIGURES),
        ]
    )

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations come as the list of their parts' summaries, about 0.1 KB for some
        thousand rows each."""
        arrow = to_arrow_schema(planned)
        for batch in batches:
            out = []
            for group in batch.column(0).to_pylist():
                borders, inserted, cost = fold([json.loads(p["exits"]) for p in group])
                figures = {n: sum(p[n] for p in group) for n in ("blank", "duplicate", "truncated", "illegal", "distinct")}
                ends = [p["ends"] for p in group if p["ends"]]
                figures["illegal"] += sum(a[1] + b[0] not in LEGAL_PAIRS for a, b in zip(ends, ends[1:], strict=False))
                turned = [p for p in group if p["first_turn"] is not None]
                joined = sum(a["last_turn"] == b["first_turn"] for a, b in zip(turned, turned[1:], strict=False))
                gaps = turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - (figures["distinct"] - joined) if turned else 0
                for k, (p, (entry, leave)) in enumerate(zip(group, borders, strict=True)):
                    final = inserted if k == len(group) - 1 else ""
                    out.append((p["part"], entry, leave, final, gaps, *(figures[n] for n in _FIGURES[1:5]), cost))
            yield from _batch(out, arrow)

    fields = [f.name for f in summary.fields[1:] if f.name != "codes"]
    grouped = sums.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("parts")).select("parts")
    plan = grouped.mapInArrow(folded, planned)
    chosen = sums.select("part", "codes").join(plan, "part")
    inputs = parts.select("conv_id", "part", "roles", "texts").join(chosen, "part")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(result)
        for batch in batches:
            out = []
            for conv_id, part, roles, texts, codes, entry, leave, inserted, *figures in zip(*(batch.column(k).to_pylist() for k in range(8 + len(_FIGURES))), strict=True):
                out.append((conv_id, part, *_repaired(roles, texts, Parse(codes, entry).trace(leave), inserted), *figures))
            yield from _batch(out, arrow)

    return inputs.select("conv_id", "part", "roles", "texts", "codes", "entry", "exit", "inserted", *_FIGURES).mapInArrow(traced, result)


def turns(parts: DataFrame) -> DataFrame:
    """The rows of ``repair``'s conversations: conv_id, part, position in it, role, text."""
    rows = parts.select("conv_id", "part", F.posexplode(F.arrays_zip("roles", "texts")).alias("position", "row"))
    return rows.select("conv_id", "part", "position", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def report(parts: DataFrame) -> DataFrame:
    """Per conversation: its figures, the whole audit and the hash of its lines ``role:text``.

    Conversations of one part are hashed where they are. The others come part by part, in order,
    to one task each, which reads them as a stream: SHA-256 has no other order to work in, and
    only the audit, one letter per row, is held.
    """
    lines = F.array_join(F.transform(F.arrays_zip("roles", "texts"), lambda r: F.concat(r["roles"], F.lit(":"), r["texts"])), "\n")
    lined = parts.select("conv_id", "part", "whole", "audit", F.size("roles").alias("n_lines"), lines.alias("lines"), *_FIGURES)
    ready = lined.where("whole").select("conv_id", *_FIGURES, "audit", F.sha2("lines", 256).alias("repaired_sha256"))

    schema = ready.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        conv, open_, figures, audit, digest, begun = None, False, (), [], hashlib.sha256(), False
        for batch in batches:
            out = []
            for this, piece, n_lines, text, *numbers in zip(*(batch.column(k).to_pylist() for k in range(4 + len(_FIGURES))), strict=True):
                if open_ and this != conv:
                    out.append((conv, *figures, "".join(audit), digest.hexdigest()))
                    audit, digest, begun = [], hashlib.sha256(), False
                conv, open_, figures = this, True, numbers
                audit.append(piece)
                if n_lines:
                    digest.update((b"\n" if begun else b"") + text.encode())
                    begun = True
            yield from _batch(out, arrow)
        if open_:
            yield from _batch([(conv, *figures, "".join(audit), digest.hexdigest())], arrow)

    shared = lined.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    hashed = shared.select("conv_id", "audit", "n_lines", "lines", *_FIGURES).mapInArrow(run, schema)
    return ready.unionByName(hashed)
