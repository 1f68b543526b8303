"""Conversation repair against an exhaustive search, and on odd rows, borders and empty tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from riskflow.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, part int, audit string"
GRAMMAR = re.compile("(s?(ua)+)?")


def moves(state: str) -> dict[str, str]:
    return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state]


def cheapest(rows: list[tuple[str, str, str]]) -> tuple[int, str, list[str]]:
    """Cost, audit and lines of the best edits; rows are (role, text, fault). Whole audits are kept
    and compared as strings."""
    best = {"": (0, "", ())}

    def inserted(at: dict) -> dict:
        at = dict(at)
        for _ in range(4):
            for state, (cost, audit, lines) in list(at.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if (to := moves(state).get(initial)) is not None:
                        new = (cost + 5, audit + "I", (*lines, role + ":"))
                        if to not in at or new[:2] < at[to][:2]:
                            at[to] = new
        return at

    for role, text, fault in rows:
        after: dict = {}

        def offer(to: str, new: tuple, after: dict = after) -> None:
            if to not in after or new[:2] < after[to][:2]:
                after[to] = new

        for state, (cost, audit, lines) in inserted(best).items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            if (to := moves(state).get(role[:1])) is not None:
                offer(to, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for initial, name in (("u", "user"), ("a", "assistant")):
                if (to := moves(state).get(initial)) is not None:
                    offer(to, (cost + 1 + more, audit + "R", (*lines, f"{name}:{text}")))
        best = after
    ends = [v for s, v in inserted(best).items() if s in ("", "a")]
    cost, audit, lines = min(ends, key=lambda v: v[:2])
    return cost, audit, list(lines)


def expected(rows: list[tuple]) -> dict:
    """The report's rows by brute force, from undamaged (conv_id, turn, role, text)."""
    damaged: dict = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = damaged.setdefault(conv, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, mine in damaged.items():
        mine = sorted(mine, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faulty = set(), []
        for _, role, text in mine:
            body = re.sub("[ \t-\r]+$", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        at = [t for t, _, _ in mine if t is not None]
        count = lambda f: sum(x == f for _, _, x in faulty)  # noqa: E731, B023
        cost, audit, lines = cheapest(faulty)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest)
    return out


def got(df) -> dict:
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


def conversations(seed: int, count: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "so it", "", " \t", "Well. ", "Ünd?\n", None, "ok"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "ursula"]
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            plain = rng.random() < 0.7
            role = ("user", "assistant")[turn % 2] if plain else rng.choice(roles)
            text = f"Line {rng.randint(0, 99)}." if rng.random() < 0.7 else rng.choice(texts)
            rows.append((conv, None if rng.random() < 0.03 else turn + rng.randint(0, 1), role, text))
    return rows + [(None, 0, "user", "Who?"), (None, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_the_automaton_knows_the_grammar():
    lr = cr.automaton()
    for length in range(7):
        for word in map("".join, itertools.product("sua", repeat=length)):
            at: int | None = 0
            for letter in word:
                at = lr.moves[at].get(letter) if at is not None else None
            assert (at is not None and lr.accepted[at]) == bool(GRAMMAR.fullmatch(word))


def test_parse_is_the_cheapest_and_least():
    rng = random.Random(2)
    role = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for _ in range(1500):
        codes = "".join(rng.choice("suaxSUAX-uuaa") for _ in range(rng.randint(0, 9)))
        rows = [(role.get(c.lower(), ""), "t", "blank" if c == "-" else "truncated" if c.isupper() else "") for c in codes]
        parse = cr.Parse(codes, 0)
        last, inserted = cr.ending(parse.exits)
        audit = "".join(s.edits for s in parse.trace(last.stack)) + "I" * len(inserted)
        assert (last.cost + 5 * len(inserted), audit) == cheapest(rows)[:2]
        # The same in parts, through summaries.
        cut = sorted(rng.randint(0, len(codes)) for _ in range(2))
        parts = [codes[: cut[0]], codes[cut[0] : cut[1]], codes[cut[1] :]]
        sums = [[[list(n) for n in cr.Parse(p, i).exits] for i in range(len(cr.automaton().stacks))] for p in parts]
        borders, ends, cost = cr.fold(sums)
        steps = [s.edits for p, (entry, leave) in zip(parts, borders, strict=True) for s in cr.Parse(p, entry).trace(leave)]
        assert (cost, "".join(steps) + "I" * len(ends)) == cheapest(rows)[:2]


@pytest.mark.parametrize("partitions", [1, 7])
def test_report(spark, partitions):
    rows = conversations(4, 150, 9)
    damaged = cr.damage(frame(spark, rows).repartition(partitions))
    assert got(cr.report(cr.repair(damaged))) == expected(rows)


def test_a_conversation_over_many_parts(spark, monkeypatch):
    """One conversation holds most rows; parts are short, rows repeat across them."""
    rng = random.Random(8)
    long = [(7, t, rng.choice(["user", "assistant", "tool", "user"]), rng.choice(["Hm.", "Say", f"N{t}.", f"M{t}."])) for t in range(700)]
    rows = long + conversations(9, 6, 5)
    monkeypatch.setattr(cr, "PART_ROWS", 16)
    damaged = cr.damage(frame(spark, rows).repartition(3))
    parts = cr.repair(damaged)
    # Workers import the module anew, so short parts come from short partitions here.
    assert got(cr.report(parts)) == expected(rows)
    assert parts.where("not whole").count() > 3
    lines = [r for r in cr.turns(parts).orderBy("part", "position").collect() if r.conv_id == 7]
    digest = hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in lines).encode()).hexdigest()
    assert digest == expected(rows)[7][-1]


def test_odd_rows(spark):
    long = "wörd " * 400_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (2, None, None, None), (3, 5, "user", "Hi."), (3, 5, "user", "Hi.")]
    assert got(cr.report(cr.repair(cr.damage(frame(spark, rows))))) == expected(rows)
    plain = frame(spark, [(4, 0, "user", "Hi."), (4, 1, "assistant", "Yes.")])
    (row,) = cr.report(cr.repair(plain)).collect()
    assert (row.audit, row.cost, row.gaps) == ("KK", 0, 0)
    assert cr.report(cr.repair(cr.damage(frame(spark, [])))).count() == 0


def test_dropped_conversations_stay(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = cr.report(cr.repair(cr.damage(frame(spark, [(gone, 0, "user", "Hi.")])))).collect()
    assert (row.conv_id, row.audit, row.cost, row.repaired_sha256) == (gone, "", 0, hashlib.sha256(b"").hexdigest())
