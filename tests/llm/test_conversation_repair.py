from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybook.llm import conversation_repair as cr

ROWS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(items):
    """(cost, audit) by trying every edit from every state of the grammar, without any merging but of equal states."""
    moves = {"e": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    ways = {"e": {(0, "")}}

    def inserted(ways):
        for _ in range(3):
            ways = {state: set(found) for state, found in ways.items()}
            for state, found in list(ways.items()):
                for letter, to in moves[state].items():
                    if letter in "ua":
                        ways.setdefault(to, set()).update((c + 2, a + "I") for c, a in list(found) if a[-3:] != "III")
        return ways

    for letter, fault in items:
        now = {}
        for state, found in inserted(ways).items():
            for cost, audit in found:
                now.setdefault(state, set()).add((cost + 3, audit + "D"))
                if fault in (cr.BLANK, cr.DUPLICATE):
                    continue
                extra = 1 if fault == cr.TRUNCATED else 0
                for name, to in moves[state].items():
                    if name == letter:
                        now.setdefault(to, set()).add((cost + extra, audit + "K"))
                    if name in "ua":
                        now.setdefault(to, set()).add((cost + 2 + extra, audit + "R"))
        ways = {state: set(sorted(found)[:60]) for state, found in now.items()}
    ends = inserted(ways)
    return min(way for state in ("e", "a") for way in ends.get(state, ()))


ITEMS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.integers(0, 3)), max_size=7)


@settings(max_examples=200, deadline=None)
@given(ITEMS)
def test_parse_finds_the_cheapest_edits(items):
    assert cr.finish(cr.parse(items, {0: (0, "")}))[1] == cheapest(items)


@settings(max_examples=100, deadline=None)
@given(st.lists(ITEMS, min_size=1, max_size=5))
def test_segments_chain_to_the_same_edits(parts):
    chain = cr.Chain(1)
    for place, items in enumerate(parts):
        segment = cr.Segment(1, True)
        for at, (letter, fault) in enumerate(items):
            segment.add(place * 10 + at, letter, "", fault)
        row = segment.part(0, place)
        chain.add(0, place, row["run"], row["moves"])
    whole = [item for items in parts for item in items]
    summary, *edits = chain.rows()
    assert (summary["cost"], summary["audit"]) == cheapest(whole)
    assert "".join(row["audit"] for row in reversed(edits)) == summary["audit"]
    pieces = []
    for row in reversed(edits):
        turns = [(letter, str(at)) for at, (letter, _) in enumerate(parts[row["place"]])]
        pieces += cr.replay(turns, row["start"], row["audit"])
    letters = "".join(role[:1] for role, _ in pieces)
    assert letters == "" or letters.removeprefix("s").replace("ua", "") == "" and letters.endswith("ua")


def expected(rows):
    """The whole contract, row by row."""
    conversations = {}
    for conv_id, turn, role, text in rows:
        found = conversations.setdefault(conv_id, [])
        role, text = (" " if value is None else value for value in (role, text))
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        found += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv_id, found in conversations.items():
        found.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
        seen, items, faults = set(), [], []
        for _, role, text in found:
            bare = text.rstrip(BLANKS)
            fault = (
                cr.BLANK if not bare else cr.DUPLICATE if (role, text) in seen
                else cr.TRUNCATED if bare[-1] not in ".!?" else cr.SOUND
            )
            seen.add((role, text))
            faults.append(fault)
            items.append((role[:1], fault))
        cost, audit = cheapest(items)
        lines, rest, before = [], iter(found), ""
        for edit in audit:
            turn = next(rest) if edit != "I" else (None, "", "")
            if edit == "D":
                continue
            wanted = "assistant" if before == "u" else "user"
            lines.append(f"{turn[1] if edit == 'K' else wanted}:{turn[2]}")
            before = lines[-1][:1]
        turns = [turn for turn, _, _ in found if turn is not None]
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(items, items[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = (faults.count(cr.BLANK), faults.count(cr.DUPLICATE), faults.count(cr.TRUNCATED))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (gaps, *counts, illegal, cost, audit, digest)
    return out


@pytest.fixture
def mixed():
    chooser = random.Random(3)
    roles = ["system", "user", "assistant", "tool", "", None, "Üser"]
    texts = ["Yes.", "No", "  ", None, "", "Why?\n", "\x00", "w " * 5000, "é!"]
    rows = []
    for conv_id in [*range(60), None]:
        for _ in range(chooser.randint(0, 9)):
            turn = chooser.choice([None, *range(6)])
            rows.append((conv_id, turn, chooser.choice(roles), chooser.choice(texts)))
    return rows + rows[:40]


@pytest.mark.parametrize("segment_turns", [1, 3, 1000])
def test_repair_follows_the_contract(spark, mixed, segment_turns):
    table = spark.createDataFrame(mixed, ROWS).selectExpr("*", "'x' AS later", "1 AS place", "2 AS digest").repartition(5)
    found = {row.conv_id: tuple(row)[1:] for row in cr.repair(cr.damaged(table), segment_turns).summary.collect()}
    assert found == expected(mixed)


def test_one_long_conversation_over_many_tasks(spark):
    rows = [(7, at % 3000, "user" if at % 2 else "assistant", f"t{at % 1700}.") for at in range(6000)] + [(8, 0, "user", "x.")]
    repairs = cr.repair(cr.damaged(spark.createDataFrame(rows, ROWS).repartition(8)), 100)
    summary = {row.conv_id: row for row in repairs.summary.collect()}
    assert summary.keys() == {7, 8} and summary[8].audit == "KI"
    turns = [turn.role for row in sorted(repairs.turns.where("conv_id = 7").collect(), key=lambda r: (r.task, r.place)) for turn in row.turns]
    assert turns == ["user", "assistant"] * (len(turns) // 2) and turns
    audit = summary[7].audit
    assert len(turns) == len(audit) - audit.count("D")
    assert repairs.turns.where("conv_id = 7").count() > 10


def test_many_equal_turns(spark):
    rows = [(1, None, "user", "same."), *[(1, 2, "user", "same.")] * 3000, (1, 3, "assistant", "ok.")]
    undamaged = spark.createDataFrame(rows, ROWS).repartition(6)
    (row,) = cr.repair(undamaged).summary.collect()
    assert (row.duplicate, row.cost, row.audit) == (3000, 9000, "K" + "D" * 3000 + "K")


def test_empty_table_and_conversations_without_turns(spark):
    none = spark.createDataFrame([], ROWS)
    assert cr.repair(cr.damaged(none)).summary.count() == 0
    dropped = next(turn for turn in range(1000) if zlib.crc32(f"5:{turn}".encode()) % 20 == 0)
    (row,) = cr.repair(cr.damaged(spark.createDataFrame([(5, dropped, "user", "x.")], ROWS))).summary.collect()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
