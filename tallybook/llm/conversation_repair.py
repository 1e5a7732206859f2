"""Repair of the turn structure of conversations: a generalised LR parser over roles, with weighted edits.

Grammar. A conversation is empty, or user and assistant turns in pairs, with at most one system turn before them; a role
counts by its first letter. ``Automaton`` makes the LR(0) states of the grammar. The parser keeps a graph-structured
stack: every distinct stack is one node that shares its tail with others, and nodes with equal stacks are merged by the
minimum of (cost, audit). No lookahead is needed, as all reductions that are possible are followed.

Edits. A turn is kept (cost 0), given the role user or assistant (2) or deleted (3); turns of text ``user`` or
``assistant`` without text are inserted anywhere (2). Blank turns and those seen before in the conversation must be
deleted; a turn that does not end a sentence costs 1 more unless it is deleted. The audit is a letter per edit, in order:
D, I, K, R. Of repairs of equal cost the least audit wins. The cost follows from the audit and the turns, so of two audits of
equal cost that have read the same turns none is the beginning of the other, and merging early loses nothing.

Scale. Equal turns of a conversation (same number, role and text) are counted, not listed. Turns are sorted by ranges of
(conversation, number, role, text), so that a conversation of any size is spread over tasks. A task parses a conversation
that lies within it at once, in memory, up to ``SEGMENT_TURNS`` turns or ``SEGMENT_BYTES`` of text. A longer one, and the one
at either end of a task, is cut into segments: each is parsed from every stack that can stand before it, and the results
are chained, which is exact. Only the letters of the audit meet in one task then; the texts are repaired by segment, and
streamed, a segment at a time, where a digest of the whole is wanted, which cannot be had in parts.

Defined results: null roles and texts are one space, a blank text. Turns are ordered by number, nulls first, then by role
and text as bytes. A null conv_id is a conversation of its own. Rows with ``copies`` of 0 keep their conversation in the
result, without turns: it has zeros, an empty audit and no repaired turns. An empty table gives an empty result. Columns
beyond the named ones are ignored. Spans of turn numbers beyond a long count as the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import Batches, with_columns
from tallybook.operators.sinks import settle

# The grammar, what edits cost, and the roles that edits may give.
START = "conversation"
GRAMMAR = (
    (START, ()),
    (START, ("pairs",)),
    (START, ("s", "pairs")),
    ("pairs", ("pair",)),
    ("pairs", ("pairs", "pair")),
    ("pair", ("u", "a")),
)
REROLE, DELETE, INSERT, TRUNCATED_KEPT = 2, 3, 2, 1
GIVEN = {"u": "user", "a": "assistant"}
LEGAL_NEIGHBOURS = {"su", "ua", "au"}

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
SEGMENT_TURNS = 1000
SEGMENT_BYTES = 4 << 20
SALTS = 64
LONGEST = (1 << 63) - 1

Item = tuple[str, int]  # first letter of the role, fault
Best = dict[int, tuple[int, str]]  # by stack: cost and audit


class Automaton:
    """All stacks of the LR(0) automaton of a grammar, numbered; 0 is the empty stack.

    ``shift[stack][letter]`` lists the stacks after a letter and all reductions that follow from it. A left-recursive grammar
    without nesting, as this one, has few stacks.
    """

    def __init__(self, grammar=GRAMMAR, start: str = START):
        self.grammar, self.start = grammar, start
        self.named = {head for head, _ in grammar}
        self.states: list[frozenset] = []
        first = self._state(self._closed({(at, 0) for at, (head, _) in enumerate(grammar) if head == start}))
        stacks: list[tuple] = [(first, None)]
        numbers = {stacks[0]: 0}
        self.shift: list[dict[str, list[int]]] = []
        letters = sorted({name for _, body in grammar for name in body} - self.named)
        for stack in stacks:  # grows on the way
            moves: dict[str, list[int]] = {}
            for letter in letters:
                for reached in self._after(stack, letter):
                    if reached not in numbers:
                        numbers[reached] = len(stacks)
                        stacks.append(reached)
                    moves.setdefault(letter, []).append(numbers[reached])
            self.shift.append(moves)
        self.accepting = {number for stack, number in numbers.items() if self._complete(stack, first)}

    def _closed(self, items: set) -> frozenset:
        items, waiting = set(items), list(items)
        while waiting:
            rule, dot = waiting.pop()
            body = self.grammar[rule][1]
            if dot < len(body) and body[dot] in self.named:
                new = {(at, 0) for at, (head, _) in enumerate(self.grammar) if head == body[dot]} - items
                items |= new
                waiting.extend(new)
        return frozenset(items)

    def _state(self, items: frozenset) -> int:
        if items not in self.states:
            self.states.append(items)
        return self.states.index(items)

    def _goto(self, state: int, name: str) -> int | None:
        moved = {(r, d + 1) for r, d in self.states[state] if d < len(self.grammar[r][1]) and self.grammar[r][1][d] == name}
        return self._state(self._closed(moved)) if moved else None

    def _after(self, stack: tuple, letter: str) -> list[tuple]:
        """The stacks after a letter that can still read one or end the text."""
        state = self._goto(stack[0], letter)
        found = [] if state is None else [(state, stack)]
        for reached in found:
            for rule, dot in sorted(self.states[reached[0]]):
                head, body = self.grammar[rule]
                if dot == len(body) and head != self.start:
                    below = reached
                    for _ in body:
                        below = below[1]
                    to = self._goto(below[0], head)
                    if to is not None and (to, below) not in found:
                        found.append((to, below))
        return [stack for stack in found if self._lives(stack[0])]

    def _lives(self, state: int) -> bool:
        return any(
            dot < len(self.grammar[rule][1]) or self.grammar[rule][0] == self.start for rule, dot in self.states[state]
        )

    def _complete(self, stack: tuple, first: int) -> bool:
        for rule, dot in self.states[stack[0]]:
            head, body = self.grammar[rule]
            if head == self.start and dot == len(body):
                below = stack
                for _ in body:
                    below = below[1]
                if below == (first, None):
                    return True
        return False


AUTOMATON = Automaton()


def _insert(best: Best, table: Automaton) -> Best:
    """What insertions reach besides."""
    waiting = list(best)
    while waiting:
        stack = waiting.pop()
        cost, audit = best[stack]
        new = (cost + INSERT, audit + "I")
        for letter in GIVEN:
            for to in table.shift[stack].get(letter, ()):
                if to not in best or new < best[to]:
                    best[to] = new
                    waiting.append(to)
    return best


def parse(items: list[Item], best: Best, table: Automaton = AUTOMATON) -> Best:
    """The cheapest way to every stack after the items, from the stacks given; insertions may come before each item."""
    for letter, fault in items:
        now: Best = {}
        extra = TRUNCATED_KEPT if fault == TRUNCATED else 0
        for stack, (cost, audit) in _insert(best, table).items():
            moves = [(stack, (cost + DELETE, audit + "D"))]
            if fault not in (BLANK, DUPLICATE):
                reach = table.shift[stack]
                moves += [(to, (cost + extra, audit + "K")) for to in reach.get(letter, ())]
                moves += [(to, (cost + REROLE + extra, audit + "R")) for given in GIVEN for to in reach.get(given, ())]
            for to, way in moves:
                if to not in now or way < now[to]:
                    now[to] = way
        best = now
    return best


def finish(best: Best, table: Automaton = AUTOMATON) -> tuple[int, tuple[int, str]]:
    """The accepting stack with the cheapest way."""
    ends = _insert(dict(best), table)
    return min(((stack, way) for stack, way in ends.items() if stack in table.accepting), key=lambda end: (end[1], end[0]))


def replay(turns: list[tuple[str, str]], stack: int, audit: str, table: Automaton = AUTOMATON) -> list[tuple[str, str]]:
    """The turns after the edits of an audit that starts at a stack."""
    out, rest = [], iter(turns)
    for edit in audit:
        if edit == "D":
            next(rest)
            continue
        role, text = next(rest) if edit != "I" else ("", "")
        letter = role[:1] if edit == "K" else next(letter for letter in GIVEN if letter in table.shift[stack])
        out.append((role if edit == "K" else GIVEN[letter], text))
        stack = table.shift[stack][letter][0]
    return out


def fault_of(text: str) -> int:
    """Blank, truncated or sound; duplicates are found elsewhere."""
    text = text.rstrip("\t\n\x0b\x0c\r ")
    if not text:
        return BLANK
    return SOUND if text[-1] in ".!?" else TRUNCATED


@dataclass
class Run:
    """Counts over consecutive turns of a conversation, which can be joined."""

    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None
    numbers: int = 0

    def add(self, number: int | None, letter: str, fault: int) -> None:
        own = Run(1, fault == BLANK, fault == DUPLICATE, fault == TRUNCATED, 0, letter, letter, number, number, number is not None)
        self.join(own)

    def join(self, later: Run) -> None:
        if not later.turns:
            return
        if self.turns and self.last + later.first not in LEGAL_NEIGHBOURS:
            self.illegal += 1
        self.first = later.first if not self.turns else self.first
        self.last = later.last
        if later.low is not None:
            same = self.high == later.low
            self.numbers += int(later.numbers) - (1 if same else 0)
            self.low = later.low if self.low is None else self.low
            self.high = later.high
        for name in ("turns", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, int(getattr(self, name)) + int(getattr(later, name)))

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else min(self.high - self.low + 1 - self.numbers, LONGEST)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
MOVE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
RUN = pa.struct(
    [(name, pa.string() if name in ("first", "last") else pa.int64()) for name in Run.__dataclass_fields__]
)
PARSED = pa.schema(
    [("kind", pa.string()), ("conv_id", pa.int64()), ("task", pa.int64()), ("place", pa.int64())]
    + [(name, pa.int64()) for name in COUNTS]
    + [("audit", pa.string()), ("turns", pa.list_(TURN)), ("run", RUN), ("moves", pa.list_(MOVE))]
)
_RUN_DDL = ", ".join(f"{name}: {'string' if name in ('first', 'last') else 'bigint'}" for name in Run.__dataclass_fields__)
PARSED_DDL = (
    "kind string, conv_id long, task long, place long, "
    + ", ".join(f"{name} long" for name in COUNTS)
    + ", audit string, turns array<struct<role: string, text: string>>, "
    + f"run struct<{_RUN_DDL}>, moves array<struct<start: int, end: int, cost: bigint, audit: string>>"
)


def _row(**values) -> dict:
    return {name: values.get(name) for name in PARSED.names}


class Segment:
    """Consecutive turns of one conversation, held in memory."""

    def __init__(self, conv_id: int | None, opening: bool, most_turns: int = SEGMENT_TURNS):
        self.conv_id, self.opening, self.most_turns = conv_id, opening, most_turns
        self.run, self.items, self.turns, self.size = Run(), [], [], 0

    def add(self, number: int | None, role: str, text: str, fault: int) -> None:
        letter = role[:1]
        self.run.add(number, letter, fault)
        self.items.append((letter, fault))
        self.turns.append((role, text))
        self.size += len(role) + len(text)

    @property
    def full(self) -> bool:
        return len(self.items) >= self.most_turns or self.size >= SEGMENT_BYTES

    def whole(self) -> dict:
        _, (cost, audit) = finish(parse(self.items, {0: (0, "")}))
        run = self.run
        counts = dict(zip(COUNTS, (run.gaps, run.blank, run.duplicate, run.truncated, run.illegal, cost)))
        turns = [{"role": role, "text": text} for role, text in replay(self.turns, 0, audit)]
        return _row(kind="whole", conv_id=self.conv_id, audit=audit, turns=turns, **counts)

    def part(self, task: int, place: int) -> dict:
        moves = []
        for start in range(len(AUTOMATON.shift)):
            for end, (cost, audit) in parse(self.items, {start: (0, "")}).items():
                moves.append({"start": start, "end": end, "cost": cost, "audit": audit})
        turns = [{"role": role, "text": text} for role, text in self.turns]
        run = {name: getattr(self.run, name) for name in Run.__dataclass_fields__}
        run["numbers"] = int(self.run.numbers)
        return _row(kind="part", conv_id=self.conv_id, task=task, place=place, turns=turns, run=run, moves=moves)


def _parse_sorted(most_turns: int):
    """Conversations that lie within the task as wholes, the first and last of the task and long ones as parts."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        task, place, size = TaskContext.get().partitionId(), 0, 0
        segment: Segment | None = None
        out: list[dict] = []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "copies", "later")]
            for conv_id, number, role, text, copies, later in zip(*columns):
                if segment is None or conv_id != segment.conv_id:
                    if segment is not None:
                        out.append(segment.part(task, place) if segment.opening else segment.whole())
                        size, place = size + segment.size, place + 1
                    segment = Segment(conv_id, segment is None, most_turns)
                fault = fault_of(text)
                for copy in range(copies):
                    again = fault != BLANK and (later or copy > 0)
                    segment.add(number, role, text, DUPLICATE if again else fault)
                    if segment.full:
                        out.append(segment.part(task, place))
                        size, place = size + segment.size, place + 1
                        segment = Segment(conv_id, True, most_turns)
                    if size >= SEGMENT_BYTES or len(out) >= 500:
                        yield pa.RecordBatch.from_pylist(out, schema=PARSED)
                        out, size = [], 0
        if segment is not None:
            out.append(segment.part(task, place))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=PARSED)

    return run


CHAINED = pa.schema(
    [("conv_id", pa.int64()), ("task", pa.int64()), ("place", pa.int64()), ("start", pa.int32())]
    + [(name, pa.int64()) for name in COUNTS]
    + [("audit", pa.string())]
)
CHAINED_DDL = "conv_id long, task long, place long, start int, " + ", ".join(f"{n} long" for n in COUNTS) + ", audit string"


class Chain:
    """The segments of one conversation in order: the cheapest way through all, and its edits in each segment.

    Held by segment: its moves' starts and ends, a byte each; held by stack: the audit so far.
    """

    def __init__(self, conv_id: int | None):
        self.conv_id, self.run = conv_id, Run()
        self.best: Best = {0: (0, "")}
        self.places: list[tuple[int, int]] = []
        self.came: list[dict[int, tuple[int, int]]] = []

    def add(self, task: int, place: int, run: dict, moves: list[dict]) -> None:
        self.run.join(Run(**run))
        now: Best = {}
        came: dict[int, tuple[int, int]] = {}
        for move in moves:
            if move["start"] in self.best:
                cost, audit = self.best[move["start"]]
                way = (cost + move["cost"], audit + move["audit"])
                if move["end"] not in now or way < now[move["end"]]:
                    now[move["end"]], came[move["end"]] = way, (move["start"], len(move["audit"]))
        self.best = now
        self.places.append((task, place))
        self.came.append(came)

    def rows(self) -> Iterator[dict]:
        """A row for the conversation, and one per segment with the edits in it; insertions at the end go to the last."""
        _, (cost, audit) = finish(self.best)
        stack, last = min((s, way[1]) for s, way in self.best.items() if self._ends(s, way, cost, audit))
        run = self.run
        counts = dict(zip(COUNTS, (run.gaps, run.blank, run.duplicate, run.truncated, run.illegal, cost)))
        yield {"conv_id": self.conv_id, "audit": audit, "task": None, "place": None, "start": None, **counts}
        end, begin = len(audit), len(last)
        for (task, place), came in zip(reversed(self.places), reversed(self.came)):
            start, length = came[stack]
            begin -= length
            none = dict.fromkeys(COUNTS)
            yield {"conv_id": self.conv_id, "task": task, "place": place, "start": start, "audit": audit[begin:end], **none}
            end, stack = begin, start

    @staticmethod
    def _ends(stack: int, way: tuple[int, str], cost: int, audit: str) -> bool:
        return finish({stack: way})[1] == (cost, audit)


def _chain_sorted(batches: Batches) -> Iterator[pa.RecordBatch]:
    chain: Chain | None = None
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if chain is None or chain.conv_id != row["conv_id"]:
                out.extend(chain.rows() if chain is not None else ())
                chain = Chain(row["conv_id"])
            chain.add(row["task"], row["place"], row["run"], row["moves"])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=CHAINED)
    if chain is not None:
        yield pa.RecordBatch.from_pylist(list(chain.rows()), schema=CHAINED)


TURNS_DDL = "conv_id long, task long, place long, turns array<struct<role: string, text: string>>"
TURNS = pa.schema([("conv_id", pa.int64()), ("task", pa.int64()), ("place", pa.int64()), ("turns", pa.list_(TURN))])


def _replay_segments(batches: Batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            turns = replay([(turn["role"], turn["text"]) for turn in row["turns"]], row["start"], row["audit"])
            row = {**row, "turns": [{"role": role, "text": text} for role, text in turns]}
            yield pa.RecordBatch.from_pylist([{name: row[name] for name in TURNS.names}], schema=TURNS)


def _digest_sorted(batches: Batches) -> Iterator[pa.RecordBatch]:
    """One digest per conversation over its repaired turns, a segment at a time."""
    schema = pa.schema([("digest_of", pa.int64()), ("repaired_sha256", pa.string())])
    held = None  # conv_id, digest, whether there was a turn
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held is None or held[0] != row["conv_id"]:
                out += [{"digest_of": held[0], "repaired_sha256": held[1].hexdigest()}] if held else []
                held = [row["conv_id"], hashlib.sha256(), False]
            for turn in row["turns"]:
                held[1].update(f"{chr(10) if held[2] else ''}{turn['role']}:{turn['text']}".encode())
                held[2] = True
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if held:
        yield pa.RecordBatch.from_pylist([{"digest_of": held[0], "repaired_sha256": held[1].hexdigest()}], schema=schema)


def _counted(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies, later``: distinct turns, and whether an earlier number has the same ones."""
    rows = with_columns(conversations, conv_id="long", turn="long", role="string", text="string", copies="long")
    blank = F.lit(" ")
    rows = rows.withColumns({"role": F.coalesce("role", blank), "text": F.coalesce("text", blank)})
    copies = F.coalesce("copies", F.lit(1)) if "copies" in conversations.columns else F.lit(1)
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum(copies).alias("copies"))
    rows = rows.withColumns(
        {"digest": F.sha2("text", 256), "salt": F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int")}
    )
    rows = settle(rows, "turns")
    key = ("conv_id", "role", "digest")
    seen = rows.where("copies > 0").groupBy(*key, "salt")
    seen = seen.agg(F.min("turn").alias("low"), F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.count(F.lit(1)).alias("n"))
    seen = seen.groupBy(*key).agg(
        F.min("low").alias("low"),
        F.bool_or("unnumbered").alias("unnumbered"),
        F.sum("n").alias("n"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"),
    )
    bits = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda salt: F.getbit(F.col("salts"), salt) == 1)
    first = F.when(~F.col("unnumbered"), F.col("low"))
    several = seen.where("n > 1").select(*[F.col(name).alias(f"_{name}") for name in key], first.alias("_first"), F.explode(bits).alias("_salt"))
    same = F.lit(True)
    for name in (*key, "salt"):
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    joined = rows.join(several, same, "left")
    later = F.col("_salt").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_first"))
    return joined.select("conv_id", "turn", "role", "text", "copies", later.alias("later"))


@dataclass(frozen=True)
class Repairs:
    """``summary``: per conversation ``conv_id``, its counts, ``cost``, ``audit`` and ``repaired_sha256``, the digest of its
    repaired ``role:text`` lines. ``turns``: ``conv_id, task, place, turns``, the repaired turns of a conversation in one
    row or, where it is long, in several in the order of (task, place)."""

    summary: DataFrame
    turns: DataFrame


def repair(conversations: DataFrame, segment_turns: int = SEGMENT_TURNS) -> Repairs:
    """Repair ``conv_id, turn, role, text`` rows; ``copies`` of a row, where given, follow each other."""
    rows = _counted(conversations)
    # the beginning of a text splits equal numbers and roles, in the same order as the whole text
    ranges = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
    sorted_rows = ranges.sortWithinPartitions("conv_id", "turn", "role", "text")
    parsed = settle(sorted_rows.mapInArrow(_parse_sorted(segment_turns), PARSED_DDL), "parsed", "kind")
    whole = parsed.where("kind = 'whole'")
    parts = parsed.where("kind = 'part'")

    by_conversation = parts.select("conv_id", "task", "place", "run", "moves").repartition("conv_id")
    by_conversation = by_conversation.sortWithinPartitions("conv_id", "task", "place")
    chained = settle(by_conversation.mapInArrow(_chain_sorted, CHAINED_DDL), "chained")
    edits = chained.where("place is not null").select("task", "place", "start", "audit")
    segments = parts.select("conv_id", "task", "place", "turns").join(edits, ["task", "place"])
    segments = segments.select("conv_id", "task", "place", "turns", "start", "audit").mapInArrow(_replay_segments, TURNS_DDL)
    segments = settle(segments, "segments")
    streamed = segments.repartition("conv_id").sortWithinPartitions("conv_id", "task", "place")
    streamed = streamed.mapInArrow(_digest_sorted, "digest_of long, repaired_sha256 string")

    columns = ("conv_id", *COUNTS, "audit", "repaired_sha256")
    line = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"]))
    at_once = whole.withColumn("repaired_sha256", F.sha2(F.array_join(line, "\n"), 256))
    in_parts = chained.where("place is null").join(streamed, F.col("conv_id").eqNullSafe(F.col("digest_of")))
    summary = at_once.select(*columns).unionByName(in_parts.select(*columns))
    turns = whole.select("conv_id", "task", "place", "turns").unionByName(segments)
    return Repairs(summary, turns)


# How rows are damaged, by the remainder of crc32(conv_id:turn) modulo 20.
DAMAGES = 20
DROP, EMPTY, UNSTOP, REPEAT, TO_USER = range(5)


def _shown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` of rows damaged by a hash of their conversation and number."""
    rows = with_columns(conversations, conv_id="long", turn="long", role="string", text="string")
    rows = rows.withColumns({"role": _shown("role"), "text": _shown("text")})
    kind = F.pmod(F.crc32(F.concat(_shown("conv_id"), F.lit(":"), _shown("turn"))), F.lit(DAMAGES))
    text = F.when(kind == EMPTY, "").when(kind == UNSTOP, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == TO_USER, "user").otherwise(F.col("role"))
    copies = F.when(kind == DROP, 0).when(kind == REPEAT, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))
