"""Repair of the structure of conversations by the cheapest edits.

Roles should read as an optional system turn and then pairs of user and assistant: ``(s?(ua)+)?`` over the
initials of roles. Four states tell how much of that has been read: nothing, the system turn, a user's turn,
a whole pair. Turns are kept, given the other role, or deleted, and empty turns are inserted.

A conversation is a stream: rows are repartitioned by conversation and sorted by turn, and ``mapInPandas``
carries the state of a dynamic programme from one Arrow batch to the next. For each of the four states it
holds the cost of the cheapest edits that lead there, their order among the four by the letters of the edits,
and the running SHA-256 of what they leave. Costs that can't win any more are dropped, so that costs and order
take few different values; a step is looked up by them and by the row's kind, and what it leaves behind is one
number of two bytes per row, from which the edits are read backwards at the end. A giant conversation's numbers
do not stay in the task: a full block of them is a row of the result, and blocks are walked in a second stream,
last block first. A task thus holds one block whatever a conversation's length, apart from the letters of the
edits themselves, which are one value of the result.

The digest of a conversation is one sequential sum over its turns, so its rows meet in one task by contract.
Which rows repeat an earlier one is found by sorting, not by remembering.
"""

from __future__ import annotations

import hashlib
from array import array
from ast import literal_eval
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthspan.llm.shared import saved

# Costs of edits, and one more for a truncated turn that stays.
CHANGE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Rows whose backpointers a task holds; beyond that they are written out.
BLOCK = 1 << 18

# White space, and marks that end a sentence.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
ENDS = [".", "!", "?"]

_INITIALS = "sua"
_FINE, _CUT, _GONE = 0, 1, 2
_KINDS = 3
_NOTHING, _SYSTEM, _USER, _PAIR = range(4)
_STATES = range(4)
# What a turn with the initial makes of a state, and the role that a changed or inserted turn has there.
_KEEP = ({0: _SYSTEM, 1: _USER}, {1: _USER}, {2: _PAIR}, {1: _USER})
_ROLE = (b"user", b"user", b"assistant", b"user")
_NEXT = (_USER, _USER, _PAIR, _USER)
# Inserted turns that complete a conversation.
_MISSING = (0, 2, 1, 0)
# (state, other, cost): whatever may follow the state, the other state can do as well for that much more.
_WORSE = (
    (_USER, _PAIR, INSERT),
    (_PAIR, _USER, INSERT),
    (_SYSTEM, _PAIR, 0),
    (_SYSTEM, _USER, INSERT),
    (_NOTHING, _PAIR, DELETE),
    (_NOTHING, _USER, DELETE + INSERT),
)

_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_STREAMED = (
    "conv string, part int, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string, state int, back binary"
)


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per conversation: conv_id, gaps (turns missing between the first and the last), blank,
    duplicate, truncated (rows by their first fault), illegal (neighbours whose initials are not su, ua or au),
    cost, audit and repaired_sha256.

    audit is the string of the cheapest edits in order, the ASCII-least one among equals: K(eep), R(erole),
    D(elete), I(nsert). Blank rows and those whose role and text came earlier must be deleted. The digest is that of
    the remaining turns as ``role:text`` lines; that of an empty text if none remain.

    Rows are in the order of turns, null first, then of roles and texts; equal rows are told apart as first and
    duplicate. A null role or text is one space; rows without a conv_id are one conversation. An empty table gives
    no rows; other columns are ignored; turns are integers. Texts of any length are held one batch at a time.
    """
    named = _named(rows, conv_col, turn_col, role_col, text_col)
    id_type = named.schema["conv"].dataType
    streamed = _sorted(named).mapInPandas(lambda batches: _stream(batches, block), _STREAMED)
    streamed = saved(streamed, "conversations")
    giant = streamed.filter("back is not null").repartition("conv").sortWithinPartitions("conv", F.desc("part"))
    whole = streamed.filter("back is null").union(giant.mapInPandas(_walk, _STREAMED))
    return whole.select(F.col("conv").cast(id_type).alias("conv_id"), *_COUNTS, "audit", "repaired_sha256")


def repaired(
    rows: DataFrame,
    repairs: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The repaired conversations themselves: conv_id, turn (from 0), role, text. ``repairs`` is what ``repair``
    gave for the rows. Each conversation's edits come first in its stream, so no row carries them along."""
    named = _named(rows, conv_col, turn_col, role_col, text_col)
    id_type = named.schema["conv"].dataType
    edits = repairs.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
    )
    turns = named.select(F.col("conv").cast("string"), F.lit(1).alias("kind"), "turn", "role", "text")
    stream = edits.unionByName(turns).repartition("conv").sortWithinPartitions(
        F.asc_nulls_first("conv"), "kind", F.asc_nulls_first("turn"), "role", "text"
    )
    written = stream.select("conv", "kind", "role", "text").mapInPandas(
        _edit, "conv string, turn long, role string, text string"
    )
    return written.withColumn("conv", F.col("conv").cast(id_type)).withColumnRenamed("conv", "conv_id")


def _named(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"),
    )


def _sorted(named: DataFrame) -> DataFrame:
    """Rows by conversation, in order, with kind and fault. One shuffle; the two sorts need none of their own."""
    dealt = named.select(F.col("conv").cast("string"), "turn", "role", "text").repartition("conv")
    same = Window.partitionBy("conv", "role", "text").orderBy(F.asc_nulls_first("turn"))
    counted = dealt.withColumn("copy", F.row_number().over(same))
    content = F.rtrim("text", F.lit(SPACE))
    fault = (
        F.when(content == "", "blank")
        .when(F.col("copy") > 1, "duplicate")
        .when(~F.right(content, F.lit(1)).isin(ENDS), "truncated")
        .otherwise("")
    )
    place = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text", "copy"]
    ordered = counted.withColumn("fault", fault).sortWithinPartitions(*place)
    return ordered.select(
        "conv", F.col("turn").cast("string").alias("turn"), "role", "text", "fault", _initial().alias("initial")
    )


def _initial() -> Column:
    """The place of the role's initial among those that count, else the number of these."""
    first = F.left("role", F.lit(1))
    number = F.lit(len(_INITIALS))
    for i, letter in enumerate(_INITIALS):
        number = F.when(first == letter, i).otherwise(number)
    return number


class Steps:
    """The dynamic programme's steps, each worked out on first use.

    A position is a tuple with cost above the least and rank for each state, None for a state that can't win.
    """

    def __init__(self) -> None:
        self.first = ((0, 0), None, None, None)
        self.known: dict[tuple, tuple] = {}
        self.tails: list[tuple] = []  # by number: for each state the state before and the letters
        self.numbers: dict[tuple, int] = {}

    def step(self, position: tuple, initial: int, fault: int) -> tuple:
        """The position after a row, the cost that all its states share, the number of its backpointers, and for
        each state what is written: (state before, bytes, how the row is kept)."""
        key = (position, initial * _KINDS + fault)
        if key not in self.known:
            self.known[key] = self._worked_out(position, initial, fault)
        return self.known[key]

    def _worked_out(self, position: tuple, initial: int, fault: int) -> tuple:
        best: list = [None] * 4
        for before in _STATES:
            if position[before] is None:
                continue
            cost, rank = position[before]
            state, letters, inserted = before, "", []
            for _ in range(3):  # more than two inserted turns come back to a state before them
                for letter, after, price, kept in _edits(state, initial, fault):
                    option = (cost + price, rank, letters + letter, before, tuple(inserted), kept)
                    if best[after] is None or option[:3] < best[after][:3]:
                        best[after] = option
                inserted.append(_ROLE[state])
                state, letters, cost = _NEXT[state], letters + "I", cost + INSERT
        for state, other, more in _WORSE:
            if best[state] and best[other] and best[state][0] > best[other][0] + more:
                best[state] = None
        live = [state for state in _STATES if best[state]]
        # Strings of different rows before never begin alike, as each ends in its row's own edit.
        order = sorted(live, key=lambda state: best[state][1:3])
        least = min(best[state][0] for state in live)
        after = tuple(
            (best[state][0] - least, order.index(state)) if best[state] else None for state in _STATES
        )
        tails = tuple((best[state][3], best[state][2]) if best[state] else None for state in _STATES)
        if tails not in self.numbers:
            self.numbers[tails] = len(self.tails)
            self.tails.append(tails)
        written = tuple(
            (state, best[state][3], *_written(best[state][3], best[state][4], best[state][5])) for state in live
        )
        return after, least, self.numbers[tails], written

    def end(self, position: tuple) -> tuple[int, int, int]:
        """The state in which the best edits end, their cost above the shared one, turns to insert."""
        cost, _, state = min(
            (entry[0] + INSERT * _MISSING[state], entry[1], state)
            for state, entry in enumerate(position)
            if entry
        )
        return state, cost, _MISSING[state]


def _edits(state: int, initial: int, fault: int) -> Iterator[tuple]:
    yield "D", state, DELETE, None
    if fault != _GONE:
        more = TRUNCATED if fault == _CUT else 0
        if initial in _KEEP[state]:
            yield "K", _KEEP[state][initial], more, b""
        yield "R", _NEXT[state], CHANGE + more, _ROLE[state]


def _written(before: int, inserted: tuple, kept: bytes | None) -> tuple[bytes, bytes | None]:
    """What goes before the row's own role and text, and its new role (empty: its own, None: no row)."""
    lines = b"\n".join(role + b":" for role in inserted)
    if lines and before != _NOTHING:
        lines = b"\n" + lines
    if kept is not None and (lines or before != _NOTHING):
        lines += b"\n"
    return lines, kept


class _Conversation:
    """One conversation's stream, up to the row read last."""

    def __init__(self, conv: str | None, steps: Steps, block: int):
        self.conv, self.steps, self.block = conv, steps, block
        self.position, self.cost = steps.first, 0
        self.sums: list = [hashlib.sha256(), None, None, None]
        self.back, self.part = array("H"), 0
        self.faults = {"": 0, "blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before = 0, -1
        self.least = self.latest = None
        self.turns = 0

    def add(self, turn: str | None, role: str, text: str, fault: str, initial: int) -> None:
        if turn is not None and (self.latest is None or int(turn) != self.latest):
            self.latest = int(turn)
            self.least = self.latest if self.least is None else self.least
            self.turns += 1
        self.faults[fault] += 1
        if self.before >= 0:
            self.illegal += (self.before, initial) not in ((0, 1), (1, 2), (2, 1))
        self.before = initial
        kind = _GONE if fault in ("blank", "duplicate") else _CUT if fault else _FINE
        self.position, least, number, written = self.steps.step(self.position, initial, kind)
        self.cost += least
        self.back.append(number)
        sums, content, own = [None] * 4, text.encode(), role.encode()
        for state, before, lines, kept in written:
            total = self.sums[before].copy()
            if kept is not None:
                total.update(b"%b%b:%b" % (lines, kept or own, content))
            elif lines:
                total.update(lines)
            sums[state] = total
        self.sums = sums

    def full(self) -> list[tuple]:
        """A full block of backpointers as a row."""
        if len(self.back) < self.block:
            return []
        row = (self.conv, self.part, *[None] * 8, None, self._packed())
        self.back, self.part = array("H"), self.part + 1
        return [row]

    def _packed(self) -> bytes:
        """Backpointers with what they mean: the numbers of another task's steps may differ."""
        meaning = [self.steps.tails[number] for number in sorted(set(self.back))]
        small = {number: i for i, number in enumerate(sorted(set(self.back)))}
        table = repr(meaning).encode()
        return len(table).to_bytes(4, "little") + table + array("H", map(small.__getitem__, self.back)).tobytes()

    def end(self) -> tuple:
        state, cost, missing = self.steps.end(self.position)
        total, at = self.sums[state], state
        for _ in range(missing):
            total.update((b"" if at == _NOTHING else b"\n") + _ROLE[at] + b":")
            at = _NEXT[at]
        gaps = self.latest - self.least + 1 - self.turns if self.turns else 0
        counts = (gaps, *(self.faults[f] for f in _COUNTS[1:4]), self.illegal, self.cost + cost)
        audit, back = None, None
        if self.part:
            audit, back = "I" * missing, self._packed()
        else:
            audit = "".join(reversed(["I" * missing, *_backwards(self.back, self.steps.tails, state)[0]]))
        return (self.conv, self.part, *counts, audit, total.hexdigest(), state, back)


def _backwards(numbers, tails: list, state: int) -> tuple[list[str], int]:
    """Letters of the edits, last row first, and the state before the first row."""
    letters = []
    for number in reversed(numbers):
        state, letter = tails[number][state]
        letters.append(letter)
    return letters, state


def _stream(batches: Iterator[pd.DataFrame], block: int) -> Iterator[pd.DataFrame]:
    steps, current = Steps(), None
    for batch in batches:
        rows = []
        for conv, turn, role, text, fault, initial in zip(*(batch[c].tolist() for c in batch.columns)):
            if current is None or conv != current.conv:
                rows += [current.end()] if current else []
                current = _Conversation(conv, steps, block)
            current.add(turn, role, text, fault, initial)
            rows += current.full()
        yield _frame(rows)
    if current:
        yield _frame([current.end()])


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole rows of giant conversations from their blocks, last block first."""
    final, letters, state = None, [], 0
    for batch in batches:
        rows = []
        for row in batch.itertuples(index=False):
            if row.audit is not None:
                final, letters, state = row, [row.audit], int(row.state)
            width = int.from_bytes(row.back[:4], "little")
            tails = literal_eval(row.back[4 : 4 + width].decode())
            numbers = array("H")
            numbers.frombytes(row.back[4 + width :])
            found, state = _backwards(numbers, tails, state)
            letters.append("".join(reversed(found)))
            if row.part == 0:
                audit = "".join(reversed(letters))
                rows.append((*final[:2], *map(int, final[2:8]), audit, final.repaired_sha256, state, None))
        yield _frame(rows)


def _edit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns as the edits, which come before the rows they belong to, say."""
    for batch in _with_edits(batches):
        yield pd.DataFrame(batch, columns=["conv", "turn", "role", "text"])


def _with_edits(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    edits, at, turn, state, conv = "", 0, 0, _NOTHING, None
    for batch in batches:
        out = []
        for owner, kind, role, text in zip(*(batch[c].tolist() for c in batch.columns)):
            if kind == 0:
                edits, at, turn, state, conv = text, 0, 0, _NOTHING, owner
            else:
                edit = edits[at]
                at += 1
                if edit != "D":
                    role = role if edit == "K" else _ROLE[state].decode()
                    state = _KEEP[state][_INITIALS.index(role[0])]
                    out.append((conv, turn, role, text))
                    turn += 1
            while at < len(edits) and edits[at] == "I":
                out.append((conv, turn, _ROLE[state].decode(), ""))
                state, at, turn = _NEXT[state], at + 1, turn + 1
        yield out


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [column.split(" ")[0] for column in _STREAMED.split(", ")]
    return pd.DataFrame(rows, columns=names, dtype=object)
