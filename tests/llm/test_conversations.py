"""Cheapest repairs against a search over all edits, and the stream against itself in small blocks."""

import hashlib
import random
import zlib
from heapq import heappop, heappush

import pytest
from pyspark.sql import functions as F

from monthspan.llm import conversations
from monthspan.llm.queries import damaged, op12_conversations
from tests.llm.data import table

AFTER = {"": "su", "s": "u", "u": "a", "ua": "u"}
SCHEMA = "conv_id long, turn long, role string, text string"


def follow(state, initial):
    return {"s": "s", "u": "u", "a": "ua"}[initial]


def cheapest(rows):
    """(cost, audit) of (initial, must go, truncated) rows: the first end that a search by cost, then letters
    reaches. Letters are compared as whole strings, so no order is assumed."""
    best, heap = {}, [(0, "", 0, "")]
    while heap:
        cost, audit, i, state = heappop(heap)
        if i == len(rows) and state in ("", "ua"):
            return cost, audit
        if (i, state) in best:
            continue
        best[i, state] = cost
        role = AFTER[state][-1]
        heappush(heap, (cost + 2, audit + "I", i, follow(state, role)))
        if i < len(rows):
            initial, gone, cut = rows[i]
            heappush(heap, (cost + 3, audit + "D", i + 1, state))
            if not gone:
                heappush(heap, (cost + 2 + cut, audit + "R", i + 1, follow(state, role)))
                if initial in AFTER[state]:
                    heappush(heap, (cost + cut, audit + "K", i + 1, follow(state, initial)))


def exhaustive(rows, most=3):
    """As ``cheapest``, from all strings of edits with few turns inserted in a row."""
    found = []

    def go(i, state, cost, audit, inserted):
        if i == len(rows) and state in ("", "ua"):
            found.append((cost, audit))
        role = AFTER[state][-1]
        if inserted < most:
            go(i, follow(state, role), cost + 2, audit + "I", inserted + 1)
        if i < len(rows):
            initial, gone, cut = rows[i]
            go(i + 1, state, cost + 3, audit + "D", 0)
            if not gone:
                go(i + 1, follow(state, role), cost + 2 + cut, audit + "R", 0)
                if initial in AFTER[state]:
                    go(i + 1, follow(state, initial), cost + cut, audit + "K", 0)

    go(0, "", 0, "", 0)
    return min(found)


def plain(rows):
    """A conversation's row of the result, from (turn, role, text) rows."""
    space = " \t\n\x0b\x0c\r"
    rows = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        content = text.rstrip(space)
        blank, again = not content, (role, text) in seen
        faults.append("blank" if blank else "duplicate" if again else "truncated" if content[-1] not in ".!?" else "")
        seen.add((role, text))
    kinds = [(r[1][:1] or "-", f in ("blank", "duplicate"), int(f == "truncated")) for r, f in zip(rows, faults)]
    cost, audit = cheapest(kinds)
    lines, state, i = [], "", 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[i][1:]
        i += letter != "I"
        if letter != "D":
            role = role if letter == "K" else {"u": "user", "a": "assistant"}[AFTER[state][-1]]
            state = follow(state, role[0])
            lines.append((role, text))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in lines).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest), lines


def random_rows(n, seed):
    chance = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "cut", "", " \t", "What?", "　", "a.\n", None, "b. c"]
    rows = []
    for conv in [*range(n), None]:
        for turn in range(chance.randint(1, 9)):
            rows.append((conv, chance.choice([turn, turn, turn, turn + 3, None]), chance.choice(roles), chance.choice(texts)))
    rows += chance.sample(rows, n // 4)
    chance.shuffle(rows)
    return rows


def test_the_search_finds_what_all_strings_of_edits_hold():
    chance = random.Random(3)
    for _ in range(150):
        rows = [(chance.choice("suax"), chance.random() < 0.2, chance.randint(0, 1)) for _ in range(chance.randint(0, 3))]
        assert cheapest(rows) == exhaustive(rows)


@pytest.mark.parametrize("block", [2, 3, conversations.BLOCK])
def test_repairs(spark, block):
    rows = random_rows(150, block)
    expected = {}
    for conv, *row in rows:
        expected.setdefault(conv, []).append(tuple(row))
    table = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit(0)).withColumn("conv", F.lit("x"))
    repairs = conversations.repair(table, block=block)
    found = {r["conv_id"]: tuple(r)[1:] for r in repairs.collect()}
    assert len(found) == len(expected) == repairs.count()
    turns = {}
    for r in conversations.repaired(table, repairs).orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv, own in expected.items():
        result, lines = plain(own)
        assert found[conv] == result, own
        assert turns.get(conv, []) == lines


def test_a_long_conversation_in_batches_and_blocks(spark):
    rows = [(1, t, ("user", "tool", "assistant")[t % 3], f"{t % 977}." if t % 5 else "x") for t in range(6000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        frame = spark.createDataFrame(rows, SCHEMA)
        (found,) = conversations.repair(frame, block=64).collect()
        (whole,) = conversations.repair(frame).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert tuple(found) == tuple(whole) and tuple(found)[1:] == plain([r[1:] for r in rows])[0]


def test_rows_are_shuffled_once(spark):
    rows = table(spark, "conversations")
    named = conversations._named(rows, "conv_id", "turn", "role", "text")
    plan = conversations._sorted(named)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_damage_and_the_whole_query(spark):
    rows = [tuple(r) for r in table(spark, "conversations").collect()]
    left = {}
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        own = left.setdefault(conv, [])
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        own += [] if fault == 0 else [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    found = {r["conv_id"]: tuple(r)[1:] for r in op12_conversations(spark, "/root/testdata/sf0.001").collect()}
    assert found == {conv: plain(own)[0] for conv, own in left.items()}


def test_conversations_without_rows_or_names(spark):
    nulls = spark.createDataFrame([(None, None, None, None), (None, None, None, None)], SCHEMA)
    (row,) = conversations.repair(nulls).collect()
    assert tuple(row) == (None, 0, 2, 0, 0, 1, 6, "DD", hashlib.sha256(b"").hexdigest())
    assert damaged(nulls).count() in (0, 2, 4)
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(empty).collect() == []
    assert conversations.repaired(empty, conversations.repair(empty)).collect() == []


def test_very_long_text(spark):
    rows = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", "x")]
    (row,) = conversations.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    assert tuple(row)[1:] == plain([r[1:] for r in rows])[0]
