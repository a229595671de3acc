"""Runs against all periods tried at all places."""

import hashlib
import random
import zlib

import pytest

from monthspan.llm import periodic_runs
from monthspan.llm.queries import op13_periodic_runs
from tests.llm.data import ODD_TEXTS, SF, empty, n_odd, odd, table


def plain(words):
    """(start, length, period) of all runs."""
    smallest = {}
    for period in range(1, len(words) // 3 + 1):
        i = 0
        while i + period < len(words):
            end = i
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - i + period
            if end > i and length >= max(24, 3 * period):
                smallest.setdefault((i, length), period)
            i = max(i + 1, end)
    return sorted(((*at, period) for at, period in smallest.items()), key=lambda run: (run[0], run[2]))


def plainly_collapsed(words, runs):
    kept = [
        word
        for i, word in enumerate(words)
        if not any(start + period <= i < start + length for start, length, period in runs)
    ]
    return b" ".join(kept).decode()


def repetitive(chance):
    alphabet, words = chance.choice([1, 2, 2, 3, 5, 50]), []
    wanted = chance.randint(0, 400)
    while len(words) < wanted:
        kind = chance.random()
        if kind < 0.4:
            words += [b"%d" % chance.randrange(alphabet) for _ in range(chance.randint(1, 30))]
        elif kind < 0.9:
            unit = [b"%d" % chance.randrange(alphabet) for _ in range(chance.choice([1, 2, 3, 5, 8, 9, 11, 12, 17, 24, 31, 60]))]
            if chance.random() < 0.5:  # with repeats inside the period
                unit = unit[: chance.randint(1, len(unit))] * chance.randint(2, 5) + unit
            words += (unit * 7)[: int(len(unit) * chance.uniform(1.5, 6))]
        else:
            words += words[-chance.randint(1, 100) :]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_many_texts_at_once(seed):
    chance = random.Random(seed)
    for _ in range(25):
        texts = [repetitive(chance) for _ in range(chance.randint(1, 6))]
        found = periodic_runs.runs_of(texts)
        for words, runs in zip(texts, found):
            assert runs == plain(words)
            assert periodic_runs.collapsed(words, runs) == plainly_collapsed(words, runs)


def test_words_of_many_repeats():
    fibonacci, longer = [b"a"], [b"a", b"b"]
    while len(longer) < 1500:
        fibonacci, longer = longer, longer + fibonacci
    morse = [b"%d" % (bin(i).count("1") % 2) for i in range(1500)]
    one = [b"x"] * 1000
    almost = [b"x"] * 500 + [b"y"] + [b"x"] * 499
    nested = ([b"a"] * 8 + [b"b"]) * 9 + [b"c"]
    for words in (longer, morse, one, almost, nested * 3, nested * 4):
        assert periodic_runs.runs_of([words]) == [plain(words)]


@pytest.mark.parametrize("period", [*range(1, 40), 47, 48, 63, 64, 65, 95, 96, 97, 191, 192, 193])
def test_every_period_at_its_least_length(period):
    chance = random.Random(period)
    unit = [b"%d" % chance.randrange(4) for _ in range(period - 1)] + [b"end"]
    least = max(24, 3 * period)
    for length in (least - 1, least, least + 1):
        words = [b"before"] + (unit * 30)[:length] + [b"after"]
        assert periodic_runs.runs_of([words]) == [plain(words)]


def test_short_texts_are_left_out_at_larger_scales():
    chance = random.Random(5)
    unit = [b"%d" % chance.randrange(1000) for _ in range(300)]
    texts = [[b"a", b"b"] * 20] * 50 + [[b"q"] * 7 + unit * 4] + [[b"c"] * 30] * 50
    assert periodic_runs.runs_of(texts) == [plain(words) for words in texts]


def test_the_whole_query(spark):
    rows = {r["doc_id"]: r for r in op13_periodic_runs(spark, SF).collect()}
    docs = table(spark, "documents").collect()
    assert len(rows) == len(docs)
    periodic = 0
    for doc in docs:
        words = (doc["text"] or "").encode().split()
        h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [word if i < a else words[a + (i - a) % p] for i, word in enumerate(words)]
        runs = plain(words)
        periodic += bool(runs)
        best = min(runs, key=lambda run: (-run[1] / run[2], run[0], run[2]), default=(None,) * 3)
        row = rows[doc["doc_id"]]
        assert (row["start"], row["length"], row["period"]) == best
        assert row["n_runs"] == len(runs)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(plainly_collapsed(words, runs).encode()).hexdigest()
    assert periodic > 5


def test_odd_tables(spark):
    rows = periodic_runs.find(odd(spark)).collect()
    assert len(rows) == n_odd()
    for row in rows:
        if row["doc_id"] is not None:
            words = (ODD_TEXTS[row["doc_id"]] or "").encode().split()
            assert row["n_words"] == len(words)
            if len(words) < 1000:
                assert [tuple(run) for run in row["runs"]] == plain(words)
            else:
                assert [tuple(run) for run in row["runs"]] == [(0, 30_000, 1)] and row["collapsed"] == "word"
    assert periodic_runs.find(empty(spark)).collect() == []
