"""Personal data: base spans against plain patterns, added spans, redaction."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from monthspan.llm import pii
from tests.llm.data import docs, empty, n_odd, odd, table

# The contract's base patterns as they are given.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += sum(divmod(digit * 2, 10)) if place % 2 else digit
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    """(start, kind, end) of the base spans, in order."""
    return sorted(
        (m.start(), number, m.end())
        for number, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    )


def told(spans):
    return ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def check(texts, rows):
    for row in rows:
        wanted = base(texts[row["doc_id"]])
        assert row["base_sha256"] == hashlib.sha256(told(wanted).encode()).hexdigest()
        counts = [sum(kind == number for _, kind, _ in wanted) for number in range(4)]
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == counts
        spans = row["spans"].split(",") if row["spans"] else []
        assert set(told(wanted).split(",")) - {""} <= set(spans)


@pytest.fixture(scope="module")
def model(spark):
    """Trees taught on a made-up mixture, in which every kind of number is told by its context."""
    rng = random.Random(3)

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        while not luhn(number := digits(16)):
            pass
        return number

    texts = []
    for i in range(900):
        texts.append(
            f"Call me: tel +1 ({digits(3)}) {digits(3)}-{digits(4)} or mail ab{i}@mail.example.com today. "
            f"The order {digits(9)} and version {digits(3)}.{digits(3)}.{digits(3)}.999 of token {digits(14)}. "
            f"Card {card()} on host 10.{i % 200}.7.{i % 250} is known."
        )
    found = pii.learn(docs(spark, texts))
    assert found.trees and None not in found.thresholds
    return found


def test_documents(spark, model):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    check(texts, pii.find(table(spark, "documents"), model).collect())
    check(texts, pii.find(table(spark, "documents"), pii.Model()).collect())


def test_random_texts(spark, model):
    rng = random.Random(1)
    parts = ["a@b.com", "é", "+1 555", "4111 1111 1111 1111", "1.2.3.4", "@", ".", " ", "-", "0", "99", "(", "x", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(1500)]
    texts += ["a@b.co_c@d.org", "1.2.3.4.5.6.7.8", "999.1.1.1 0001.2.3.004", "+1 (234) 567-8901 4111111111111111"]
    texts += ["a@b.c@d.e", "😀1.1.1.1", "4111-1111-1111-1111 1", "1" * 500, "a" * 3000 + "@", "+1" + " " * 50 + "2"]
    check(dict(enumerate(texts)), pii.find(docs(spark, texts), model).collect())


def test_long_matches_end(spark):
    texts = ["a." * 50_000 + "@" + "b.c" * 50_000, "1 " * 50_000, "1." * 50_000, "+1" + "()" * 50_000]
    check(dict(enumerate(texts)), pii.find(docs(spark, texts), pii.Model()).collect())


def test_overlapping_spans_are_redacted_together(spark):
    texts = ["x 1.2.3.4 y a@b.com, +1 (234) 567-8901.", None, "clean", "+12 4111 1111 1111 1", "é4111111111111111é"]
    frame = docs(spark, texts).withColumn("_spans", F.lit(1))
    rows = {r["doc_id"]: r for r in pii.redact(frame, pii.Model()).collect()}
    assert rows[0]["text"] == "x [IP] y [EMAIL], [PHONE]."
    assert rows[0]["n_chars"] == len(rows[0]["text"])
    assert rows[1]["text"] is None and rows[2]["text"] == "clean" and rows[2]["n_chars"] == 5
    assert rows[4]["text"] == "é[CARD]é"
    assert pii.redact(frame, pii.Model()).columns == frame.columns


def test_redaction_equals_a_plain_version(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    for row in pii.redact(table(spark, "documents"), pii.Model()).collect():
        text, at, out = texts[row["doc_id"]], 0, ""
        for start, kind, end in base(text):
            if start >= at:
                out += text[at:start] + f"[{pii.KINDS[kind].upper()}]"
            at = max(at, end)
        assert row["text"] == out + text[at:]


def test_odd_tables(spark, model):
    rows = pii.find(odd(spark), model).collect()
    assert len(rows) == n_odd()
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (0, 1, 2, 8, 9))
    assert pii.find(empty(spark), model).collect() == []
    assert pii.redact(empty(spark), model).collect() == []
    assert pii.redact(odd(spark), model).count() == n_odd()
    assert pii.learn(empty(spark)) == pii.Model()
    assert pii.learn(odd(spark)) == pii.Model()


def planted(seed, n):
    """Texts with base spans, with spans in other spellings, and with numbers and words that are neither."""
    rng = random.Random(seed)

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        while not luhn(number := digits(16)):
            pass
        return number

    names = ["anna", "j.smith", "info", "m_lee", "office"]
    hosts = ["example", "mail", "post", "web-site"]
    texts, spans = [], []
    for i in range(n):
        parts, marks = ["A walk of 12 miles in 1999, as she said at noon. "], []

        def put(kind, before, value, after=". "):
            start = sum(map(len, parts)) + len(before)
            marks.append((kind, start, start + len(value)))
            parts.append(before + value + after)

        name, host = rng.choice(names) + str(rng.randrange(99)), rng.choice(hosts)
        a, b, c = rng.randrange(1, 99), digits(3), digits(4)
        # Mostly base spans; a tenth of each kind is spelled otherwise.
        other = rng.random() < 0.1
        at, dot = rng.choice([(" [at] ", " [dot] "), ("[AT]", "[DOT]"), ("(at)", "."), (" at ", " dot ")])
        kind = i % 4
        if kind == 0:
            put("email", "Write to ", f"{name}{at}{host}{dot}org" if other else f"{name}@{host}.org")
        elif kind == 1:
            number = f"0049 {a} {b} {c}" if rng.random() < 0.5 else f"({digits(3)}) {b}-{c}"
            put("phone", "Please call tel ", number if other else f"+49 {a + 100} {b} {c}")
        elif kind == 2:
            four = [str(rng.randrange(1, 255)) for _ in range(4)]
            put("ip", "The server at host ", ("[.]" if other else ".").join(four))
        else:
            whole = card()
            groups = [whole[k : k + 4] for k in (0, 4, 8, 12)]
            put("card", "Pay with the card ", (".".join if other else " ".join)(groups))
        if not other:
            marks.clear()
        parts.append(f"The order {digits(10)} and version {digits(3)}.{digits(3)}.{digits(3)}.{999 - a}, total {digits(7)}. ")
        parts.append(f"Token {digits(16)}; see page 12.")
        texts.append("".join(parts))
        spans.append(marks)
    return texts, spans


def test_spans_in_other_spellings_are_found(spark):
    """No label tells of them, and they are a tenth of all; what is neither is left alone."""
    texts, _ = planted(1, 1600)
    found = pii.learn(docs(spark, texts))
    texts, spans = planted(2, 800)
    rows = {r["doc_id"]: r["spans"] for r in pii.find(docs(spark, texts), found).collect()}
    right = added = wanted = 0
    for i, (text, marks) in enumerate(zip(texts, spans)):
        told = {tuple(span.split(":")) for span in rows[i].split(",") if span}
        base_told = {(pii.KINDS[k], str(a), str(b)) for a, k, b in base(text)}
        assert base_told <= told
        mine = {(kind, str(a), str(b)) for kind, a, b in marks}
        right += len(mine & told)
        wanted += len(mine)
        added += len(told - base_told)
    assert wanted > 50
    assert right >= 0.9 * wanted and right >= 0.9 * added


def test_candidates_that_are_never_right_are_left_alone(spark):
    texts = [f"Mail ab{i}@mail.example.com on host 10.{i % 200}.7.{i % 250} now." for i in range(200)]
    numbers = [n for n in range(10**15, 10**15 + 400) if not luhn(str(n))]
    texts += [f"The version {i}.777.888.999 is old, number {numbers[i]}." for i in range(200)]
    found = pii.learn(docs(spark, texts))
    assert None not in found.thresholds  # kinds without examples take the pooled ones
    for row in pii.find(docs(spark, texts), found).collect():
        assert (row["spans"] != "") == (row["doc_id"] < 200)


def test_thresholds_allow_for_what_the_unlabelled_hide():
    positive = Counter({9: 50, 8: 50})
    assert pii._threshold(positive, Counter({1: 100})) == 8
    # A tenth of the unlabelled look like the positive ones, the rest does not.
    assert pii._threshold(positive, Counter({9: 5, 8: 5, 1: 90})) == 8
    # More at a score than the positive ones are worth.
    assert pii._threshold(positive, Counter({9: 2, 8: 40, 1: 58})) == 9
    assert pii._threshold(positive, Counter({9: 60, 1: 40})) is None
    assert pii._threshold(positive, Counter()) == 8
    assert pii._threshold(Counter(), Counter({1: 5})) is None


def test_no_python_and_no_shuffle(spark, model):
    plan = pii.find(table(spark, "documents"), model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
