"""The multiset hash's laws, and edits against a plain walk."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from monthspan.llm import fingerprints as fp
from tests.llm.data import docs, empty, n_odd, odd, table

PARAGRAPHS = st.lists(st.text(alphabet="ab c.", max_size=30), min_size=1, max_size=8)


@given(PARAGRAPHS, st.randoms())
@settings(max_examples=100, deadline=None)
def test_the_order_of_paragraphs_does_not_matter(paragraphs, random):
    mixed = paragraphs[:]
    random.shuffle(mixed)
    assert fp.fingerprint("\n".join(paragraphs)) == fp.fingerprint("\n".join(mixed))


@given(PARAGRAPHS, PARAGRAPHS)
@settings(max_examples=100, deadline=None)
def test_paragraphs_come_and_go(one, other):
    both = fp.fingerprint("\n".join(one + other))
    assert fp.changed(fp.fingerprint("\n".join(one)), inserted=other) == both
    assert fp.changed(both, deleted=other) == fp.fingerprint("\n".join(one))


@given(PARAGRAPHS, PARAGRAPHS)
@settings(max_examples=100, deadline=None)
def test_only_equal_multisets_have_equal_fingerprints(one, other):
    same = fp.fingerprint("\n".join(one)) == fp.fingerprint("\n".join(other))
    assert same == (sorted(one) == sorted(other))


def test_likeness_follows_the_common_word_runs():
    words = [f"w{i}" for i in range(400)]
    whole = fp.fingerprint(" ".join(words))
    assert fp.likeness(whole, whole) == 1
    half = fp.fingerprint(" ".join(words[:200] + [f"v{i}" for i in range(200)]))
    assert 0.4 < fp.likeness(whole, half) < 0.6
    assert fp.likeness(whole, fp.fingerprint(" ".join(f"u{i}" for i in range(400)))) < 0.15


def plain(rows):
    """The contract, document by document."""
    rows = sorted(rows)
    found = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        n = len(text) // 2
        changed = text[: len(text) - n] + following[:n]
        prints = fp.fingerprint(text), fp.fingerprint(changed), fp.fingerprint(following)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = fp.likeness(prints[0], prints[1]), fp.likeness(prints[0], prints[2])
        found.append((doc_id, len(text), digest, prints[0], prints[1], *near))
    return found


def test_edits_equal_a_plain_walk(spark):
    documents = table(spark, "documents")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert sorted(map(tuple, fp.against_edits(documents.repartition(5)).collect())) == plain(rows)
    apart = documents.selectExpr("doc_id * doc_id * 1000003 - 5000000 as doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in apart.collect()]
    assert sorted(map(tuple, fp.against_edits(apart).collect())) == plain(rows)


def test_few_documents(spark):
    for texts in (["alone"], ["one text", "another"], ["", "x", ""]):
        rows = list(enumerate(texts))
        assert sorted(map(tuple, fp.against_edits(docs(spark, texts)).collect())) == plain(rows)


def test_odd_tables(spark):
    rows = fp.against_edits(odd(spark)).collect()
    assert len(rows) == n_odd()
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 5}) == 1
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert fp.against_edits(empty(spark)).collect() == []
    assert len(fp.fingerprints(odd(spark)).collect()) == n_odd()
    assert fp.fingerprints(empty(spark)).collect() == []


@pytest.mark.parametrize("n", [32_700, 65_500])
def test_likeness_of_texts_of_many_equal_runs(n):
    one, other = ("\n".join(["the same five words here"] * k) for k in (n, n + 100))
    assert 0.99 < fp.likeness(fp.fingerprint(one), fp.fingerprint(other)) < 1.0
    fewer = fp.changed(fp.fingerprint(other), deleted=["the same five words here"] * 100)
    assert fewer == fp.fingerprint(one)
