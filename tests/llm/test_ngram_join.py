"""The n-gram join against all pairs compared exactly."""

import random
from collections import Counter

import numpy as np
import pytest

from monthspan.llm import graph, ngram_join
from tests.llm.data import docs, empty, groups, n_odd, odd, table


def plain(rows):
    """doc_id, class_id and n_links by comparing all pairs."""
    sets = [frozenset(ngram_join.ngram_set(text or "").tolist()) for _, text in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= ngram_join.THRESHOLD
    ]
    degrees = Counter(i for pair in links for i in pair)
    least = groups(len(rows), links)
    return sorted((rows[i][0], rows[least[i]][0], degrees[i]) for i in range(len(rows)))


def joined(frame):
    return sorted(map(tuple, ngram_join.join(frame).collect()))


def near_copies(n, seed, words=60):
    """Texts that differ from one text in a few words."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    texts = []
    for i in range(n):
        copy = base[:]
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(words)] = f"x{i}"
        texts.append(" ".join(copy))
    return texts


def test_documents(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in table(spark, "documents").collect())
    assert joined(table(spark, "documents")) == plain(rows)


def test_a_group_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 96)
    texts = near_copies(3 * ngram_join.BLOCK, 1) + near_copies(20, 2) + [f"alone {i} a b c d" for i in range(50)]
    assert joined(docs(spark, texts)) == plain(list(enumerate(texts)))


def test_a_chain_is_one_class(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[4 * i : 4 * i + 100]) for i in range(70)]
    wanted = plain(list(enumerate(texts)))
    assert {class_id for _, class_id, _ in wanted} == {0}
    assert joined(docs(spark, texts)) == wanted


def test_copies_are_counted_and_not_compared(spark):
    texts = ["a b c d e f g"] * 2000 + ["a  b\nC d e f G"] + ["a b c d e f g h i j k l m n"] * 3
    found = joined(docs(spark, texts))
    assert found[0] == (0, 0, 2000) and found[2000] == (2000, 0, 2000)
    assert found[2001:] == [(i, 2001, 2) for i in (2001, 2002, 2003)]


def test_odd_tables(spark):
    rows = {}
    for doc_id, class_id, n_links in map(tuple, ngram_join.join(odd(spark)).collect()):
        rows.setdefault(doc_id, []).append((class_id, n_links))
    assert sum(map(len, rows.values())) == n_odd()
    # Null, empty and blank texts are copies of each other, the row without an id among them.
    assert [rows[i] for i in (0, 1, 2, 3)] == [[(0, 4)]] * 4
    assert rows[5] == [(5, 2)] * 3
    assert rows[6] == rows[7] == [(6, 1)]
    assert sorted(rows[None], key=str) == [(0, 4), (None, 0)]
    assert joined(empty(spark)) == []


def test_rows_of_one_id_with_different_texts(spark):
    texts = near_copies(6, 3, words=200)
    frame = docs(spark, texts).selectExpr("doc_id % 2 as doc_id", "text")
    found = joined(frame)
    assert [class_id for _, class_id, _ in found] == [0] * 6
    assert sorted(n for _, _, n in found) == sorted(n for _, _, n in plain(list(enumerate(texts))))


def test_one_row_of_each_class_is_kept(spark):
    frame = odd(spark)
    kept = ngram_join.one_of_each(frame)
    assert kept.columns == frame.columns
    found = [r["doc_id"] for r in kept.collect()]
    # A row without an id is a copy of a row with one, the other one is alone.
    assert sorted(found, key=str) == sorted([0, 4, 5, 6, *range(8, 14), None], key=str)
    assert ngram_join.one_of_each(empty(spark)).collect() == []


def test_rows_are_kept_by_their_own_texts(spark):
    first, second, third = near_copies(2, 5, words=100), near_copies(2, 6, words=100), near_copies(1, 7, words=100)
    rows = [(1, first[0], "a"), (1, second[0], "b"), (2, first[1], "c"), (2, second[1], "d"), (2, second[1], "d")]
    rows += [(None, third[0], "e"), (None, third[0], "e"), (None, first[0], "f"), (3, None, "g"), (3, "", "g")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key string")
    found = ngram_join.one_of_each(frame.withColumnRenamed("key", "copies")).collect()
    assert sorted(r["copies"] for r in found) == ["a", "b", "e", "g"]


def test_the_chance_of_a_link_reaches_the_target():
    chances = [1 - (1 - ngram_join.THRESHOLD**d) ** ngram_join.TREES for d in range(1, ngram_join.DEPTH + 1)]
    assert max(chances) >= ngram_join.RECALL and chances == sorted(chances, reverse=True)


@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_signatures_estimate_similarity(share):
    rng = np.random.default_rng(1)
    common = rng.integers(0, 1 << 63, int(4000 * share), dtype=np.uint64)
    own = [rng.integers(0, 1 << 63, int(4000 * (1 - share) / 2), dtype=np.uint64) for _ in range(2)]
    sigs = [
        np.frombuffer(ngram_join.signature(np.unique(np.concatenate([common, o]))), dtype="<u2") for o in own
    ]
    assert abs((sigs[0] == sigs[1]).mean() - share) < 0.15


def test_components_of_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    frame = spark.createDataFrame(links, "a long, b long")
    nodes = {i for a, b in links if a != b for i in (a, b)}
    least = groups(461, links)
    found = {r["node"]: r["component"] for r in graph.components(frame, "test").collect()}
    assert found == {i: least[i] for i in nodes}
    assert graph.components(frame.where("a < 0"), "test").collect() == []
