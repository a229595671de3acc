"""License notices: exact containment of every template in every document."""

import re

import pytest

from monthspan.llm import licenses
from tests.llm.data import docs, empty, n_odd, odd, table

WORD = re.compile(r"[^\W_]+")


def grams(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + licenses.WORDS]) for i in range(len(words) - licenses.WORDS + 1)}


def plain(text):
    """Names of the templates that the text contains, and the largest containment."""
    found = {}
    for name, template in licenses.TEMPLATES.items():
        wanted = grams(template)
        part = len(wanted & grams(text)) / len(wanted)
        if part >= licenses.CONTAINMENT:
            found[name] = part
    return ",".join(sorted(found)), max(found.values(), default=0.0)


def check(texts, rows):
    for row in rows:
        names, part = plain(texts[row["doc_id"]])
        assert (row["licenses"], row["containment"]) == (names, part)
        assert row["n_licenses"] == len(list(filter(None, names.split(","))))


def test_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    check(texts, licenses.scan(table(spark, "documents")).collect())


def test_notices_at_every_place_and_with_changes(spark):
    texts = []
    for name, template in licenses.TEMPLATES.items():
        words = template.split()
        for before in range(4):
            filler = " ".join(f"f{i}" for i in range(before))
            texts.append(f"{filler} {template.upper()} and more words follow it")
        changed = words[:]
        changed[len(words) // 2] = "changed"
        texts += [" ".join(changed), " ".join(words[: len(words) * 9 // 10]), "\n".join(words)]
    check(dict(enumerate(texts)), licenses.scan(docs(spark, texts)).collect())
    assert sum(plain(text)[0] != "" for text in texts) > 60


def test_odd_tables(spark):
    rows = licenses.scan(odd(spark)).collect()
    assert len(rows) == n_odd()
    assert {(r["n_licenses"], r["licenses"], r["containment"]) for r in rows} == {(0, "", 0.0)}
    assert licenses.scan(empty(spark)).collect() == []


def test_short_and_too_many_templates(spark, monkeypatch):
    with pytest.raises(ValueError, match="fewer than 5 words"):
        licenses.scan(empty(spark), {"short": "all rights reserved"})
    monkeypatch.setattr(licenses, "MOST_SHINGLES", 10)
    with pytest.raises(ValueError, match="more than 10 shingles"):
        licenses.scan(empty(spark))


def test_no_python_and_no_shuffle(spark):
    plan = licenses.scan(table(spark, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
