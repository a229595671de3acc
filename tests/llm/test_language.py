"""Language identification: held-out accuracy, plain naive Bayes, odd tables."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from monthspan.llm import language
from monthspan.llm.queries import op6_language
from tests.llm.data import SCHEMA, docs, empty, n_odd, odd, table

SF = "/root/testdata/sf0.01"


def test_held_out_documents_are_identified(spark):
    found = op6_language(spark, SF).join(table(spark, "documents", SF).select("doc_id", "lang"), "doc_id")
    held_out = found.where("held_out")
    assert held_out.count() > 100
    assert held_out.where("lang_pred = lang").count() >= 0.99 * held_out.count()
    assert found.where("score between 0 and 1").count() == found.count() == 1000


def test_counts_and_scores_equal_a_plain_version(spark):
    texts = [("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("the end, and", "en")]
    taught = spark.createDataFrame([(i, t, g, "s", 0) for i, (t, g) in enumerate(texts)], SCHEMA)
    model = language.learn(taught, F.lit(True))
    assert model.languages == ("en", "fr")
    for column, lang in enumerate(model.languages):
        counts = Counter()
        for text, known in texts:
            if known == lang:
                counts.update(language.ngrams(text).tolist())
        total = sum(counts.values()) + language.BUCKETS * language.SMOOTHING
        for bucket in (*counts, 0, 1):
            wanted = math.log((counts[bucket] + language.SMOOTHING) / total)
            assert math.isclose(model.logs[bucket, column], wanted)
    sums = model.logs[language.ngrams("le chien")].sum(axis=0)
    row = language.identify(docs(spark, ["le chien"]), model).first()
    assert row["lang_pred"] == model.languages[int(np.argmax(sums))] == "fr"
    assert row["score"] > 0.5


def test_marks_and_digits_between_words_are_one_gap():
    assert language.ngrams("ab, 12 -- cd").tolist() == language.ngrams("Ab cd").tolist()
    assert len(language.ngrams("12 .!")) == 0


def test_odd_tables(spark):
    taught = language.learn(odd(spark), F.lit(True))
    rows = language.identify(odd(spark), taught).collect()
    assert len(rows) == n_odd()
    assert [(r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (0, 1, 2, 3)] == [("und", 0.0)] * 4
    assert all(r["lang_pred"] == "en" and r["score"] == 1.0 for r in rows if r["doc_id"] == 4)
    assert language.identify(empty(spark), taught).collect() == []
    untaught = language.learn(empty(spark), F.lit(True))
    assert {r["lang_pred"] for r in language.identify(odd(spark), untaught).collect()} == {"und"}


def test_certain_keeps_columns_and_rows_with_a_language(spark):
    taught = language.learn(odd(spark), F.lit(True))
    kept = language.certain(odd(spark), taught, 0.5)
    assert kept.columns == odd(spark).columns
    letters = odd(spark).where(F.col("text").rlike(r"\p{L}"))
    assert sorted(map(str, kept.collect())) == sorted(map(str, letters.collect()))


def test_a_tie_goes_to_the_first_language(spark):
    taught = spark.createDataFrame([(0, "abc", "b", "s", 0), (1, "abc", "a", "s", 0)], SCHEMA)
    model = language.learn(taught, F.lit(True))
    row = language.identify(docs(spark, ["abc"]), model).first()
    assert (row["lang_pred"], row["score"]) == ("a", 0.5)
