"""The corpus pipeline, stage by stage, against plain versions."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from monthspan.llm import language, ngram_join, pii, quality
from monthspan.llm.queries import QUERIES, quality_model, remainder
from tests.llm.data import SF, odd, table
from tests.llm.test_ngram_join import plain as plain_classes


@pytest.fixture(scope="module")
def results(spark):
    """Each stage's documents and what it makes of them."""
    docs, found = table(spark, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF).cache()
        found[name] = docs, result
        docs = result
    return found


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_keep_the_columns_of_documents(spark, results):
    assert list(results) == ["quality", "language", "near_duplicates", "pii", "packing"]
    for name, (_, result) in results.items():
        if name != "packing":
            assert result.schema.simpleString() == table(spark, "documents").schema.simpleString()


def test_quality(spark, results):
    docs, result = results["quality"]
    scored = quality.score(docs, quality_model(spark, docs, SF))
    assert 0 < result.count() < docs.count()
    assert ids(result) == ids(scored.where("predicted = 1"))
    labels = table(spark, "labels")
    rejected = docs.join(result, "doc_id", "left_anti").join(labels, "doc_id")
    assert rejected.where("quality = 1").count() <= 0.05 * labels.where("quality = 1").count()


def test_language(spark, results):
    docs, result = results["language"]
    model = language.learn(docs, F.coalesce(remainder(5) != 0, F.lit(False)))
    found = language.identify(docs, model)
    wanted = found.where((F.col("score") >= corpus_pipeline.LEAST_SCORE) & (F.col("lang_pred") != "und"))
    assert ids(result) == ids(wanted)


def test_near_duplicates(spark, results):
    docs, result = results["near_duplicates"]
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert ids(result) == [doc_id for doc_id, class_id, _ in plain_classes(rows) if doc_id == class_id]
    assert result.count() < docs.count()


def test_pii(spark, results):
    docs, result = results["pii"]
    assert ids(result) == ids(docs)
    assert result.where(F.length("text") != F.col("n_chars")).count() == 0
    again = pii.find(result, pii.Model())
    assert again.where("n_email + n_ip + n_card + n_phone > 0").count() == 0


def test_packing(spark, results):
    docs, result = results["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = {
        r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect()
    }
    found = {r["doc_id"]: r["n"] for r in result.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert found == wanted


def test_run_gives_the_last_stage(spark, results):
    rows = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "start", "length", "ids_crc32"]
    wanted = results["packing"][1].select(columns)
    assert sorted(rows.select(columns).collect()) == sorted(wanted.collect())


def test_stages_take_odd_tables(spark):
    for docs in (odd(spark), odd(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() >= 0


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))


def test_kept_documents_have_no_near_duplicate(spark, results):
    joined = ngram_join.join(results["near_duplicates"][1])
    assert joined.where("n_links > 0").count() == 0
