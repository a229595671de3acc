"""The rule ensemble: held-out accuracy, rules as expressions, odd tables."""

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from monthspan.llm import quality, trees
from monthspan.llm.queries import op5_quality, quality_model
from tests.llm.data import docs, empty, n_odd, odd, table

SF = "/root/testdata/sf0.01"


def test_held_out_labels_are_predicted(spark):
    found = op5_quality(spark, SF).join(table(spark, "labels", SF), "doc_id")
    for held_out in (True, False):
        part = found.where(F.col("held_out") == held_out)
        assert part.count() > 80
        assert part.where("predicted = quality").count() >= 0.95 * part.count()
    assert op5_quality(spark, SF).where("score not between 0 and 1").count() == 0


def test_held_out_rows_teach_nothing(spark):
    model = quality_model(spark, table(spark, "documents", SF), SF)
    assert 0 < len(model.weights) < 150
    labels = table(spark, "labels", SF)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.learn(table(spark, "documents", SF), turned, ~held_out)
    assert again == model


def test_rules_and_values_equal_the_fitted_tree(spark):
    rows = [(float(i % 7), float(i * i % 11), float(i % 7 > 3 and i * i % 11 < 5)) for i in range(200)]
    frame = spark.createDataFrame(rows, "a double, b double, label double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(frame)
    fitted = DecisionTreeClassifier(maxDepth=3).fit(vectors)
    tree, columns = trees.parsed(fitted), [F.col("a"), F.col("b")]
    told = fitted.transform(vectors).withColumn("own", trees.value(tree, columns))
    assert told.where("own <> prediction").count() == 0
    found = {trees.shortened(rule) for rule in trees.rules(tree)}
    leaves = [rule for rule in found if not any(set(rule) < set(other) for other in found)]
    held = sum((trees.holds(rule, columns).cast("int") for rule in leaves), F.lit(0))
    assert vectors.where(held != 1).count() == 0


def test_a_rule_keeps_its_tightest_conditions():
    path = ((0, True, 1.0), (0, True, 2.0), (1, False, 5.0), (1, False, 4.0))
    assert trees.shortened(path) == ((0, True, 2.0), (1, False, 4.0))


def test_few_labels(spark):
    schema = "doc_id long, quality int, toxic int"
    none = quality.learn(odd(spark), spark.createDataFrame([], schema), F.lit(True))
    assert none == quality.Model(0.0, ())
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (7, None, 0), (None, 0, 0), (99, 0, 0)], schema)
    one = quality.learn(docs(spark, ["x"] * 8), labels, F.lit(True))
    assert not one.weights and one.intercept > 0
    rows = quality.score(odd(spark), none).collect()
    assert len(rows) == n_odd() and {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)}


def test_contradicting_labels_count_as_their_majority(spark):
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 0, 0), (1, 1, 0)], schema)
    model = quality.learn(docs(spark, ["good", "bad"]), labels, F.lit(True))
    assert -5 < model.intercept < 5


def test_odd_tables(spark):
    model = quality_model(spark, table(spark, "documents", SF), SF)
    rows = quality.score(odd(spark), model).collect()
    assert len(rows) == n_odd() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (0, 1)}) == 1
    assert quality.score(empty(spark), model).collect() == []
    kept = quality.good(odd(spark), model)
    assert kept.columns == odd(spark).columns
    assert kept.count() == sum(r["predicted"] for r in rows)
