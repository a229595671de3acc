"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees of a small random forest are cut into rules, conjunctions of conditions on the path to each
node. A logistic regression with a lasso penalty weights the rules and sets most weights to zero. The
rest is one column expression over the statistics, so scoring is a scan without shuffle or Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthspan.llm import trees
from monthspan.llm.shared import saved

# Labelled documents that are learned from at most, the ones that a hash of their doc_id puts first.
SAMPLE = 20_000
TREES = 24
DEPTH = 3
LASSO = 0.002
_MOST_ROUNDS = 60


@dataclass(frozen=True)
class Model:
    """Rules with their weights; the intercept alone is the prior."""

    intercept: float
    weights: tuple[tuple[tuple[trees.Condition, ...], float], ...]

    def score(self, features: list[Column]) -> Column:
        """The probability of good quality."""
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(trees.holds(rule, features), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _marks(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("double")


def counts(text: Column) -> dict[str, Column]:
    """What the statistics are worked out from, each by one pass over the text."""
    words = F.split(text, " ")
    lines = F.split(text, "\n")
    return {
        "chars": F.length(text).cast("double"),
        "words": _count(text, r"\S+"),
        "capitals": F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("double"),
        "odd": F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s.,;:!?'\"()-]+", "")).cast("double"),
        "digits": _count(text, "[0-9]"),
        "shouts": _marks(text, "!"),
        "bars": _marks(text, "|"),
        "ends": _count(text, r"[.!?](?!\S)"),
        "repeats": _count(text, r"(?<!\S)(\S++)(?= \1(?!\S))"),
        "short": _count(text, r"(?<!\S)\p{L}{1,3}+(?!\S)"),
        "spaced": F.size(words).cast("double"),
        "different": F.size(F.array_distinct(words)).cast("double"),
        "lines": F.size(lines).cast("double"),
        "different_lines": F.size(F.array_distinct(lines)).cast("double"),
    }


def statistics(c: dict[str, Column]) -> dict[str, Column]:
    """Statistics of a whole text; shares are 0 for an empty one."""

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return {
        "words": c["words"],
        "word_length": share(c["chars"], c["words"]),
        "capitals": share(c["capitals"], c["chars"]),
        "odd": share(c["odd"], c["chars"]),
        "digits": share(c["digits"], c["chars"]),
        "shouts": share(c["shouts"], c["words"]),
        "bars": share(c["bars"], c["words"]),
        "ends": share(c["ends"], c["words"]),
        "repeats": share(c["repeats"], c["words"]),
        "short": share(c["short"], c["words"]),
        "different": share(c["different"], c["spaced"]),
        "different_lines": share(c["different_lines"], c["lines"]),
        "line_length": share(c["chars"], c["lines"]),
    }


def described(rows: DataFrame, text: Column, kept: str) -> tuple[DataFrame, list[str]]:
    """One column of ``rows`` and a text's statistics, each worked out once; the names of the latter."""
    passes = counts(F.coalesce(text.cast("string"), F.lit("")))
    counted = rows.select(kept, *[column.alias(f"_n_{name}") for name, column in passes.items()])
    found = statistics({name: F.col(f"_n_{name}") for name in passes})
    names = [f"_s_{name}" for name in found]
    return counted.select(kept, *[c.alias(n) for n, c in zip(names, found.values())]), names


def learn(
    docs: DataFrame,
    labels: DataFrame,
    learning: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Fit the rules to labelled documents whose id (column ``doc_id`` of the labels) meets ``learning``.

    Several labels of a document count as their majority, ties as good; null labels don't count.
    Without labels the prior is one half; with one kind of label there are no rules either.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & learning)
    label = (F.avg(F.col(label_col).cast("double")) >= 0.5).cast("double")
    known = known.groupBy("doc_id").agg(label.alias("_label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    chosen = chosen.select(F.col("doc_id").alias("_id"), "_label")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    rows = rows.join(F.broadcast(chosen), "_id")
    sample, names = described(rows, F.col("_text"), "_label")
    sample = saved(sample, "quality-sample").coalesce(4)
    tally = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    if len(tally) < 2:
        good, bad = tally.get(1.0, 0), tally.get(0.0, 0)
        return Model(_logit((good + 1) / (good + bad + 2)), ())
    vectors = VectorAssembler(inputCols=names, outputCol="_features").transform(sample).cache()
    forest = RandomForestClassifier(
        featuresCol="_features",
        labelCol="_label",
        numTrees=TREES,
        maxDepth=DEPTH,
        featureSubsetStrategy="0.5",
        subsamplingRate=0.5,
        seed=1,
    ).fit(vectors)
    vectors.unpersist()
    found = {trees.shortened(r) for tree in forest.trees for r in trees.rules(trees.parsed(tree))}
    rules = sorted(found)
    features = [F.col(name) for name in names]
    held = [trees.holds(rule, features).cast("double").alias(f"_r_{i}") for i, rule in enumerate(rules)]
    indicators = sample.select("_label", *held)
    assembler = VectorAssembler(inputCols=[f"_r_{i}" for i in range(len(rules))], outputCol="_rules")
    lasso = LogisticRegression(
        featuresCol="_rules",
        labelCol="_label",
        elasticNetParam=1.0,
        regParam=LASSO,
        maxIter=_MOST_ROUNDS,
        standardization=False,
    ).fit(assembler.transform(indicators).select("_label", "_rules"))
    weights = lasso.coefficients.toArray().tolist()
    return Model(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights) if w))


def _logit(p: float) -> float:
    from math import log

    return log(p / (1 - p))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from a score of one half on) of every whole text.

    Null and empty texts have statistics of 0 and a score like any other. Repeated rows and rows
    without a doc_id each give a row; an empty table gives none; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("_text"))
    found, names = described(rows, F.col("_text"), "doc_id")
    scored = found.select("doc_id", model.score([F.col(n) for n in names]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are predicted to be of good quality, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col(f"`{text_col}`").alias("_text"))
    found, names = described(rows, F.col("_text"), "_row")
    # A filter would be pushed below the statistics and work each of them out once per rule.
    is_good = model.score([F.col(n) for n in names]) >= 0.5
    kept = F.explode(F.when(is_good, F.array("_row")).otherwise(F.slice(F.array("_row"), 1, 0)))
    return found.select(kept.alias("_kept")).select("_kept.*")
