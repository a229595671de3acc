"""Personal data: generated candidates, boosted trees, calibrated thresholds.

Fixed patterns with checks (part sizes, check digits, numbers of digits) make the base spans. High-recall patterns
propose further spans of the four kinds in other spellings, which may overlap. Boosted trees tell by a candidate's
format and the text around it whether it is personal data.

The base spans are the positive examples, as they stand and respelled as candidates may be (``name [at] host [dot]
org``, ``00`` or brackets for a plus, other separators), each in its own context. The candidates that touch no base
span have no labels: some are personal data, most are order numbers, versions and the like. They are weighed like
negative ones in learning, and thresholds allow for what they hide. A threshold makes the most of the share of
respelled examples above it less ``FALSE`` times the share of unlabelled ones. If a part of the unlabelled is personal
data too, it lowers that difference by the same factor everywhere, so the best threshold stays where it is.

Finding, scoring and redacting are column expressions on each row: no shuffle, no Python. Learning reads the texts
once and writes spans and candidates, which are few; of scores, only counts are collected.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthspan.llm import trees
from monthspan.llm.shared import saved, whole_texts

KINDS = ("email", "ip", "card", "phone")
# Examples of each label that trees are fitted to at most; a hash decides which. All others give the thresholds.
SAMPLE_CANDIDATES = 10_000
ROUNDS = 12
DEPTH = 3
# What a share of the unlabelled candidates weighs against the same share of the positive examples.
FALSE = 5
# Scores are counted in steps of 1 / STEPS.
STEPS = 8
# Characters of context on either side.
BEFORE, AFTER = 24, 8

# The base patterns. Quantifiers are possessive and starts are anchored where that
# changes no match, so that a match takes time in proportion to the text.
_LOCAL = "A-Za-z0-9._%+-"
_BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Candidates: also spelled-out signs, other separators, numbers without a plus.
_CANDIDATES = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++(?:@| ?[\[(](?:at|AT)[\])] ?| at )[A-Za-z0-9-]++"
    r"(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?| dot )[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z])[0-9]{1,4}+(?:(?:[.,:]|\[\.\])[0-9]{1,4}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ ./-]{0,2}[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00|\()?[0-9](?:[ ().\-/]{0,2}[0-9]){6,14}(?![0-9A-Za-z])",
}
# A text without any of this has no candidate of the kind.
_TOLD = {
    "email": r"@|[\[(](?:at|AT)[\])]| at [A-Za-z0-9-]+(?:\.| ?[\[(](?:dot|DOT)[\])]| dot )",
    "ip": r"[0-9](?:[.,:]|\[\.\])[0-9]",
    "card": r"[0-9][ ./-]{0,2}[0-9][ ./-]{0,2}[0-9][ ./-]{0,2}[0-9]",
    "phone": r"[0-9][ ().\-/]{0,2}[0-9][ ().\-/]{0,2}[0-9][ ().\-/]{0,2}[0-9]",
}
# Other spellings of base spans: pattern and replacement, one after the other.
_SPELLINGS = {
    "email": (
        [("@", " [at] "), (r"\.", " [dot] ")],
        [("@", "(at)"), (r"\.", ".")],
        [("@", "[AT]"), (r"\.", "[DOT]")],
        [("@", " at "), (r"\.", " dot ")],
    ),
    "ip": ([(r"\.", "[.]")], [(r"\.([0-9]+)$", "[.]$1")]),
    "card": ([("[ -]", "")], [("[ -]", "."), ], [("[ -]?([0-9]{4})", " / $1"), ("^ / ", "")]),
    "phone": (
        [(r"^\+", "00")],
        [(r"^\+", "")],
        [(r"^\+[0-9]{1,2}[ .-]*", "(0"), (r"^(\(0[0-9]{2,4})[ ().-]*", "$1) ")],
        [(r"[().]", ""), (r"[ -]+", "/"), (r"^\+", "00")],
    ),
}
# Words around a kind of personal data, in the languages of the corpus.
_CUES = (
    r"mail|write|contact|schreib|écri|correo",
    r"tel|phone|call|fon|mobile|móvil|rufnummer|appel",
    r"card|visa|master|amex|karte|carte|tarjeta|pay",
    r"\bip\b|host|server|addr|adress",
    r"order|invoice|version|isbn|total|price|page|token|password|key|hash|[=$€#\"]\s*$",
)


def _matches(text: Column, pattern: str, told: Column) -> tuple[Column, Column]:
    """The matches of a pattern and the texts between them; none where nothing tells of one."""
    found = F.when(told, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    found = F.coalesce(found, F.array().cast("array<string>"))
    gaps = F.when(F.size(found) > 0, F.split(text, pattern, -1))
    return found, gaps


def _spans(found: Column, gaps: Column) -> Column:
    """Matches with their places in code points and the text around them."""
    steps = F.zip_with(
        F.concat(F.array(F.lit("")), found),
        F.coalesce(gaps, F.array(F.lit(""))),
        lambda match, gap: F.length(match) + F.length(gap),
    )
    # The start of each match, and the text's length as the last entry.
    starts = F.aggregate(
        steps,
        F.array().cast("array<int>"),
        lambda ends, step: F.array_append(ends, F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(0)) + step),
    )
    placed = F.arrays_zip(found.alias("value"), starts.alias("start"), gaps.alias("before"))
    following = F.slice(gaps, F.lit(2), F.size(found))

    def span(place: Column, after: Column) -> Column:
        return F.struct(
            place["start"].alias("start"),
            (place["start"] + F.length(place["value"])).alias("end"),
            place["value"].alias("value"),
            F.right(place["before"], F.lit(BEFORE)).alias("before"),
            F.left(after, F.lit(AFTER)).alias("after"),
        )

    listed = F.zip_with(F.slice(placed, F.lit(1), F.size(found)), following, span)
    kind = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
    return F.when(F.size(found) > 0, listed).otherwise(F.array().cast(kind))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Whether the last digit is right: from the right, every second digit counts double."""
    places = F.sequence(F.lit(1), F.length(digits))

    def weighed(total: Column, place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(places, F.lit(0), weighed) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern passes its kind's check."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: _small(F.ltrim(part, F.lit("0"))))
    digits = _digits(value)
    n = F.length(digits)
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(digits)).otherwise(False)
    return n.between(9, 15)


def _small(number: Column) -> Column:
    return F.when(F.length(number) <= 3, F.coalesce(number.try_cast("int"), F.lit(0)) <= 255).otherwise(False)


def _features(kind: int, span: Column) -> Column:
    """Format and context of a candidate as numbers, with whether its digits pass the kind's check."""
    value, before, after = span["value"], span["before"], span["after"]
    digits = _digits(value)
    checked = F.lit(True)
    if KINDS[kind] == "card":
        checked = _luhn(digits)
    elif KINDS[kind] == "ip":
        checked = F.forall(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)), lambda part: _small(F.ltrim(part, F.lit("0"))))
    columns = [
        F.lit(kind),
        F.length(value),
        F.length(digits),
        F.regexp_count(value, F.lit("[0-9]+")),
        F.regexp_count(value, F.lit("[A-Za-z]")),
        F.regexp_count(value, F.lit(" ")),
        F.regexp_count(value, F.lit("[.]")),
        F.regexp_count(value, F.lit("[-/(),:]")),
        F.length(F.regexp_extract(value, "[0-9]+", 0)),
        F.regexp_count(value, F.lit(r"[\[(]|[a-z] (?:at|dot) [a-z]")),
        F.coalesce(F.left(digits, F.lit(1)).try_cast("int"), F.lit(-1)),
        F.size(F.array_distinct(F.split(digits, ""))),
        *[before.rlike("(?i)" + cue).cast("int") for cue in _CUES],
        before.rlike(r"\+[0-9() .-]*$").cast("int"),
        before.rlike(r"[0-9A-Za-z][^0-9A-Za-z\s]?$").cast("int"),
        after.rlike(r"^[0-9A-Za-z@]|^[^0-9A-Za-z\s][0-9A-Za-z]").cast("int"),
        F.regexp_count(before, F.lit("[0-9]")),
        F.regexp_count(after, F.lit("[0-9]")),
        checked.cast("int"),
    ]
    return F.array(*[c.cast("double") for c in columns])


N_FEATURES = 18 + len(_CUES)


@dataclass(frozen=True)
class Model:
    """Trees with weights, and the least score per kind (None: nothing is added)."""

    trees: tuple[tuple[float, trees.Leaf | trees.Split], ...] = ()
    thresholds: tuple[float | None, ...] = (None,) * len(KINDS)

    def margin(self, features: Column) -> Column:
        """The trees' weighted sum, which rises with the probability."""
        columns = [F.get(features, F.lit(i)) for i in range(N_FEATURES)]
        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + weight * trees.value(tree, columns)
        return total


def _found(rows: DataFrame, patterns: dict[str, str], prefix: str) -> DataFrame:
    """Columns of spans per kind, found in the column _text."""
    for step in ("matches", "spans"):
        columns = []
        for kind, pattern in patterns.items():
            name = f"{prefix}_{kind}"
            if step == "matches":
                found, gaps = _matches(F.col("_text"), pattern, _tells(kind, patterns is _BASE))
                columns.append(F.struct(found.alias("found"), gaps.alias("gaps")).alias(name))
            else:
                columns.append(_spans(F.col(name)["found"], F.col(name)["gaps"]).alias(name))
        others = [c for c in rows.columns if not c.startswith(f"{prefix}_")]
        rows = rows.select(*others, *columns)
    return rows


def _tells(kind: str, base: bool) -> Column:
    """Whether the text may hold a span or candidate of the kind."""
    text = F.col("_text")
    if base:
        return text.contains({"email": "@", "phone": "+"}[kind]) if kind in ("email", "phone") else text.rlike("[0-9]")
    return text.rlike(_TOLD[kind])


def _apart(span: Column, others: Column) -> Column:
    """Does the span touch none of the others?"""
    return ~F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def _numbered(kind: int, spans: Column) -> Column:
    """Spans as (start, kind, end), which is the order that they are told in."""
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")),
    )


def _with_spans(rows: DataFrame, model: Model) -> DataFrame:
    """Adds _base and _spans, sorted arrays of (start, kind, end), to rows with the column _text."""
    others = rows.columns
    rows = _found(rows, _BASE, "_base")
    base = [
        _numbered(number, F.filter(F.col(f"_base_{kind}"), lambda s: _passes(kind, s["value"])))
        for number, kind in enumerate(KINDS)
    ]
    rows = rows.select(*others, F.array_sort(F.concat(*base)).alias("_base"))
    if not model.trees:
        return rows.withColumn("_spans", F.col("_base"))
    rows = _found(rows, _CANDIDATES, "_candidate")
    added = []
    for number, (kind, threshold) in enumerate(zip(KINDS, model.thresholds)):
        if threshold is not None:
            scored = F.transform(
                F.filter(F.col(f"_candidate_{kind}"), lambda s: _apart(s, F.col("_base"))),
                lambda s: F.struct(
                    s["start"].alias("start"), s["end"].alias("end"), _features(number, s).alias("features")
                ),
            )
            rows = rows.withColumn(f"_scored_{kind}", scored)
            likely = F.filter(
                F.col(f"_scored_{kind}"), lambda s: model.margin(s["features"]) >= threshold
            )
            added.append(_numbered(number, likely))
    every = F.array_sort(F.array_union(F.col("_base"), F.concat(*added))) if added else F.col("_base")
    return rows.select(*others, "_base", every.alias("_spans"))


def _told(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    told = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(told, ",")


def _listed(texts: DataFrame) -> DataFrame:
    """All base spans, and the candidates that touch none of them: doc_id, base, kind and span."""
    rows = texts.select("doc_id", F.col("text").alias("_text"))
    rows = _found(rows, _BASE, "_base")
    rows = rows.select(
        "doc_id",
        "_text",
        *[
            F.filter(F.col(f"_base_{kind}"), lambda s: _passes(kind, s["value"])).alias(f"_base_{kind}")
            for kind in KINDS
        ],
    )
    rows = _found(rows, _CANDIDATES, "_candidate")
    every = F.concat(*[F.col(f"_base_{kind}") for kind in KINDS])
    kinds = [*[f"_base_{kind}" for kind in KINDS], *[f"_candidate_{kind}" for kind in KINDS]]
    rows = rows.select("doc_id", every.alias("_every"), *kinds)
    listed = []
    for number, kind in enumerate(KINDS):
        free = F.filter(F.col(f"_candidate_{kind}"), lambda s: _apart(s, F.col("_every")))
        for base, spans in ((True, F.col(f"_base_{kind}")), (False, free)):
            named = F.struct(F.lit(base).alias("base"), F.lit(number).alias("kind"))
            listed.append(F.transform(spans, lambda s: named.withField("span", s)))
    return rows.select("doc_id", F.explode(F.concat(*listed)).alias("e")).select("doc_id", "e.*")


def _respelled(spans: DataFrame) -> DataFrame:
    """Base spans in the spellings of candidates, each in its context: what the candidates' patterns find there.

    As they stand, base spans are candidates too, where the patterns agree on their ends.
    """
    made = []
    for number, kind in enumerate(KINDS):
        value = F.col("span.value")
        spelled = [value]
        for steps in _SPELLINGS[kind]:
            other = value
            for pattern, replacement in steps:
                other = F.regexp_replace(other, pattern, replacement)
            spelled.append(other)
        rows = spans.filter(F.col("kind") == number)
        rows = rows.select("*", F.posexplode(F.array(*spelled)).alias("spelling", "value"))
        rows = rows.filter((F.col("spelling") == 0) | (F.col("value") != F.col("span.value")))
        rows = rows.select(
            "doc_id",
            "kind",
            F.col("span.start").alias("start"),
            "spelling",
            F.length("span.before").alias("from"),
            (F.length("span.before") + F.length("value")).alias("to"),
            F.concat("span.before", "value", "span.after").alias("_text"),
        )
        rows = _found(rows, {kind: _CANDIDATES[kind]}, "_candidate")
        same = F.filter(
            F.col(f"_candidate_{kind}"), lambda s: (s["start"] == F.col("from")) & (s["end"] == F.col("to"))
        )
        rows = rows.select("doc_id", "kind", "start", "spelling", F.explode(same).alias("span"))
        made.append(_example(rows, number, 1.0))
    return made[0].unionAll(made[1]).unionAll(made[2]).unionAll(made[3])


def _example(rows: DataFrame, kind: int, label: float) -> DataFrame:
    return rows.select(
        F.xxhash64("doc_id", "kind", "start", "spelling").alias("_order"),
        F.lit(kind).alias("_kind"),
        F.lit(label).alias("_label"),
        (F.col("spelling") > 0).alias("_respelled"),
        _features(kind, F.col("span")).alias("_f"),
    )


def _examples(texts: DataFrame) -> DataFrame:
    """Positive and unlabelled examples of all texts: _order (a hash), _kind, _label (1 or 0), _respelled
    (is it a positive one in another spelling?) and _f."""
    listed = saved(_listed(texts), "pii-spans")
    examples = _respelled(listed.filter("base"))
    for number in range(len(KINDS)):
        rows = listed.filter(~F.col("base") & (F.col("kind") == number))
        rows = rows.select("doc_id", "kind", F.col("span.start").alias("start"), F.lit(0).alias("spelling"), "span")
        examples = examples.unionAll(_example(rows, number, 0.0))
    return saved(examples, "pii-examples")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit trees to at most ``SAMPLE_CANDIDATES`` examples of each label, and thresholds to all others.

    A third of the examples, whatever their number, is left to the thresholds. Documents without both kinds of
    examples give a model that adds nothing.
    """
    examples = _examples(whole_texts(docs, id_col, text_col))
    columns = [F.get("_f", F.lit(i)).alias(f"_f_{i}") for i in range(N_FEATURES)]
    fitting = examples.where(F.pmod(F.col("_order"), F.lit(3)) != 0).select("_order", "_label", *columns)
    chosen = [fitting.where(F.col("_label") == label).orderBy("_order").limit(SAMPLE_CANDIDATES) for label in (0.0, 1.0)]
    chosen = saved(chosen[0].unionAll(chosen[1]), "pii-sample").coalesce(2)
    counts = {row["_label"]: (row["n"], row["last"]) for row in chosen.groupBy("_label").agg(
        F.count("*").alias("n"), F.max("_order").alias("last")).collect()}
    if len(counts) < 2:
        return Model()
    weight = F.when(F.col("_label") == 1, 1.0 / counts[1.0][0]).otherwise(1.0 / counts[0.0][0])
    assembler = VectorAssembler(inputCols=[f"_f_{i}" for i in range(N_FEATURES)], outputCol="_features")
    weighed = chosen.withColumn("_weight", weight * (counts[0.0][0] + counts[1.0][0]) / 2)
    vectors = assembler.transform(weighed).select("_features", "_label", "_weight").cache()
    boosted = GBTClassifier(
        featuresCol="_features", labelCol="_label", weightCol="_weight", maxIter=ROUNDS, maxDepth=DEPTH, seed=1
    ).fit(vectors)
    vectors.unpersist()
    fitted = Model(
        tuple((float(w), trees.parsed(t)) for w, t in zip(boosted.treeWeights, boosted.trees))
    )
    last = F.when(F.col("_label") == 1, counts[1.0][1]).otherwise(counts[0.0][1])
    unseen = examples.where((F.pmod(F.col("_order"), F.lit(3)) == 0) | (F.col("_order") > last))
    # As they stand, base spans need no threshold.
    unseen = unseen.where(F.col("_respelled") | (F.col("_label") == 0))
    score = F.floor(fitted.margin(F.col("_f")) * STEPS) / STEPS
    # At most a number per kind, label and step of the scores, which the trees' weights bound.
    told = unseen.groupBy("_kind", "_label", score.alias("score")).count().collect()
    positive = [Counter(), Counter(), Counter(), Counter()]
    unlabelled = [Counter(), Counter(), Counter(), Counter()]
    for row in told:
        side = positive if row["_label"] == 1 else unlabelled
        side[row["_kind"]][row["score"]] += row["count"]
    # A kind's few examples are set against what is usual among the kinds.
    pooled = sum(positive, Counter())
    usual = sum(map(Counter.total, unlabelled)) / len(KINDS)
    return Model(
        fitted.trees, tuple(_threshold(p or pooled, u, usual) for p, u in zip(positive, unlabelled))
    )


def _threshold(positive: Counter, unlabelled: Counter, usual: float = 0) -> float | None:
    """The score from which on the share of the positive examples most exceeds ``FALSE`` times that of the
    unlabelled ones, from how many have each score; None where it never does. The latter share is one of the kind's
    own number of unlabelled examples and the ``usual`` one."""
    n, m = positive.total(), unlabelled.total() + usual
    best, most, held, passed = None, 0.0, 0, 0
    for score in sorted({*positive, *unlabelled}, reverse=True):
        held += positive[score]
        passed += unlabelled[score]
        gain = held / max(n, 1) - FALSE * passed / max(m, 1)
        if gain > most:
            best, most = score, gain
    return best


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in every whole text: doc_id, n_email, n_ip, n_card and n_phone (base
    spans by kind), base_sha256 (of the base spans as kind:start:end, by start, then kind) and spans
    (all spans, told likewise). Places are code points, the end exclusive.

    A null text is empty. Repeated rows and rows without a doc_id each give a row; an empty table
    gives none; other columns are ignored.
    """
    texts = whole_texts(docs, id_col, text_col).select("doc_id", F.col("text").alias("_text"))
    found = _with_spans(texts, model)
    numbers = [
        F.size(F.filter("_base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")
        for number, kind in enumerate(KINDS)
    ]
    return found.select(
        "doc_id",
        *numbers,
        F.sha2(_told(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _told(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, model: Model, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same rows with every span's text replaced by its kind in brackets, as in [EMAIL].

    Spans that overlap are replaced together, by the first one's kind. The column ``length_col``,
    where there is one, is set to the new length; a null text stays null.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    found = _with_spans(docs.select(row, text.alias("_text")), model)
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])

    def replace(done: Column, span: Column) -> Column:
        between = F.substring(F.col("_text"), done["at"] + 1, span["start"] - done["at"])
        told = F.concat(done["text"], between, F.get(names, span["kind"]))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(span["start"] >= done["at"], told).otherwise(done["text"]).alias("text"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    replaced = F.aggregate(
        "_spans",
        start,
        replace,
        lambda done: F.concat(done["text"], F.substring(F.col("_text"), done["at"] + 1, F.length("_text"))),
    )
    replaced = F.when(F.size("_spans") > 0, replaced).otherwise(F.col("_row")[text_col])
    found = found.select("_row", replaced.alias("_new"))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("_new").alias(c))
        elif c == length_col:
            kind = docs.schema[c].dataType
            columns.append(F.coalesce(F.length("_new").cast(kind), F.col("_row")[c]).alias(c))
        else:
            columns.append(F.col("_row")[c].alias(c))
    return found.select(*columns)
