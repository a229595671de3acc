"""Small documents with everything that may be odd about a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators give to columns of their own.
CLASHES = "score double, node string, sig string, start int, links int, spans string, _row int, size int"

ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "one two three four",
    "one two three four five",
    "one two three four five",
    "word " * 30_000,
    "x" * 100_000,
    "日本語のテキスト テスト。",
    "été été İstanbul ΣΑΣ ΑΣ",
    "😀 a‍b \t tab space '§' \x01",
    "<s> </s> <|endoftext|> <0x0A> ▁under▁",
]


def odd(spark: SparkSession) -> DataFrame:
    """Odd texts, nulls in every column, repeated rows, rows without an id, clashing columns."""
    rows = [(i, text, "en" if i % 3 else None, None, i) for i, text in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "without an id", "en", "s", None), (None, None, None, None, None)]
    clashes = CLASHES.count(",") + 1
    return spark.createDataFrame([(*r, *[None] * clashes) for r in rows], f"{SCHEMA}, {CLASHES}")


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def docs(spark: SparkSession, texts: list, first: int = 0) -> DataFrame:
    rows = [(first + i, text, "en", "s", len(text or "")) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def table(spark: SparkSession, name: str, sf: str = SF) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def n_odd() -> int:
    return len(ODD_TEXTS) + 4


def groups(n: int, links) -> list[int]:
    """For each of n things the least one that links lead to."""
    least = list(range(n))

    def root(i: int) -> int:
        while least[i] != i:
            i = least[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        least[b] = a
    return [root(i) for i in range(n)]
