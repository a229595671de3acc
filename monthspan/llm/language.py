"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting is one pass over the learning rows: every task adds up the n-grams of each language in its
texts and passes on one count per language and bucket. The log-probability matrix, of ``BUCKETS`` rows
and a column per language, is what is broadcast; its size depends on these two numbers alone, and
more than ``MOST_LANGUAGES`` languages are an error. Scoring is sparse: a batch of texts becomes one
row of bucket numbers, whose matrix rows are added up per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthspan.llm.shared import mixed, slices, whole_texts

BUCKETS = 1 << 15
SIZES = (1, 2, 3)
MOST_LANGUAGES = 256
UNKNOWN = "und"
SMOOTHING = 0.5
# n-grams scored at once; bounds a worker's memory whatever a text's length.
_BLOCK = 1 << 18

_LETTERS: np.ndarray | None = None


@dataclass(frozen=True)
class Model:
    """Languages in order and, per bucket, the logarithm of its probability in each."""

    languages: tuple[str, ...]
    logs: np.ndarray


def ngrams(text: str) -> np.ndarray:
    """Bucket numbers of a text's character n-grams, repeats included; none without a letter.

    Small letters count; whatever stands between two words counts as one gap.
    """
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _LETTERS[codes]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    codes = np.where(letter, codes, 32).astype(np.uint64)
    gap = ~letter
    codes = codes[~(gap & np.concatenate([[False], gap[:-1]]))]
    edge = np.array([32], dtype=np.uint64)
    start, end = (edge[: int(codes[i] != 32)] for i in (0, -1))
    codes = np.concatenate([start, codes, end])
    found = []
    for size in SIZES:
        n = len(codes) - size + 1
        if n > 0:
            h = np.full(n, size, dtype=np.uint64)
            for j in range(size):
                h = h * np.uint64(0x110001) + codes[j : j + n]
            found.append((mixed(h) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
    return np.concatenate(found)


def learn(docs: DataFrame, learning: Column, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts of the rows for which ``learning`` holds and whose language is known.

    Texts without a letter teach nothing. No such row at all gives a model without languages.
    """
    rows = docs.where(learning & F.col(f"`{lang_col}`").isNotNull())
    rows = rows.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                held += np.bincount(ngrams(text), minlength=BUCKETS)
                if len(counts) > MOST_LANGUAGES:
                    raise ValueError(f"more than {MOST_LANGUAGES} languages")
        for lang, held in counts.items():
            buckets = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(buckets), pa.string()), pa.array(buckets), pa.array(held[buckets])],
                ["lang", "bucket", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, bucket long, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.full((BUCKETS, len(languages)), SMOOTHING)
    places = {lang: i for i, lang in enumerate(languages)}
    columns = [places[lang] for lang in table.column("lang").to_pylist()]
    counts[table.column("bucket").to_numpy(), columns] += table.column("n").to_numpy()
    return Model(tuple(languages), np.log(counts / counts.sum(axis=0, keepdims=True)))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score for every whole text.

    All languages are equally likely beforehand. The score is the language's probability, taken
    over the mean n-gram so that long texts stay apart: 0 to 1, and 1 / languages without evidence.
    A null text, a text without a letter and a model without languages give ``und`` and 0; a tie
    goes to the first language by name. Repeated rows and rows without a doc_id each give a row; an
    empty table gives none; other columns are ignored.
    """
    texts = whole_texts(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, logs = shared.value.languages, shared.value.logs
        for batch in slices(batches):
            found = [_best(ngrams(text), logs) for text in batch.column("text").to_pylist()]
            names = [UNKNOWN if best is None else languages[best] for best, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names, pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return texts.mapInArrow(work, f"doc_id {id_type}, lang_pred string, score double")


def certain(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows whose language is known with at least that score, with all their columns.

    A model without languages, which has learned nothing, rejects only texts without a letter.
    """
    taught = bool(model.languages)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value.logs
        for batch in slices(batches):
            keep = []
            for text in batch.column(place).to_pylist():
                buckets = ngrams(text or "")
                score = _best(buckets, logs)[1] if taught else float(len(buckets) > 0)
                keep.append(score > 0 and score >= least)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


# n-grams of evidence that a score takes a text to hold at most.
_EVIDENCE = 50


def _best(buckets: np.ndarray, logs: np.ndarray) -> tuple[int | None, float]:
    n = len(buckets)
    if not n or not logs.shape[1]:
        return None, 0.0
    total = np.zeros(logs.shape[1])
    for start in range(0, n, _BLOCK):
        total += logs[buckets[start : start + _BLOCK]].sum(axis=0)
    total -= total.max()
    shares = np.exp(total / n * min(n, _EVIDENCE))
    best = int(total.argmax())
    return best, float(shares[best] / shares.sum())
