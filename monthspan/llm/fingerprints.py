"""Fingerprints of documents: a homomorphic hash of the multiset of their paragraphs.

A paragraph (the text between two line breaks) is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors, lane by lane modulo a power of two. The order of
paragraphs does not matter, and a paragraph is inserted or deleted by adding or subtracting its
vector (``changed``). A vector has two parts:

* ``EXACT`` lanes modulo 2^64 from a cryptographic hash, which tell multisets apart;
* ``SKETCH`` lanes modulo 2^32, more than any text has runs, to which each run of ``RUN`` words of the
  paragraph adds +1 or -1 in one lane. Scalar products of such sums estimate how many runs two documents share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthspan.llm.shared import paragraph_shingles, slices, whole_texts

EXACT = 8
SKETCH = 512
RUN = 5


def vector(paragraph: str) -> tuple[np.ndarray, np.ndarray]:
    """One paragraph's lanes."""
    return _sum([paragraph])


def _sum(paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    hashed = b"".join(hashlib.blake2b(p.encode("utf-8", "surrogatepass")).digest() for p in paragraphs)
    exact = np.frombuffer(hashed, dtype="<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
    h = paragraph_shingles(paragraphs, RUN)
    lanes = (h % np.uint64(SKETCH)).astype(np.int64)
    signs = 1.0 - 2.0 * (h >> np.uint64(63)).astype(np.float64)
    sketch = np.bincount(lanes, weights=signs, minlength=SKETCH).astype(np.int64).astype("<u4")
    return exact, sketch


def fingerprint(text: str) -> str:
    """Lowercase hex of all lanes, little-endian, the exact ones first."""
    exact, sketch = _sum(text.split("\n"))
    return (exact.astype("<u8").tobytes() + sketch.tobytes()).hex()


def changed(print_: str, inserted: list[str] = (), deleted: list[str] = ()) -> str:
    """The fingerprint after paragraphs come and go."""
    exact, sketch = _lanes(print_)
    for paragraphs, sign in ((inserted, 1), (deleted, -1)):
        for paragraph in paragraphs:
            more, runs_ = vector(paragraph)
            exact = exact + more if sign > 0 else exact - more
            sketch = sketch + runs_ if sign > 0 else sketch - runs_
    return (exact.astype("<u8").tobytes() + sketch.astype("<u4").tobytes()).hex()


def likeness(one: str, other: str) -> float:
    """Estimated share of common word runs, 0 to 1: twice the common ones by all; 1 if equal."""
    if one == other:
        return 1.0
    a, b = (_lanes(x)[1].astype("<i4").astype(np.float64) for x in (one, other))
    both = a @ a + b @ b
    return float(min(1.0, max(0.0, 2 * (a @ b) / both))) if both else 0.0


def _lanes(print_: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(print_)
    return np.frombuffer(raw[: 8 * EXACT], dtype="<u8"), np.frombuffer(raw[8 * EXACT :], dtype="<u4")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint of every whole text.

    A null text is empty, and an empty text is one empty paragraph. Repeated rows and rows without
    a doc_id each give a row; an empty table gives none; other columns are ignored.
    """
    texts = whole_texts(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(map(len, held), pa.int64()),
                    pa.array(map(fingerprint, held), pa.string()),
                ],
                ["doc_id", "n_chars", "fingerprint"],
            )

    return texts.mapInArrow(work, f"doc_id {id_type}, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by the start of another."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


def against_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to each other and to the
    next document's: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.

    The next document is the one behind by ascending doc_id (a whole number), the first one behind
    the last. Rows without a doc_id come before all others; rows of one doc_id follow each other by
    a hash of their texts. A single document follows itself.
    """
    return following(docs, id_col, text_col).mapInArrow(_compared, _COMPARED)


_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def following(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents dealt to ranges of doc_id and sorted in them: range, borrowed, doc_id, text.

    Each range ends with a borrowed row, the first one of the next range, so every document's
    successor stands in its own range. Texts move once; only the ranges' borders and their least
    ids, a few numbers per partition, pass the driver.
    """
    spark = docs.sparkSession
    texts = whole_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = texts.select("doc_id")
    cuts = ids.stat.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    splits = [float("-inf"), *sorted(set(cuts) or {0.0}), float("inf")]
    texts = texts.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    dealt = Bucketizer(splits=splits, inputCol="place", outputCol="range").transform(texts)
    dealt = dealt.select(F.col("range").cast("int").alias("range"), "doc_id", "text")
    least = dealt.groupBy("range").agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("has_null")
    )
    firsts = sorted((r["range"], r["least"], r["has_null"]) for r in least.collect())
    first_rows = [
        (lower, None if has_null else first, firsts[i - 1][0])
        for i, (lower, first, has_null) in enumerate(firsts)
    ]
    borders = spark.createDataFrame(first_rows, "range int, doc_id long, into int")
    lent = dealt.alias("d").join(
        F.broadcast(borders.alias("b")),
        (F.col("d.range") == F.col("b.range")) & F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")),
    )
    lent = lent.select(F.col("b.into").alias("range"), F.lit(1).alias("borrowed"), "d.doc_id", "d.text")
    own = dealt.select("range", F.lit(0).alias("borrowed"), "doc_id", "text")
    both = own.unionByName(lent).repartition(F.col("range"))
    order = ["range", "borrowed", F.asc_nulls_first("doc_id"), F.xxhash64("text"), "text"]
    return both.sortWithinPartitions(*order)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk sorted rows with the row before at hand."""
    before = None
    done: list[tuple] = []
    for batch in slices(batches):
        columns = (batch.column(name).to_pylist() for name in ("range", "borrowed", "doc_id", "text"))
        for range_, borrowed, doc_id, text in zip(*columns):
            print_ = fingerprint(text) if before is None or not before[1] or not borrowed else None
            if before is not None and not before[1] and before[0] == range_:
                done.append(_row(*before[2:], text, print_))
            before = (range_, borrowed, doc_id, text, print_)
        if done:
            yield _batch(done)
            done = []


def _row(doc_id, text: str, print_: str, next_text: str, next_print: str) -> tuple:
    changed_text = edited(text, next_text)
    changed_print = fingerprint(changed_text)
    digest = hashlib.sha256(changed_text.encode("utf-8")).hexdigest()
    near = likeness(print_, changed_print), likeness(print_, next_print)
    return doc_id, len(text), digest, print_, changed_print, *near


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in _COMPARED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names
    )
