"""Packing of documents into training sequences by power-of-two decomposition.

A document of n token ids (its text's ids and one end id) is cut from its start into as many pieces
of ``longest`` ids as fit, and the rest into one piece per set bit of its length, longest first.
Each piece is a sequence by itself: its length is a power of two, so it is not padded, and no
sequence crosses documents. Pieces of equal length share a bucket, from which batches are drawn.

Packing needs no shuffle: a document's pieces depend on that document alone.
"""

from __future__ import annotations

import gc
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthspan.llm.shared import Cache, slices, whole_texts

LONGEST = 2048
# Words whose ids a worker remembers.
REMEMBERED = 1_000_000
END_ID = 1

_PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, bucket int, ids binary"
)
# Letters before this one have a small form and a normal form that depend on nothing beside them.
_LATIN_END = "\u0130"
# Marks that the vocabulary's rule for words never joins to the letters before them.
_CLOSING = frozenset(".,;:!?|)")


def pack(
    docs: DataFrame,
    vocabulary: str,
    longest: int = LONGEST,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket
    (the power of two) and, with ``keep_ids``, ids (little-endian unsigned 32-bit integers).

    ``vocabulary`` is the path of a file of the ``tokenizers`` library, the same on every machine.
    A null or empty text is a document of one id, the end id. Repeated rows and rows without a
    doc_id are packed each for itself. An empty table gives no rows. Other columns are ignored.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    texts = whole_texts(docs, id_col, text_col)
    schema = _PIECES.format(id=texts.schema["doc_id"].dataType.simpleString())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(vocabulary)
        gc.disable()  # nothing here refers to itself, and each pass over the cached words costs
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches):
            rows, owners = [], []
            for owner, ids in enumerate(words.encode(batch.column("text").to_pylist())):
                ids += end
                n = len(ids) // 4
                for start, length in pieces(n, longest):
                    piece = ids[4 * start : 4 * (start + length)]
                    bucket = length.bit_length() - 1
                    rows.append((start, length, zlib.crc32(piece), n, bucket, piece if keep_ids else None))
                    owners.append(owner)
            starts, lengths, sums, totals, buckets, parts = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owners, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(buckets, pa.int32()),
                    pa.array(parts, pa.binary()),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bucket", "ids"],
            )

    packed = texts.mapInArrow(work, schema).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "bucket",
        "ids",
    )
    return packed if keep_ids else packed.drop("ids")


def write_buckets(packed: DataFrame, directory: str) -> None:
    """One folder per length, so that a training batch reads sequences of one length."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(directory)


def pieces(n: int, longest: int) -> Iterator[tuple[int, int]]:
    """Starts and lengths of a document's pieces, in order."""
    start = 0
    while start < n:
        length = min(longest, 1 << ((n - start).bit_length() - 1))
        yield start, length
        start += length


class WordIds:
    """Whole texts to ids, as bytes, batch by batch.

    This kind of vocabulary drops white space and never joins across it, so a text's ids are those
    of its words, and each different word is encoded once per worker.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(vocabulary)
        self.words = Cache(None, REMEMBERED)
        self.parts = Cache(None)
        # How the vocabulary writes letters beyond ASCII.
        split = self.library.pre_tokenizer.pre_tokenize_str
        letters = [c for c in map(chr, range(0x80, ord(_LATIN_END))) if c.isalpha()]
        self.written = {ord(c): "".join(piece for piece, _ in split(c)) for c in letters}
        self._check()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [text.replace("\n", " ").split(" ") for text in texts]
        self.words.room()
        self.parts.room()
        new = self.words.missing(split)
        cut = list(map(_parts, new))
        self.parts.update(self._encoded(self.parts.missing(cut)))
        ids = self.parts.__getitem__
        self.words.update((w, ids(p[0]) if len(p) == 1 else ids(p[0]) + ids(p[1])) for w, p in zip(new, cut))
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def _encoded(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of new parts. Parts of Latin letters are whole words in their normal form, so they go to the merges
        at once, written as the vocabulary writes their bytes; the library does all steps for the others."""
        tokenize, written, others = self.library.model.tokenize, self.written, []
        for part in parts:
            if not part.isalpha():
                others.append(part)
                continue
            spelled = part
            if not part.isascii():
                if max(part) >= _LATIN_END:
                    others.append(part)
                    continue
                spelled = part.translate(written)
            yield part, array("I", [token.id for token in tokenize(spelled)]).tobytes()
        yield from zip(others, map(bytes, self._library(others)))

    def _check(self) -> None:
        """Words of every Latin letter must come out alike both ways."""
        letters = [c for c in map(chr, range(ord(_LATIN_END))) if c.isalpha() and c == c.lower()]
        words = [a + b for a in letters for b in ("", "e", "tion", "übers", "s" + a)]
        if [ids for _, ids in self._encoded(words)] != list(map(bytes, self._library(words))):
            raise ValueError("the vocabulary doesn't merge Latin words as they are written")

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]


def _parts(word: str) -> tuple[str, ...]:
    """A word as the vocabulary sees it: small letters, and a closing mark behind letters by itself.

    Only for plain Latin letters, whose small form and composition depend on nothing beside them.
    """
    if word and (word.isascii() or max(word) < _LATIN_END):
        if word.isalpha():
            return (word.lower(),)
        if word[-1] in _CLOSING and word[:-1].isalpha():
            return (word[:-1].lower(), word[-1])
    return (word,)
