"""Encoding and decoding with a merge-type SentencePiece vocabulary.

The encoder is an agenda of adjacent symbol pairs: the pair whose joined symbol has the best score
is merged first, the leftmost one among equals, and each merge puts the new neighbours on the agenda.
A text is first cut where no piece of the vocabulary can lie across the cut, which leaves the result
as it is, so each different segment is encoded once per worker. In every Arrow batch the segments
that are new are checked against the ``sentencepiece`` library, which also decodes the ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from monthspan.llm.shared import Cache, slices, whole_texts

SPACE = "▁"
# Ways to cut a text, finest first; the first one that cuts no piece of the vocabulary is used.
# Segments up to this length keep their agenda in a list, longer ones in a heap; the order is the same.
SHORT = 24
NEVER = float("inf")
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_CUTS = (
    rf"{SPACE}*[{_LATIN}]+|\n|{SPACE}*[^{SPACE}\n{_LATIN}]+|{SPACE}+",
    rf"{SPACE}*[^{SPACE}]+|{SPACE}+",
    r"(?s:.+)",
)


class Vocabulary:
    """Pieces, scores and kinds of a model file, and the library's own processor."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        self.begin, self.end, self.unknown = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.ids: dict[str, int] = {}
        self.place: dict[str, float] = {}  # in the order of scores
        self.bytes: dict[int, int] = {}
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece], self.place[piece] = i, -lib.get_score(i)
        self.cut = next(c for c in map(lambda c: re.compile(c, re.S), _CUTS) if self._whole(c))

    def _whole(self, cut: re.Pattern) -> bool:
        return all(cut.findall(piece) == [piece] for piece in self.ids)

    def segments(self, text: str) -> list[str]:
        """The text in escaped form, as the library makes it, cut."""
        return self.cut.findall((SPACE + text).replace(" ", SPACE)) if text else []

    def encode(self, segment: str) -> list[int]:
        """Ids of a segment by the agenda."""
        symbols = self._short(segment) if len(segment) <= SHORT else self._long(segment)
        ids: list[int] = []
        for symbol in symbols:
            if symbol in self.ids:
                ids.append(self.ids[symbol])
            elif self.bytes:
                ids.extend(self.bytes[b] for b in symbol.encode("utf-8"))
            else:
                ids.append(self.unknown)
        return ids

    def _short(self, segment: str) -> list[str]:
        """The agenda as a list by place: its least entry is the next merge."""
        place, symbols = self.place, list(segment)
        agenda = [place.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del agenda[i]
            if i:
                agenda[i - 1] = place.get(symbols[i - 1] + symbols[i], NEVER)
            if i < len(agenda):
                agenda[i] = place.get(symbols[i] + symbols[i + 1], NEVER)
        return symbols

    def _long(self, segment: str) -> list[str]:
        """The agenda as a heap; an entry whose symbols have been merged meanwhile is passed over."""
        place, symbols = self.place, list(segment)
        last = len(symbols)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        pairs = (a + b for a, b in zip(symbols, symbols[1:]))
        agenda = [(place[pair], left, pair) for left, pair in enumerate(pairs) if pair in place]
        heapify(agenda)
        while agenda:
            _, left, joined = heappop(agenda)
            right = after[left]
            if right >= last or not symbols[left] or symbols[left] + symbols[right] != joined:
                continue
            symbols[left], symbols[right] = joined, ""
            after[left] = after[right]
            if after[left] < last:
                before[after[left]] = left
            for left in (before[left], left):
                if left >= 0 and after[left] < last:
                    pair = symbols[left] + symbols[after[left]]
                    if pair in place:
                        heappush(agenda, (place[pair], left, pair))
        return [symbol for symbol in symbols if symbol]

    def check(self, segments: list[str], ids: list[list[int]]) -> None:
        """Compare segments' ids with the library's, as lines of one text.

        No piece of the vocabulary holds a line break, so the lines don't affect each other.
        """
        lines = "".join("\n" + segment for segment in segments if segment != "\n")
        known = [i for segment, i in zip(segments, ids) if segment != "\n"]
        line_break = self.encode("\n")
        own = [*self.encode(SPACE), *(i for line in known for i in (*line_break, *line))]
        if lines and own != self.library.encode(lines):
            raise ValueError("the agenda and the library give different ids")


class Encoder:
    """Whole texts to ids, as bytes, batch by batch."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.known = Cache(lambda s: np.array(self.vocabulary.encode(s), dtype="<u4").tobytes())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids with begin and end, as little-endian unsigned 32-bit integers, for a batch of texts."""
        cut = [self.vocabulary.segments(text) for text in texts]
        self.known.room()
        new = self.known.new(s for segments in cut for s in segments)
        ids = [self.vocabulary.encode(s) for s in new]
        self.vocabulary.check(new, ids)
        self.known.update((s, np.array(i, dtype="<u4").tobytes()) for s, i in zip(new, ids))
        begin, end = (
            np.array([i], dtype="<u4").tobytes() for i in (self.vocabulary.begin, self.vocabulary.end)
        )
        return [begin + b"".join(map(self.known.__getitem__, segments)) + end for segments in cut]

    def decode(self, ids: list[bytes]) -> list[str]:
        lists = [np.frombuffer(i, dtype="<u4").tolist() for i in ids]
        return self.vocabulary.library.decode(lists, num_threads=1) if lists else []


def encode(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers, with begin and end) and the
    text that the ids decode to, for every whole text.

    ``vocabulary`` is the path of a model file, the same on every machine. A null text is empty: two
    ids, decoded to an empty text. Repeated rows and rows without a doc_id each give a row; an empty
    table gives none; other columns are ignored. A disagreement with the library is an error.
    """
    return _encoded(docs, vocabulary, id_col, text_col, digests=False)


def digests(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """As ``encode``, but with SHA-256 digests (ids_sha256, decoded_sha256) of ids and decoded text,
    which are a fraction of their size."""
    return _encoded(docs, vocabulary, id_col, text_col, digests=True)


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, digests: bool) -> DataFrame:
    texts = whole_texts(docs, id_col, text_col)
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    types = ["string", "string"] if digests else ["binary", "string"]
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, " + ", ".join(map(" ".join, zip(names, types)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in slices(batches):
            ids = encoder.encode(batch.column("text").to_pylist())
            decoded = encoder.decode(ids)
            n = [len(i) // 4 for i in ids]
            if digests:
                ids = [hashlib.sha256(i).hexdigest() for i in ids]
                decoded = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in decoded]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(ids, pa.string() if digests else pa.binary()),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "n_tokens", *names],
            )

    return texts.mapInArrow(work, schema)
