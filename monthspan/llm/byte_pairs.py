"""Byte-level BPE by overlapping chunks.

A long text is cut into chunks that overlap. The chunks are written to the shared folder in small row groups, so
that one giant text is read and worked on by many tasks. Each chunk is cut into pre-tokens from its own beginning, which may lie inside one. The pattern
looks ahead but never back, so once two chunks have a border of pre-tokens at the same place, they agree from there
on: within each overlap the first common border is where they are stitched. Borders near a chunk's end, which what
follows could change, do not count. Where an overlap has no common border, because one pre-token covers it, the
chunks on both sides are put together and cut anew. The pre-tokens between two stitches are then encoded, each
different one once per worker, and a text's ids are those of its chunks in order. Decoding puts the ids' bytes
together.

What counts as a letter or number is asked of the ``tiktoken`` library: its tables are older than those of the
``regex`` module, which does the cutting.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthspan.llm.shared import Cache, saved, slices, whole_texts
from monthspan.sources.stages import scratch_dir

# Characters of a chunk, and those of the next one that it has besides.
CHUNK = 16_384
OVERLAP = 512
# Characters behind a pre-token that the pattern may have looked at: a white space and what follows it, or the
# two letters of a contraction.
AHEAD = 3
# Bytes of a row group of written chunks, and rows of five numbers that are broadcast at most.
ROW_GROUP = 8 << 20
MOST_BROADCAST = 500_000
# Pre-tokens whose ids a worker remembers.
REMEMBERED = 200_000

_CHUNKS = "row long, doc_id {id}, chunk long, last boolean, own string, more string"
_CUT = "row long, chunk long, head array<int>, tail array<int>"
_PART = "row long, doc_id {id}, chunk long, ids binary"


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit integers, and back."""

    def __init__(self, vocabulary: str, pattern: str = public_tokenizers.PATTERN):
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes = dict(map(reversed, ranks.items()))
        # A pre-token is one match.
        self.library = tiktoken.Encoding("pieces", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.known = Cache(None, REMEMBERED)
        self.pattern = regex.compile(pattern)
        self.late = _late_characters()

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text that begins where one begins."""
        if text.isascii():
            return self.pattern.findall(text)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        late = self.late[codes]
        if not late.any():
            return self.pattern.findall(text)
        # What the library knows neither as letter nor number is a mark to it, like the section sign.
        known = np.where(late, ord("§"), codes).astype("<u4").tobytes().decode("utf-32-le")
        ends = [0, *accumulate(map(len, self.pattern.findall(known)))]
        return [text[a:b] for a, b in zip(ends, ends[1:])]

    def encoded(self, cut: list[list[str]]) -> list[bytes]:
        """The ids of texts that are cut into pre-tokens."""
        self.known.room()
        new = self.known.missing(cut)
        encode = self.library.encode_ordinary
        self.known.update((piece, array("I", encode(piece)).tobytes()) for piece in new)
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encoded(list(map(self.pieces, texts)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=1)
def _late_characters() -> np.ndarray:
    """For each code point: does only the ``regex`` module take it for a letter or number?"""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    single = {bytes([i]): i for i in range(256)}
    late = np.zeros(sys.maxunicode + 1, dtype=bool)
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        known = tiktoken.Encoding("kind", pat_str=f"{kind}+", mergeable_ranks=single, special_tokens={})
        own = set(regex.findall(kind, every))
        theirs = set(known.decode(known.encode_ordinary(every)))
        if theirs - own or (kind == r"\s" and own != theirs):
            raise ValueError("the regex module has older tables of characters than the tokenizer library")
        late[[ord(c) for c in own - theirs]] = True
    return late


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    """One per Python worker, which works on many tasks."""
    return Encoder(vocabulary)


def encode(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and decoded (the bytes that the ids stand
    for) of every whole text, without special tokens.

    ``vocabulary`` is the path of a file of base64 tokens and ranks, the same on every machine. A null text is
    empty and has no ids. Repeated rows and rows without a doc_id each give a row; an empty table gives none; other
    columns are ignored.
    """
    return _encoded(docs, vocabulary, id_col, text_col, chunk, overlap, digests=False)


def digests(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """As ``encode``, but with SHA-256 digests (ids_sha256, decoded_sha256), a fraction of the ids' size."""
    return _encoded(docs, vocabulary, id_col, text_col, chunk, overlap, digests=True)


def _encoded(
    docs: DataFrame, path: str, id_col: str, text_col: str, chunk: int, overlap: int, digests: bool
) -> DataFrame:
    if not AHEAD < overlap <= chunk:
        raise ValueError("an overlap is longer than what the pattern looks at, and no longer than a chunk")
    texts = whole_texts(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    kind = "string" if digests else "binary"
    result = f"doc_id {id_type}, n_tokens long, {names[0]} {kind}, {names[1]} {kind}"

    def rows(ids: list[bytes], owners: pa.Array, encoder: Encoder) -> pa.RecordBatch:
        values = [ids, map(encoder.decode, ids)]
        if digests:
            values = [[hashlib.sha256(value).hexdigest() for value in column] for column in values]
        columns = [pa.array(column, pa.string() if digests else pa.binary()) for column in values]
        n = pa.array([len(i) // 4 for i in ids], pa.int64())
        return pa.RecordBatch.from_arrays([owners, n, *columns], ["doc_id", "n_tokens", *names])

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in slices(batches):
            ids = encoder.encode(batch.column("text").to_pylist())
            yield rows(ids, batch.column("doc_id"), encoder)

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts in order to whole texts; of a text only its last part is held, or sums of all."""
        encoder, text = _encoder(path), None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.column("row")[i].as_py()
                if text is None or text.row != row:
                    if text is not None:
                        yield text.end()
                    text = _Whole(row, batch.column("doc_id").slice(i, 1), names, digests)
                ids = batch.column("ids")[i].as_py()
                text.add(ids, encoder.decode(ids))
        if text is not None:
            yield text.end()

    short = texts.filter(F.length("text") <= chunk).mapInArrow(at_once, result)
    parts = _parts(texts.filter(F.length("text") > chunk), path, id_type, chunk, overlap)
    ordered = parts.repartition("row").sortWithinPartitions("row", "chunk")
    return short.union(ordered.mapInArrow(in_order, result))


class _Whole:
    """A text put together from its parts, or the digests of such a text."""

    def __init__(self, row: int, owner: pa.Array, names: list[str], digests: bool):
        self.row, self.owner, self.names, self.n = row, owner, names, 0
        self.sums = [hashlib.sha256(), hashlib.sha256()] if digests else None
        self.held: tuple[list, list] = ([], [])

    def add(self, *values: bytes) -> None:
        self.n += len(values[0]) // 4
        for i, value in enumerate(values):
            if self.sums:
                self.sums[i].update(value)
            else:
                self.held[i].append(value)

    def end(self) -> pa.RecordBatch:
        values = [s.hexdigest() for s in self.sums] if self.sums else [b"".join(held) for held in self.held]
        kind = pa.string() if self.sums else pa.binary()
        columns = [pa.array([value], kind) for value in values]
        n = pa.array([self.n], pa.int64())
        return pa.RecordBatch.from_arrays([self.owner, n, *columns], ["doc_id", "n_tokens", *self.names])


def _parts(long: DataFrame, path: str, id_type: str, chunk: int, overlap: int) -> DataFrame:
    """Long texts' ids, part by part: row, doc_id, chunk, ids."""
    spark = long.sparkSession
    directory = scratch_dir(spark, "byte-pair-chunks")
    # Small row groups, so that the chunks of one giant text are read by many tasks.
    chunked(long, chunk, overlap).write.option("parquet.block.size", ROW_GROUP).parquet(directory)
    chunks = spark.read.parquet(directory)
    cut = chunks.mapInArrow(lambda batches: _cut(batches, path, chunk, overlap), _CUT)
    found = saved(stitches(cut, chunk), "byte-pair-stitches")
    regular = chunks.join(_small(found.filter("size = 1")), ["row", "chunk"])
    regular = regular.select("row", "doc_id", "chunk", "own", "more", "begin", "end")
    schema = _PART.format(id=id_type)
    encoded = lambda batches: _encode_parts(batches, path)
    parts = regular.mapInArrow(encoded, schema)
    together = found.filter("size > 1")
    if together.isEmpty():
        return parts
    # Chunks without a common border go together, from the last stitch before them to the first one behind.
    joined = chunks.join(_small(together), ["row", "chunk"]).groupBy("row", "first").agg(
        F.any_value("doc_id").alias("doc_id"),
        F.array_sort(F.collect_list(F.struct("chunk", "own", "more", "begin", "end"))).alias("chunks"),
    )
    ending = F.element_at("chunks", -1)
    joined = joined.select(
        "row",
        "doc_id",
        F.col("first").alias("chunk"),
        F.array_join(F.transform("chunks", lambda c: c["own"]), "").alias("own"),
        ending["more"].alias("more"),
        F.element_at("chunks", 1)["begin"].alias("begin"),
        (ending["end"] + chunk * (F.size("chunks") - 1)).alias("end"),
    )
    return parts.union(joined.mapInArrow(encoded, schema))


def _small(rows: DataFrame) -> DataFrame:
    """Rows of a written table for a join, broadcast if their number has been found to be small."""
    few = rows.select("row", "chunk", "begin", "end", "first")
    return F.broadcast(few) if rows.count() <= MOST_BROADCAST else few


def chunked(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Rows of chunks: row, doc_id, chunk (its number), last, own (its text) and more (the
    beginning of the next one)."""
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    rows = long.select(F.monotonically_increasing_id().alias("row"), "doc_id", pieces.alias("pieces"))
    places = F.posexplode("pieces").alias("chunk", "own")
    ahead = F.transform("pieces", lambda piece: F.left(piece, F.lit(overlap)))
    rows = rows.select("row", "doc_id", F.size("pieces").alias("n"), ahead.alias("ahead"), places)
    return rows.select(
        "row",
        "doc_id",
        F.col("chunk").cast("long").alias("chunk"),
        (F.col("chunk") == F.col("n") - 1).alias("last"),
        "own",
        F.coalesce(F.get("ahead", F.col("chunk") + 1), F.lit("")).alias("more"),
    )


def _cut(batches: Iterator[pa.RecordBatch], path: str, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """Borders of pre-tokens in each chunk's first characters, and in those that it shares with the next chunk,
    counted from there."""
    encoder = _encoder(path)
    for batch in slices(batches):
        heads, tails = [], []
        for last, own, more in zip(*(batch.column(c).to_pylist() for c in ("last", "own", "more"))):
            ends = np.array([0, *accumulate(map(len, encoder.pieces(own + more)))])
            certain = ends if last else ends[ends + AHEAD <= len(own) + len(more)]
            heads.append(certain[certain < overlap].tolist())
            tails.append((certain[certain >= chunk] - chunk).tolist())
        keys = [batch.column("row"), batch.column("chunk")]
        values = [pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([*keys, *values], ["row", "chunk", "head", "tail"])


def stitches(cut: DataFrame, chunk: int) -> DataFrame:
    """For each chunk where it begins and ends (null: with the text's end), counted from its first character, the
    first chunk that it goes together with, and how many go together."""
    in_text = Window.partitionBy("row").orderBy("chunk")
    common = F.array_intersect("tail", F.lead("head").over(in_text))
    rows = cut.withColumn("stitch", F.array_min(common))
    before = F.lag("stitch").over(in_text)
    starts = before.isNotNull() | (F.col("chunk") == 0)
    rows = rows.select(
        "row",
        "chunk",
        F.coalesce(before, F.lit(0)).alias("begin"),
        (F.col("stitch") + chunk).alias("end"),
        F.max(F.when(starts, F.col("chunk"))).over(in_text).alias("first"),
    )
    return rows.withColumn("size", F.count("*").over(Window.partitionBy("row", "first")))


def _encode_parts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    for batch in slices(batches):
        parts = batch.select(["own", "more", "begin", "end"]).to_pylist()
        ids = encoder.encoded([_part(encoder, **part) for part in parts])
        keys = [batch.column(c) for c in ("row", "doc_id", "chunk")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(ids, pa.binary())], ["row", "doc_id", "chunk", "ids"])


def _part(encoder: Encoder, own: str, more: str, begin: int, end: int | None) -> list[str]:
    """The pre-tokens from one stitch to the next; what follows the second one is only looked at."""
    text = own + more
    pieces = encoder.pieces(text[begin:])
    ends = list(accumulate(map(len, pieces), initial=begin))
    return pieces[: ends.index(len(text) if end is None else end)]
