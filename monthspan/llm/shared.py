"""What several operators need: scratch tables, Arrow batches cut at group borders, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthspan.sources.stages import scratch_dir

# Entries that a worker's word cache holds at most; a memory bound, not a limit on input.
CACHE_ENTRIES = 700_000
# Rows of an Arrow batch that are worked on at once.
SLICE_ROWS = 512

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def saved(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: its lineage is cut, and any
    executor can be lost without recomputing it."""
    path = scratch_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def whole_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id and text alone, whatever else the table holds; a null text is empty."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a worker holds few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def runs(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of sorted rows: a table and the offsets at which its groups start and end.

    Rows of one key must follow each other. A group that goes on in the next batch waits for it,
    so memory holds one batch and one group.
    """
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*waiting, batch])
        offsets = _offsets(table, keys)
        last = offsets[-2]
        if last:
            yield table.slice(0, last), offsets[:-1]
        waiting = table.slice(last).to_batches()
    if waiting:
        table = pa.Table.from_batches(waiting)
        yield table, _offsets(table, keys)


def _offsets(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows - 1, dtype=bool)
    for key in keys:
        column = table.column(key).to_numpy()
        change |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])


class Cache(dict):
    """Values worked out on first use. When half full it becomes the older half, which is asked
    before a value is worked out again and is dropped when the next half is full."""

    def __init__(self, make: Callable, entries: int = CACHE_ENTRIES):
        super().__init__()
        self._make, self._half, self._older = make, entries // 2, {}

    def room(self) -> None:
        if len(self) >= self._half:
            self._older = dict(self)
            self.clear()

    def new(self, keys) -> list:
        """Those keys whose values are not known in either half."""
        keys = {key for key in keys if key not in self}
        for key in [key for key in keys if key in self._older]:
            self[key] = self._older[key]
            keys.discard(key)
        return list(keys)

    def missing(self, lists: list) -> list:
        """The keys in lists whose values are not known in either half."""
        keys = list(filterfalse(self.__contains__, set().union(*lists)))
        if self._older:
            held = list(filter(self._older.__contains__, keys))
            self.update(zip(held, map(self._older.__getitem__, held)))
            keys = list(filterfalse(self._older.__contains__, keys))
        return keys

    def __missing__(self, key):
        self.room()
        value = self[key] = self._older[key] if key in self._older else self._make(key)
        return value


# A hash is quickly made again, so only frequent words need to be held.
WORD_HASHES = Cache(lambda word: xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")), 60_000)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    h = (h ^ (h >> np.uint64(30))) * _MIX_1
    h = (h ^ (h >> np.uint64(27))) * _MIX_2
    return h ^ (h >> np.uint64(31))


def shingles(words: list[str], size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, repeats included; fewer words make one run."""
    hashes = np.fromiter(map(WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    return combined(hashes, size)


def combined(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` values; a shorter row is one run."""
    n = max(1, len(hashes) - size + 1)
    width = min(size, len(hashes))
    out = np.full(n, len(hashes) if width < size else size, dtype=np.uint64)
    for j in range(width):
        out = out * _FACTOR + hashes[j : j + n]
    return mixed(out)


def paragraph_shingles(paragraphs: list[str], size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words that lie in one paragraph; a shorter paragraph with a
    word in it makes one run."""
    words = [paragraph.split() for paragraph in paragraphs]
    lengths = np.array([len(w) for w in words if w], dtype=np.int64)
    flat = [word for paragraph in words for word in paragraph]
    if not flat:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(WORD_HASHES.__getitem__, flat), dtype=np.uint64, count=len(flat))
    ends = np.cumsum(lengths)
    found = []
    if len(flat) >= size:
        inside = np.ones(len(flat) - size + 1, dtype=bool)
        for j in range(1, size):
            borders = ends[:-1] - j
            inside[borders[(borders >= 0) & (borders < len(inside))]] = False
        found.append(combined(hashes, size)[inside])
    for length, end in zip(lengths, ends):
        if length < size:
            found.append(combined(hashes[end - length : end], size))
    return np.concatenate(found)
