"""Runs of words that repeat with a period, found through string synchronising sets.

A run is a stretch of words with smallest period q that is at least ``LEAST`` words and ``TIMES`` periods
long and that no neighbouring word extends. Scales are powers of two. At scale t, a place is highly periodic
when the t words from it have a period of at most t/3; a place i is in the synchronising set when the least
hash of t words among the places i to i+t that are not highly periodic stands at i or at i+t. Whether it is
depends on the 2t words from i alone, so equal contexts are selected alike, and a stretch without selected
places is highly periodic throughout. Hence every run of a period from 1.5t up to 3t holds a selected place i
such that i plus the period is selected too, with the same 2t words: selected places of equal context propose
their distances as periods. Up to nine of them can lie within one period, so each is paired with that many
successors. Each proposal is extended word by word, so hashes select but never decide.

Small periods are left out by the sets and detected first, by comparing the text with itself moved by 1 to
``LEAST // TIMES`` words; with the runs of smaller scales they also tell which places are highly periodic.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from monthspan.llm.shared import mixed, slices, whole_texts

LEAST = 24
TIMES = 3

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
_RUNS = "array<struct<start: long, length: long, period: long>>"
_RUN_TYPE = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the collapsed text: words joined by one space,
    without those that a run contains after its first period.

    Words are what stands between ASCII white space. A null, empty or blank text has no words, no runs and
    an empty collapsed text. Repeated rows and rows without a doc_id each give a row; an empty table gives
    none; other columns are ignored. Each document is worked on for itself, so nothing is shuffled; a task
    holds one slice of texts, or one long text.
    """
    texts = whole_texts(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [text.encode().split() for text in batch.column("text").to_pylist()]
            found = runs_of(words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(map(len, words), pa.int64()),
                    pa.array(found, _RUN_TYPE),
                    pa.array(map(collapsed, words, found), pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return texts.mapInArrow(work, f"doc_id {id_type}, n_words long, runs {_RUNS}, collapsed string")


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run contains after its first period."""
    if runs:
        dropped = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            dropped[start + period] += 1
            dropped[start + length] -= 1
        words = compress(words, (np.cumsum(dropped[:-1]) == 0).tolist())
    return b" ".join(words).decode()


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, by start, then period."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    long_enough = [i for i, words in enumerate(texts) if len(words) >= LEAST]
    if not long_enough:
        return found
    # One row of numbers for all texts. What ends a text is no word and occurs once, so no run holds it.
    lengths = np.array([len(texts[i]) + 1 for i in long_enough], dtype=np.int64)
    words = chain.from_iterable((*texts[i], b" %d" % i) for i in long_enough)
    row = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=int(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    all_runs = _runs(row, lengths)
    owners = np.searchsorted(starts, [start for start, _, _ in all_runs], "right") - 1
    for owner, (start, length, period) in zip(owners.tolist(), all_runs):
        found[long_enough[owner]].append((start - int(starts[owner]), length, period))
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in found]


def _runs(row: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    cubes = _small(row)  # stretches of at least three periods, whatever their length
    scale = 1
    while 3 * scale <= 2 * (LEAST // TIMES + 1):
        scale *= 2
    scale //= 2
    places = np.arange(len(row))  # where the words still looked at stand in the whole row
    whole, hashes, width = row, mixed(row.astype(np.uint64) * _FACTOR), 1
    while True:
        lowest = (3 * scale + 1) // 2
        enough = lengths > TIMES * lowest
        if not enough.any():
            break
        if enough.mean() < 1 and lengths[enough].sum() <= 0.7 * len(row):
            # Shorter texts can hold no period of this scale or a larger one.
            held = np.repeat(enough, lengths)
            hashes = hashes[held[: len(hashes)]]
            row, places, lengths = row[held], places[held], lengths[enough]
        while width < scale:
            hashes, width = _doubled(hashes, width), 2 * width
        twice = _doubled(hashes, scale)
        if not len(twice):
            break
        selected = _selected(hashes, scale, _periodic(cubes, places, scale, len(hashes)))
        proposals = _proposed(selected, twice, scale, lowest, 3 * scale)
        cubes += [
            (int(places[start]), length, period)
            for start, length, period in _extended(row, proposals)
            if length >= TIMES * period
        ]
        hashes, width, scale = twice, 2 * scale, 2 * scale
    return _primitive(cubes, len(whole))


def _doubled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of 2 * width words from those of width words."""
    return mixed(hashes[:-width] * _FACTOR + hashes[width:])


def _small(row: np.ndarray) -> list[tuple[int, int, int]]:
    """Stretches of at least three periods of up to LEAST // TIMES words."""
    found = []
    for period in range(1, min(LEAST // TIMES, len(row) - 1) + 1):
        equal = (row[period:] == row[:-period]).view(np.int8)
        change = np.flatnonzero(np.diff(equal, prepend=0, append=0))
        starts, ends = change[::2], change[1::2] + period
        held = ends - starts >= TIMES * period
        found += [(a, b - a, period) for a, b in zip(starts[held].tolist(), ends[held].tolist())]
    return found


def _periodic(cubes: list, places: np.ndarray, scale: int, n: int) -> np.ndarray:
    """Is the place highly periodic: do ``scale`` words from it have a period of a third at most?"""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in cubes:
        if 3 * period <= scale <= length:
            # The texts left out are left out whole, so a stretch is moved as one.
            at = int(np.searchsorted(places, start))
            if at < len(places) and places[at] == start and at < n:
                edges[at] += 1
                edges[min(n, at + length - scale + 1)] -= 1
    return np.cumsum(edges[:-1]) > 0


def _selected(hashes: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Places of the synchronising set."""
    values = np.where(periodic, _NEVER, hashes)
    least, width = values, 1
    while width < scale:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:-1], values[scale:])
    at_an_end = (least == values[:-scale]) | (least == values[scale:])
    return np.flatnonzero(at_an_end & (least != _NEVER))


def _proposed(
    selected: np.ndarray, contexts: np.ndarray, scale: int, lowest: int, end: int
) -> np.ndarray:
    """(period, place) pairs, sorted: distances from ``lowest`` to before ``end`` of selected places of equal
    context."""
    keys = contexts[selected]
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], selected[order]
    same = np.flatnonzero(keys[1:] == keys[:-1])
    pairs = []
    # Contexts that overlap by more would be highly periodic and not selected.
    for step in range(1, end // (scale // 3 + 1) + 1):
        same = same[same + step < len(keys)]
        same = same[keys[same] == keys[same + step]]
        if not len(same):
            break
        distance = at[same + step] - at[same]
        fits = (distance >= lowest) & (distance < end)
        pairs.append(np.stack([distance[fits], at[same[fits]]], axis=1))
        same = same[distance < end]
    found = np.concatenate(pairs) if pairs else np.empty((0, 2), dtype=np.int64)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def _extended(row: np.ndarray, proposals: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The stretch of each proposal, once each."""
    last_period, last_end = 0, -1
    for period, place in proposals.tolist():
        if period == last_period and place < last_end:
            continue
        matched = _agreeing(row[place : len(row) - period], row[place + period :])
        before = _agreeing(row[:place][::-1], row[period : place + period][::-1])
        last_period, last_end = period, place + matched
        yield place - before, before + matched + period, period


def _agreeing(one: np.ndarray, other: np.ndarray) -> int:
    """How many of the first values are equal."""
    done, width, n = 0, 64, min(len(one), len(other))
    while done < n:
        differ = one[done : done + width] != other[done : min(n, done + width)]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, width = done + len(differ), 2 * width
    return n


def _primitive(cubes: list, n: int) -> list[tuple[int, int, int]]:
    """Long enough stretches with their smallest periods. With three periods in it, a stretch's smallest
    period divides the others and spans the same words."""
    smallest: dict[tuple[int, int], int] = {}
    for start, length, period in cubes:
        if length >= LEAST:
            key = (start, length)
            smallest[key] = min(period, smallest.get(key, n))
    return [(start, length, period) for (start, length), period in smallest.items()]
