"""N-gram Jaccard join: which documents share at least a given part of their word n-grams.

A MinHash LSH forest. Every text becomes the set of its n-grams and a MinHash signature, which is cut
into the labels of ``TREES`` prefix tries. Documents meet where they share a prefix in a trie. The
prefixes start at their full length and are shortened, step by step, until the links found so far
say that the target recall is reached: a pair of likeness s shares a prefix of length d in one of
the tries with probability 1 - (1 - s^d)^trees, so each link found stands for the inverse of that.
Pairs that met are then verified on the n-gram sets themselves.

What keeps it bounded at any size:

* Texts with equal n-gram sets are one node with a weight, from the first aggregation on.
* A trie node of many documents is compared in pairs of blocks (``graph.blocked``).
* A pair belongs to the first trie in which it meets, so it is compared and counted once, and a task
  passes on sums per document and a spanning forest of its links, never the pairs.
* Only documents with a probable partner have their texts read again for verification.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthspan.llm.graph import blocked, components, least_reached, together
from monthspan.llm.shared import runs, saved, shingles, slices, whole_texts

WORDS = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 5
RECALL = 0.9999
BLOCK = 256

_SEED = np.random.default_rng(20)
_FACTORS = _SEED.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _SEED.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
# n-grams whose hashes are multiplied out at once.
_STEP = 4096
_KEYS = ["tree", "prefix"]


def ngram_set(text: str) -> np.ndarray:
    """Sorted hashes of the different n-grams of a text's words.

    Words are what stands between white space, in small letters. Fewer than ``WORDS`` words are one
    n-gram, the empty row of words included.
    """
    return np.unique(shingles(text.lower().split(), WORDS))


def signature(grams: np.ndarray) -> bytes:
    """MinHash values, 16 bits each, trie after trie."""
    h = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(h), _STEP):
        part = (h[None, start : start + _STEP] ^ _SHIFTS[:, None]) * _FACTORS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return mixed_low(least).astype("<u2").tobytes()


def mixed_low(values: np.ndarray) -> np.ndarray:
    """The low 16 bits after mixing; equal values stay equal."""
    values = (values ^ (values >> np.uint32(16))) * np.uint32(0x45D9F3B)
    return (values ^ (values >> np.uint32(16))) & np.uint32(0xFFFF)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Similarity classes: doc_id, class_id and n_links, one row per row of ``docs``.

    Two documents are linked when the Jaccard similarity of their n-gram sets is at least
    ``THRESHOLD``; a class is what links lead to, named by its least doc_id. n_links counts the
    other rows linked directly, copies among them.

    Null and empty texts are texts without words, which are copies of each other. Repeated rows are
    copies. Rows without a doc_id take part and have a null doc_id; a class of such rows only has a
    null class_id. An empty table gives no rows; other columns are ignored.
    """
    texts = whole_texts(docs, id_col, text_col)
    signed = _signed(texts)
    classes = _classes(texts, signed)
    names = classes.groupBy("component").agg(F.min("least").alias("class_id"))
    classes = classes.join(names, "component").select("node", "class_id", "n_links")
    rows = signed.select("doc_id", "node").join(classes, "node")
    return rows.select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each similarity class, with all its columns: the one with the least doc_id, then the least digest
    of its text.

    A row without a doc_id stays only where its class has no other. Rows of one doc_id with unrelated texts are of
    different classes, each of which keeps one. Rows that agree in doc_id and text are one; which of them stays is
    open. An empty table gives no rows; columns of any name are kept.
    """
    texts = whole_texts(docs, id_col, text_col).withColumn("key", F.md5("text"))
    signed = _signed(texts)
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    nodes = signed.groupBy("node").agg(F.min(row).alias("least"))
    found = _classes(texts.drop("key"), signed).select("node", "component")
    firsts = nodes.join(found, "node").groupBy("component").agg(F.min("least").alias("least"))
    copies = signed.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("copies"))
    firsts = firsts.select(F.col("least.doc_id").alias("doc_id"), F.col("least.key").alias("key")).alias("f")
    same = F.col("f.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("f.key") == F.col("c.key"))
    firsts = firsts.join(copies.alias("c"), same).select("f.doc_id", "f.key", "copies")
    firsts = saved(firsts, "ngram-firsts")
    key = F.md5(F.coalesce(F.col(f"d.`{text_col}`").cast("string"), F.lit("")))
    same = F.col(f"d.`{id_col}`").eqNullSafe(F.col("f.doc_id")) & (key == F.col("f.key"))
    rows = docs.alias("d").join(firsts.alias("f"), same)
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    # Only rows that are repeated move once more.
    repeated = rows.where("f.copies > 1").groupBy("f.doc_id", "f.key").agg(F.first(F.struct(*columns)).alias("row"))
    repeated = repeated.select(*[F.col(f"row.`{c}`") for c in docs.columns])
    return rows.where("f.copies = 1").select(*columns).unionByName(repeated)


def _classes(texts: DataFrame, signed: DataFrame) -> DataFrame:
    """node, its least doc_id, links of each of its rows, and component."""
    nodes = signed.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size"), F.first("sig").alias("sig")
    )
    nodes = saved(nodes, "ngram-nodes")
    near = _verified(texts, nodes, _meeting(nodes))
    links = near.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(near.select(F.col("node").alias("a"), F.col("root").alias("b")), "ngram")
    classes = nodes.select("node", "least", "size").join(links, "node", "left").join(found, "node", "left")
    return classes.select(
        "node",
        "least",
        (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component"),
    )


def _signed(texts: DataFrame) -> DataFrame:
    """doc_id, node (a digest of the n-gram set) and signature, and the text's key if there is one."""
    own = [c for c in texts.columns if c != "text"]
    schema = "".join(f"{c} {texts.schema[c].dataType.simpleString()}, " for c in own)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [ngram_set(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in own],
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array(map(signature, sets), pa.binary()),
                ],
                [*own, "node", "sig"],
            )

    return saved(texts.mapInArrow(work, schema + "node binary, sig binary"), "ngram-signed")


def _meeting(nodes: DataFrame) -> DataFrame:
    """Nodes that probably have a partner, by pair of blocks of a trie node: tree, prefix, own, lo,
    hi, node and the depth that was reached."""
    for depth in range(DEPTH, 0, -1):
        prefixes = F.transform(
            F.sequence(F.lit(0), F.lit(TREES - 1)),
            lambda t: F.substr(F.col("sig"), t * (2 * DEPTH) + 1, F.lit(2 * depth)),
        )
        members = nodes.select("node", F.posexplode(prefixes).alias("tree", "prefix"))
        cells = blocked(members, _KEYS, "node", BLOCK).join(nodes.select("node", "sig"), "node")
        schema = (
            "tree int, prefix binary, own int, lo int, hi int, node binary, found double, stands_for double"
        )
        met = saved(together(cells, _KEYS, "node").mapInArrow(_partners(depth), schema), "ngram-met")
        sums = met.agg(F.sum("found"), F.sum("stands_for")).first()
        if not sums[0] or sums[0] >= RECALL * sums[1]:
            break
    return met.withColumn("depth", F.lit(depth))


def _pairs(start: int, n: int, own: np.ndarray, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that a cell is there for."""
    left, right = np.triu_indices(n, 1)
    left, right = left + start, right + start
    if across:
        apart = own[left] != own[right]
        left, right = left[apart], right[apart]
    return left, right


def _likely(
    sigs: np.ndarray, trees: np.ndarray, left: np.ndarray, right: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs belong to their cell's trie and may reach the threshold, and their estimates."""
    slack = 5 * (THRESHOLD * (1 - THRESHOLD) / sigs.shape[1]) ** 0.5
    good, estimates = [np.empty(0, dtype=bool)], [np.empty(0)]
    for start in range(0, len(left), _STEP):
        i, j = left[start : start + _STEP], right[start : start + _STEP]
        same = sigs[i] == sigs[j]
        meets = same.reshape(-1, TREES, DEPTH)[:, :, :depth].all(axis=2)
        estimate = same.mean(axis=1)
        first = meets.argmax(axis=1) == trees[i]
        good.append(first & meets.any(axis=1) & (estimate >= THRESHOLD - slack))
        estimates.append(estimate)
    return np.concatenate(good), np.concatenate(estimates)


def _cells(table: pa.Table, offsets: np.ndarray) -> tuple:
    """Columns of sorted rows as arrays, and the pairs of all cells."""
    sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype="<u2")
    sigs = sigs.reshape(table.num_rows, TREES * DEPTH)
    own, lo, hi, trees = (table.column(c).to_numpy() for c in ("own", "lo", "hi", "tree"))
    return sigs, own, trees, lo != hi


def _partners(depth: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, offsets in runs(batches, [*_KEYS, "lo", "hi"]):
            sigs, own, trees, across = _cells(table, offsets)
            found, stands_for = np.zeros(table.num_rows), np.zeros(table.num_rows)
            partner = np.zeros(table.num_rows, dtype=bool)
            for left, right in _pair_lists(offsets, own, across):
                good, estimates = _likely(sigs, trees, left, right, depth)
                left, right, estimates = left[good], right[good], estimates[good]
                partner[left] = partner[right] = True
                link = estimates >= THRESHOLD
                chance = 1 - (1 - estimates[link] ** depth) ** TREES
                np.add.at(found, left[link], 1.0)
                np.add.at(stands_for, left[link], 1 / chance)
            rows = np.flatnonzero(partner)
            if len(rows):
                kept_rows = table.select([*_KEYS, "own", "lo", "hi", "node"]).take(pa.array(rows))
                kept_rows = kept_rows.append_column("found", pa.array(found[rows]))
                kept_rows = kept_rows.append_column("stands_for", pa.array(stands_for[rows]))
                yield from kept_rows.combine_chunks().to_batches()

    return work


def _pair_lists(offsets: np.ndarray, own: np.ndarray, across: np.ndarray) -> Iterator[tuple]:
    """Pairs of all cells, small cells together."""
    starts, sizes = offsets[:-1], np.diff(offsets)
    twos = starts[sizes == 2]
    apart = ~across[twos] | (own[twos] != own[twos + 1])
    yield twos[apart], twos[apart] + 1
    for start, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        yield _pairs(start, n, own, bool(across[start]))


def _verified(texts: DataFrame, nodes: DataFrame, met: DataFrame) -> DataFrame:
    """Nodes with verified links, per pair of blocks: node, links (rows linked) and root, the least
    node that links lead to there."""
    wanted = met.select("node").distinct().join(nodes.select("node", "least", "size"), "node")
    wanted = saved(wanted, "ngram-wanted")
    ids = wanted.select(F.col("least").alias("_id")).distinct()
    again = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [ngram_set(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array(map(signature, sets), pa.binary()),
                ],
                ["node", "grams", "sig"],
            )

    sets = again.mapInArrow(read, "node binary, grams binary, sig binary")
    sets = sets.join(wanted.select("node", "size"), "node")
    cells = met.select(*_KEYS, "own", "lo", "hi", "node", "depth").join(sets, "node")
    schema = "node binary, links long, root binary"
    return saved(together(cells, _KEYS, "node").mapInArrow(_links, schema), "ngram-links")


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, offsets in runs(batches, [*_KEYS, "lo", "hi"]):
        sigs, own, trees, across = _cells(table, offsets)
        sizes = table.column("size").to_numpy()
        ids = table.column("node").to_pylist()
        grams = [np.frombuffer(g, dtype=np.uint64) for g in table.column("grams").to_pylist()]
        depth = table.column("depth")[0].as_py()
        out = []
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            # A doc_id that several rows have brings a node more than once.
            rows = [i for i in range(start, end) if i == start or ids[i] != ids[i - 1]]
            rows = np.array(rows)
            left, right = _pairs(0, len(rows), own[rows], bool(across[start]))
            left, right = rows[left], rows[right]
            good, _ = _likely(sigs, trees, left, right, depth)
            left, right = left[good] - start, right[good] - start
            linked = _similar(grams[start:end], left, right)
            left, right = left[linked], right[linked]
            if not len(left):
                continue
            links = np.zeros(end - start, dtype=np.int64)
            np.add.at(links, left, sizes[start + right])
            np.add.at(links, right, sizes[start + left])
            roots = least_reached(end - start, left, right)
            out += [(ids[start + i], links[i], ids[start + roots[i]]) for i in np.flatnonzero(links)]
        if out:
            nodes, links, roots = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(roots, pa.binary())],
                ["node", "links", "root"],
            )


def _similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of sets reach the threshold, by their exact intersections."""
    sizes = np.array([len(s) for s in sets])
    if len(left) > 16:
        common = _common(sets)[left, right]
    else:
        common = np.array(
            [len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right)],
            dtype=np.int64,
        )
    return common / (sizes[left] + sizes[right] - common) >= THRESHOLD


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections in a cell: products of parts of its membership matrix."""
    grams, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = counts > 1
    column = (np.cumsum(shared) - 1)[places]
    owners, column = owners[shared[places]], column[shared[places]]
    order = np.argsort(column, kind="stable")
    owners, column = owners[order], column[order]
    common = np.zeros((len(sets), len(sets)))
    for start in range(0, int(shared.sum()), _STEP):
        low, high = np.searchsorted(column, [start, start + _STEP])
        part = np.zeros((len(sets), _STEP), dtype=np.float32)
        part[owners[low:high], column[low:high] - start] = 1
        common += part @ part.T
    return common.round().astype(np.int64)
