"""Near-duplicate vectors: spherical k-means cells, shards of cells, exact cosines where a margin allows a link.

Centroids are fitted on a bounded sample. Each different vector goes to its nearest cell once, and cells
are packed into shards of a few MB. Every pair of shards meets in one task: the shards are read again for it
(a Cartesian product of files, no shuffle), so what is written follows the number of vectors, not that of the
cells that they are near to. Two vectors of the wanted cosine differ by a vector of known length, so what
they lie away from the border between two cells, taken together, is at most that length along the line between
the centroids. In each pair of cells vectors are sorted by that part and only compared as far as it allows.
The first components and the length of the rest bound a cosine from above, in single precision; pairs
that pass are compared by all components in double precision. No pair is missed, whatever the vectors'
directions and the number of cells. Equal vectors are one node with a weight, and a task passes on sums per
vector and a spanning forest of its links. One representative per group of linked vectors is kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthspan.llm.graph import components, least_reached
from monthspan.llm.shared import saved, slices
from monthspan.sources.stages import scratch_dir

THRESHOLD = 0.9
# Vectors per cell that the number of cells aims at, and the bounds of cells and sample, which bound
# what is collected and broadcast: CELLS centroids and SAMPLE vectors. Links don't depend on them:
# smaller cells spare products, larger ones work per pair of cells.
PER_CELL = 2048
CELLS = 4096
SAMPLE = 40_000
ROUNDS = 8
# Vectors of a cell that are sorted and compared at once.
BLOCK = 4096
# Bytes of vectors in a shard, and vectors at most.
SHARD_BYTES = 8_000_000
SHARD_ROWS = 65_536
# Shards of the right side that a task's Python worker holds, about.
SHARDS_PER_TASK = 8
# Rows and columns of a product that are held at once.
_TILE = 128
_COLUMNS = 1024
# Pairs that may pass the bound by the first components, of all in the sample.
_PASS = 2e-5
# Links that wait to be joined to a forest, and components of pairs that wait to be compared.
_WAITING = 1_000_000
_DOUBTS = 1_000_000
_SHARD = (
    "shard long, mark int, size_of int, width int, "
    "vectors binary, nodes binary, weights binary, starts binary, centers binary"
)


def link(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per row of ``vectors``, which are read three times.

    n_links counts the other rows whose cosine, in double precision, is ``threshold`` or more.
    component_id is the least vec_id that links lead to, and kept tells the rows that have it.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor
    do vectors of different lengths with each other. Repeated rows are linked with each other. Rows
    without a vec_id take part; groups of such rows only have a null component_id and kept is null.
    An empty table gives no rows; other columns are ignored.
    """
    chosen = _chosen(vectors, id_col, vector_col)
    rows = _nodes(chosen)
    nodes = rows.where("node is not null").groupBy("node")
    nodes = saved(nodes.agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight")), "vector-nodes")
    near = _links(_shards(chosen, fit(chosen, nodes, threshold)), threshold)
    links = near.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(near.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector")
    # Vectors without links, most as a rule, move in one join only.
    linked = links.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    linked = saved(linked.join(nodes.select("node", "least"), "node"), "vector-linked")
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = linked.join(names, "component").select("node", "links", "component_id")
    groups = nodes.join(linked, "node", "left").select(
        "node",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    linked = rows.where("node is not null").join(groups, "node")
    alone = rows.where("node is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return result.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _chosen(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector, of floats or doubles."""
    kind = vectors.select(F.col(f"`{vector_col}`")).schema[0].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vector = F.col(f"`{vector_col}`").cast("array<float>" if single else "array<double>")
    return vectors.select(F.col(f"`{id_col}`").alias("vec_id"), vector.alias("vector"))


def _nodes(chosen: DataFrame) -> DataFrame:
    """vec_id and node: a digest of the unit vector, null if it can't be compared."""
    id_type = chosen.schema["vec_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nodes: list = [None] * batch.num_rows
            for rows, _, units in _by_length(batch.column("vector")):
                for row, node in zip(rows.tolist(), _digests(units)):
                    nodes[row] = node
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(nodes, pa.binary())], ["vec_id", "node"]
            )

    return saved(chosen.mapInArrow(work, f"vec_id {id_type}, node binary"), "vector-rows")


def _by_length(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, vectors and unit vectors of each length, without those that can't be compared."""
    starts = column.offsets.to_numpy()
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(starts), 0)
    values = column.values.to_numpy(zero_copy_only=False)  # a null component is not a number
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        held = values[starts[rows, None] + np.arange(length)]
        tops = np.abs(held).max(axis=1)
        good = np.isfinite(tops) & (tops > 0)
        if good.any():
            yield rows[good], held[good], _units(held[good])


def _units(held: np.ndarray) -> np.ndarray:
    """Unit vectors; equal vectors give equal bits, whatever stands beside them."""
    held = held.astype(np.float64)
    held /= np.abs(held).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return held / np.sqrt((held * held).sum(axis=1, keepdims=True))


def _digests(units: np.ndarray) -> list[bytes]:
    return [xxhash.xxh3_128_digest(unit) for unit in units]


def fit(chosen: DataFrame, nodes: DataFrame, threshold: float) -> dict[int, tuple[np.ndarray, int]]:
    """Unit centroids and the number of components that bound a cosine well, by vector length.

    They come from the ``SAMPLE`` vectors that a hash puts first.
    """
    place = F.xxhash64("node")
    first = nodes.select(place.alias("place")).orderBy("place").limit(SAMPLE)
    last = first.agg(F.max("place")).first()[0]
    if last is None:
        return {}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for _, _, units in _by_length(batch.column("vector")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digests(units), pa.binary()), pa.array(map(bytes, units), pa.binary())],
                    ["node", "unit"],
                )

    units = chosen.select("vector").mapInArrow(work, "node binary, unit binary").where(place <= last)
    sample = units.dropDuplicates(["node"]).orderBy(place, "node").limit(SAMPLE).toArrow()
    cells = min(CELLS, 1 + nodes.count() // PER_CELL)
    lengths = np.array([len(u) // 8 for u in sample.column("unit").to_pylist()])
    model = {}
    for length in np.unique(lengths):
        taken = sample.column("unit").take(pa.array(np.flatnonzero(lengths == length))).to_pylist()
        held = np.frombuffer(b"".join(taken)).reshape(len(taken), -1)
        k = max(1, cells * len(held) // len(lengths))
        model[int(length)] = _spherical(held, k), _width(held[: 2 * _COLUMNS], threshold)
    return model


def _spherical(units: np.ndarray, k: int) -> np.ndarray:
    """k-means on the sphere: centroids are the directions of their members' sums."""
    centroids = units[:: max(1, len(units) // k)][:k].copy()
    for _ in range(ROUNDS):
        nearest = np.concatenate(
            [(units[i : i + 4096] @ centroids.T).argmax(axis=1) for i in range(0, len(units), 4096)]
        )
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, units)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return centroids


def _slack(length: int) -> float:
    """What rounding in single precision may take from a product of unit vectors."""
    return (length + 8) * 2e-7


def _bounding(units: np.ndarray, width: int) -> np.ndarray:
    """The first components and the length of the rest: products of two are no less than their cosine."""
    rest = units[:, width:]
    return np.column_stack([units[:, :width], np.sqrt((rest * rest).sum(axis=1))]).astype(np.float32)


def _width(units: np.ndarray, threshold: float) -> int:
    """The least number of components by which few of the pairs that aren't linked pass for links."""
    length = units.shape[1]
    half = len(units) // 2
    linked = (units[:half] @ units[half:].T >= threshold).sum()
    for width in range(max(8, length // 8), length, max(4, length // 16)):
        low = _bounding(units, width)
        if (low[:half] @ low[half:].T >= threshold).sum() - linked <= _PASS * half * half:
            return width
    return length


def _homes(units: np.ndarray, centroids: np.ndarray | None) -> np.ndarray:
    """The nearest cell of each vector; equal vectors have equal homes, whatever stands beside them."""
    if centroids is None:  # no vector of this length in the sample
        return np.zeros(len(units), dtype=np.int32)
    near = units.astype(np.float32) @ centroids.T.astype(np.float32)
    close = near >= near.max(axis=1, keepdims=True) - 2 * _slack(units.shape[1])
    homes = near.argmax(axis=1).astype(np.int32)
    for row in np.flatnonzero(close.sum(axis=1) > 1):
        cells = np.flatnonzero(close[row])
        homes[row] = cells[(units[row] * centroids[cells]).sum(axis=1).argmax()]
    return homes


def _shards(chosen: DataFrame, model: dict[int, tuple[np.ndarray, int]]) -> DataFrame:
    """The different vectors, sorted by home and packed; every one is written once.

    mark is as often even as odd.
    """
    spark = chosen.sparkSession
    shared = spark.sparkContext.broadcast(model)
    block, most_bytes, most_rows = BLOCK, SHARD_BYTES, SHARD_ROWS

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for _, held, units in _by_length(batch.column("vector")):
                places, weights = _once(_digests(units))
                held, units = held[list(places.values())], units[list(places.values())]
                n, length = held.shape
                homes = _homes(units, shared.value.get(length, (None, 0))[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(places, pa.binary()),
                        pa.array(np.full(n, length, dtype=np.int32)),
                        pa.array(homes),
                        pa.array(weights, pa.int64()),
                        pa.array(map(bytes, held), pa.binary()),
                    ],
                    ["node", "size_of", "home", "weight", "vector"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, n = TaskContext.get().partitionId(), 0
        held: list[list] = []
        size = 0
        for batch in batches:
            for node, length, home, weight, vector in zip(*(c.to_pylist() for c in batch.columns)):
                if held and length == size and node == held[-1][0]:
                    held[-1][2] += weight
                    continue
                if held and (length != size or len(held) >= min(most_rows, 1 + most_bytes // len(vector))):
                    yield _packed(held, size, shared.value, (partition << 24) + n, partition + n, block)
                    held, n = [], n + 1
                size = length
                held.append([node, home, weight, vector])
        if held:
            yield _packed(held, size, shared.value, (partition << 24) + n, partition + n, block)

    schema = "node binary, size_of int, home int, weight long, vector binary"
    keys = ["size_of", "home"]
    placed = chosen.select("vector").mapInArrow(place, schema)
    packed = placed.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(pack, _SHARD)
    path = scratch_dir(spark, "vector-shards")
    # Few rows of many bytes: sizes are looked at after each of them.
    packed.write.options(
        **{
            "parquet.block.size": 4 * SHARD_BYTES,
            "parquet.block.size.row.check.min": 1,
            "parquet.page.size.row.check.min": 1,
            "parquet.enable.dictionary": "false",
        }
    ).parquet(path)
    return spark.read.schema(packed.schema).parquet(path)


def _once(nodes: list[bytes]) -> tuple[dict[bytes, int], list[int]]:
    """The first place of each different node, and how often each stands there."""
    counts = Counter(nodes)
    places = dict(zip(reversed(nodes), reversed(range(len(nodes)))))
    return {node: places[node] for node in counts}, list(counts.values())


def _packed(held: list[list], length: int, model: dict, shard: int, mark: int, block: int) -> pa.RecordBatch:
    """One shard: vectors with nodes and weights, where each range of a cell starts, and its centroid."""
    nodes, homes, weights, vectors = zip(*held)
    centroids, width = model.get(length, (None, length))
    homes = np.array(homes)
    cuts = np.flatnonzero(homes[1:] != homes[:-1]) + 1
    starts = [np.arange(a, b, block) for a, b in zip(np.append(0, cuts), np.append(cuts, len(homes)))]
    starts = np.concatenate(starts)
    centers = np.zeros((len(starts), length)) if centroids is None else centroids[homes[starts]]
    values = [
        b"".join(vectors),
        b"".join(nodes),
        np.array(weights, dtype=np.int64).tobytes(),
        starts.astype(np.int64).tobytes(),
        centers.astype(np.float32).tobytes(),
    ]
    numbers = [pa.array([shard], pa.int64()), *(pa.array([v], pa.int32()) for v in (mark, length, width))]
    names = [column.split()[0] for column in _SHARD.split(", ")]
    return pa.RecordBatch.from_arrays([*numbers, *(pa.array([v], pa.binary()) for v in values)], names)


class _Shard:
    """A shard as a task holds it."""

    def __init__(self, row: dict):
        self.length, self.width = row["size_of"], row["width"]
        self.nodes = np.frombuffer(row["nodes"], dtype="V16")
        n = len(self.nodes)
        kind = np.float32 if len(row["vectors"]) == 4 * n * self.length else np.float64
        self.vectors = np.frombuffer(row["vectors"], dtype=kind).reshape(n, self.length)
        self.weights = np.frombuffer(row["weights"], dtype=np.int64)
        self.centers = np.frombuffer(row["centers"], dtype=np.float32).reshape(-1, self.length)
        starts = np.frombuffer(row["starts"], dtype=np.int64).tolist()
        self.ranges = [slice(a, b) for a, b in zip(starts, [*starts[1:], n])]
        self.units = np.empty((n, self.length), dtype=np.float32)
        narrow = self.width < self.length
        self.low = np.empty((n, self.width + 1), dtype=np.float32) if narrow else self.units
        for part in self.ranges:
            units = _units(self.vectors[part])
            self.units[part] = units
            if narrow:
                self.low[part] = _bounding(units, self.width)

    def toward(self, centers: np.ndarray) -> list[np.ndarray]:
        """For each range and each of other centers, how much nearer its vectors are to their own center."""
        return [(own - centers) @ self.units[part].T for own, part in zip(self.centers, self.ranges)]

    def exact(self, rows: np.ndarray) -> np.ndarray:
        return _units(self.vectors[rows])


def _links(shards: DataFrame, threshold: float) -> DataFrame:
    """Nodes with links, per pair of shards: node, links (rows linked) and root.

    The join has no keys to be dealt by: a task reads a part of the files for the left and one for the right
    side, and passes a shard to Python once, with the other side's first one. Which of two shards stands left
    follows from their marks, so that tasks on both sides of the diagonal have half the work.
    """
    at_once = math.isqrt(4 * shards.sparkSession.sparkContext.defaultParallelism) + 1
    shards = shards.coalesce(max(at_once, math.ceil(shards.count() / SHARDS_PER_TASK)))
    # Where a row stands in its partition.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    left = shards.select(*(F.col(c).alias(f"a_{c}") for c in shards.columns), first.alias("a_first"))
    right = shards.select(*(F.col(c).alias(f"b_{c}") for c in shards.columns), first.alias("b_first"))
    a, b = F.col("a_shard"), F.col("b_shard")
    chosen = (a < b) == (F.pmod(F.col("a_mark") + F.col("b_mark"), F.lit(2)) == 0)
    wanted = (F.col("a_size_of") == F.col("b_size_of")) & ((a == b) | chosen)
    met = left.hint("shuffle_replicate_nl").join(right, wanted | F.col("a_first") | F.col("b_first"))
    pairs = met.select(
        wanted.alias("wanted"),
        a,
        b,
        F.when(F.col("b_first"), F.struct(*left.columns)).alias("a_row"),
        F.when(F.col("a_first"), F.struct(*right.columns)).alias("b_row"),
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, others = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["a_row"]:
                    one = _Shard({name[2:]: value for name, value in row["a_row"].items()})
                if row["b_row"]:
                    others[row["b_shard"]] = _Shard({name[2:]: value for name, value in row["b_row"].items()})
                if not row["wanted"]:
                    continue
                same = row["a_shard"] == row["b_shard"]
                ids, links, roots = _compared(one, one if same else others[row["b_shard"]], threshold)
                if len(ids):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids.tolist(), pa.binary()), pa.array(links), pa.array(roots.tolist(), pa.binary())],
                        ["node", "links", "root"],
                    )

    return saved(pairs.mapInArrow(compare, "node binary, links long, root binary"), "vector-links")


def _compared(one: _Shard, other: _Shard, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of two shards (or of one) with links between them, rows linked, and a root of each group."""
    found = _Found(one, other)
    apart = np.sqrt(max(0, 2 - 2 * threshold))
    gaps = [np.linalg.norm(other.centers.astype(np.float64) - center, axis=1) for center in one.centers]
    ahead, behind = one.toward(other.centers), other.toward(one.centers)
    for i, mine in enumerate(one.ranges):
        for j in range(i if found.same else 0, len(other.ranges)):
            theirs = other.ranges[j]
            if found.same and i == j:
                _within(one, mine, threshold, found)
                continue
            reach = apart * gaps[i][j] + 4 * _slack(one.length)
            left, right = ahead[i][j], behind[j][i]
            if left.min() + right.min() > reach:
                continue
            rows, columns = np.argsort(left), np.argsort(right)
            ends = np.searchsorted(right[columns], reach - left[rows], side="right")
            rows, columns = rows[: np.count_nonzero(ends)] + mine.start, columns[: ends[0]] + theirs.start
            low, against = one.low[rows], other.low[columns].T
            for start in range(0, len(rows), _TILE):
                part = slice(start, start + _TILE)
                for begin in range(0, ends[start], _COLUMNS):
                    until = slice(begin, min(begin + _COLUMNS, ends[start]))
                    found.add(low[part], against[:, until], rows[part], columns[until], threshold)
    return found.result(threshold)


def _within(shard: _Shard, part: slice, threshold: float, found: _Found) -> None:
    for start in range(part.start, part.stop, _TILE):
        rows = np.arange(start, min(start + _TILE, part.stop))
        for begin in range(start, part.stop, _COLUMNS):
            columns = np.arange(begin, min(begin + _COLUMNS, part.stop))
            low, against = shard.low[start : rows[-1] + 1], shard.low[begin : columns[-1] + 1].T
            found.add(low, against, rows, columns, threshold, begin == start)


class _Found:
    """Links between two shards, or within one: their number by node, and a forest of them."""

    def __init__(self, one: _Shard, other: _Shard):
        self.one, self.other, self.same = one, other, one is other
        self.shift = 0 if self.same else len(one.nodes)
        self.n = self.shift + len(other.nodes)
        self.links = np.zeros(self.n, dtype=np.int64)
        self.least = np.arange(self.n)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.waits = self.doubts = 0
        self.doubtful: list[tuple[np.ndarray, np.ndarray]] = []
        self.buffer = np.empty(_TILE * _COLUMNS, dtype=np.float32)
        self.flags = np.empty(_TILE * _COLUMNS, dtype=bool)

    def add(
        self,
        low: np.ndarray,
        against: np.ndarray,
        rows: np.ndarray,
        columns: np.ndarray,
        threshold: float,
        upper: bool = False,
    ) -> None:
        """Links of some rows and columns; ``upper``: of each pair the one whose row comes first."""
        shape = len(rows), len(columns)
        size = shape[0] * shape[1]
        near = np.matmul(low, against, out=self.buffer[:size].reshape(shape))
        flags = np.greater_equal(
            near, np.float32(threshold - _slack(self.one.length)), out=self.flags[:size].reshape(shape)
        )
        hits = np.flatnonzero(flags)
        if not len(hits):
            return
        if len(hits) * 16 > size:
            near = self.one.exact(rows) @ self.other.exact(columns).T >= threshold
            if upper:
                near &= rows[:, None] < columns
            self.links[rows] += (near @ self.other.weights[columns].astype(np.float64)).astype(np.int64)
            self.links[columns + self.shift] += (self.one.weights[rows].astype(np.float64) @ near).astype(np.int64)
            left, right = np.nonzero(near & (self.least[rows][:, None] != self.least[columns + self.shift]))
            self.wait(rows[left], columns[right] + self.shift)
        else:
            left, right = np.divmod(hits, shape[1])
            left, right = rows[left], columns[right]
            if upper:
                left, right = left[left < right], right[left < right]
            self.doubtful.append((left, right))
            self.doubts += len(left)
            if self.doubts * self.one.length > _DOUBTS:
                self.verify(threshold)

    def verify(self, threshold: float) -> None:
        """Compare those that passed in double precision."""
        if self.doubtful:
            left, right = map(np.concatenate, zip(*self.doubtful))
            step = max(1, _DOUBTS // self.one.length)
            for start in range(0, len(left), step):
                rows, columns = left[start : start + step], right[start : start + step]
                linked = (self.one.exact(rows) * self.other.exact(columns)).sum(axis=1) >= threshold
                self.link(rows[linked], columns[linked])
        self.doubtful, self.doubts = [], 0

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        np.add.at(self.links, left, self.other.weights[right])
        np.add.at(self.links, right + self.shift, self.one.weights[left])
        joins = self.least[left] != self.least[right + self.shift]
        self.wait(left[joins], right[joins] + self.shift)

    def wait(self, left: np.ndarray, right: np.ndarray) -> None:
        if len(left):
            self.waiting.append((left, right))
            self.waits += len(left)
            if self.waits > _WAITING:
                self.join()

    def join(self) -> None:
        left, right = map(np.concatenate, zip(*self.waiting, (np.arange(self.n), self.least)))
        self.least, self.waiting, self.waits = least_reached(self.n, left, right), [], 0

    def result(self, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.verify(threshold)
        if self.waiting:
            self.join()
        nodes = self.one.nodes if self.same else np.concatenate([self.one.nodes, self.other.nodes])
        held = np.flatnonzero(self.links)
        return nodes[held], self.links[held], nodes[self.least[held]]
