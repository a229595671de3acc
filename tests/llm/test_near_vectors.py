"""Near vectors against all cosines."""

from pathlib import Path

import numpy as np
import pytest

from monthspan.llm import near_vectors
from tests.llm.data import groups, table

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, cells int"


def plain(rows):
    """vec_id, n_links, component_id and kept by comparing all pairs."""
    values = np.array([vector for _, vector in rows], dtype=np.float64)
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    near = np.tril(values @ values.T >= near_vectors.THRESHOLD, -1)
    least = groups(len(rows), zip(*np.nonzero(near)))
    links = near.sum(axis=0) + near.sum(axis=1)
    return sorted(
        (vec_id, int(links[i]), rows[least[i]][0], least[i] == i) for i, (vec_id, _) in enumerate(rows)
    )


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, None, None) for i, v in rows], SCHEMA)


def linked(vectors):
    return sorted(map(tuple, near_vectors.link(vectors).collect()), key=str)


def clustered(n, groups_, noise, seed, dims=32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups_, dims))
    return (centres[rng.integers(0, groups_, n)] + noise * rng.normal(size=(n, dims))).astype(np.float32)


def test_given_vectors(spark):
    vectors = table(spark, "embeddings")
    rows = sorted((r["vec_id"], r["embedding"]) for r in vectors.collect())
    assert linked(vectors) == sorted(plain(rows), key=str)


def test_recall_on_many_cells(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "PER_CELL", 16)
    for noise in (0.15, 0.25, 0.33):
        rows = [(i, v.tolist()) for i, v in enumerate(clustered(1500, 300, noise, 3))]
        wanted, found = plain(rows), sorted(linked(frame(spark, rows)), key=lambda r: r[0])
        assert sum(r[1] for r in found) >= 0.99 * sum(r[1] for r in wanted)
        assert all(f[1] <= w[1] for f, w in zip(found, wanted))


@pytest.mark.parametrize("n, rank, per_cell", [(600, 6, 16), (2000, 6, 64), (2000, 8, 16), (4000, 6, 256)])
def test_no_link_is_lost_on_few_directions(spark, monkeypatch, n, rank, per_cell):
    monkeypatch.setattr(near_vectors, "PER_CELL", per_cell)
    monkeypatch.setattr(near_vectors, "BLOCK", 300)
    rng = np.random.default_rng(n + rank)
    values = rng.normal(size=(n, rank)) @ rng.normal(size=(rank, 64))
    rows = list(enumerate(values.astype(np.float32).tolist()))
    assert linked(frame(spark, rows)) == sorted(plain(rows), key=str)


def test_a_group_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 64)
    rows = [(i, v.tolist()) for i, v in enumerate(clustered(500, 2, 0.1, 4))]
    assert linked(frame(spark, rows)) == sorted(plain(rows), key=str)


def test_a_vector_is_written_once(spark, monkeypatch):
    """Vectors without clusters are near to most of many cells; what is written doesn't follow that number."""
    monkeypatch.setattr(near_vectors, "PER_CELL", 64)
    monkeypatch.setattr(near_vectors, "SAMPLE", 600)
    values = np.random.default_rng(5).normal(size=(6000, 64)).astype(np.float32)
    vectors = frame(spark, list(enumerate(values.tolist())))
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [Path(spark.conf.get("spark.checkpoint.dir")), *map(Path, blocks)]
    held = lambda: {f: f.stat().st_size for folder in folders for f in folder.rglob("*") if f.is_file()}
    before = held()
    result = near_vectors.link(vectors)
    written = sum(size for f, size in held().items() if f not in before)
    assert written <= 4 * values.nbytes
    assert result.where("n_links = 0 and kept").count() == 6000


@pytest.mark.parametrize("shard_rows, per_task", [(70, 1), (150, 3)])
def test_shards_meet_once(spark, monkeypatch, shard_rows, per_task):
    monkeypatch.setattr(near_vectors, "PER_CELL", 50)
    monkeypatch.setattr(near_vectors, "BLOCK", 30)
    monkeypatch.setattr(near_vectors, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(near_vectors, "SHARDS_PER_TASK", per_task)
    values = np.concatenate([clustered(500, 60, 0.25, 6), clustered(400, 2, 0.1, 7)]).tolist()
    rows = list(enumerate([*values, *values[:40], *values[600:650]]))  # some twice, in other batches
    vectors = frame(spark, rows)
    assert linked(vectors) == sorted(plain(rows), key=str)
    doubles = vectors.withColumn("embedding", vectors["embedding"].cast("array<double>"))
    assert linked(doubles) == sorted(plain(rows), key=str)


def test_the_bound_passes_every_link():
    """Products of the first components and the rest are no less than the cosine, whatever their number."""
    rng = np.random.default_rng(8)
    for units in (rng.normal(size=(300, 48)), rng.normal(size=(300, 48)) * 0.5 ** np.arange(48)):
        units = near_vectors._units(units)
        units = np.concatenate([units, near_vectors._units(units + 0.05 * rng.normal(size=units.shape))])
        cosines = units @ units.T
        for width in (8, 20, 47, 48):
            low = near_vectors._bounding(units, width)
            assert (low @ low.T >= cosines - near_vectors._slack(48)).all()


def test_equal_vectors_have_one_home():
    """Between centroids that are as near to each other, too."""
    rng = np.random.default_rng(9)
    centroids = near_vectors._units(rng.normal(size=(40, 16)))
    centroids = np.concatenate([centroids, centroids, near_vectors._units(centroids + 1e-9)])
    units = near_vectors._units(rng.normal(size=(200, 16)))
    homes = near_vectors._homes(units, centroids)
    for start, end in ((0, 1), (7, 12), (50, 200)):
        assert (near_vectors._homes(units[start:end], centroids) == homes[start:end]).all()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, None),
        (1, []),
        (2, [0.0, 0.0]),
        (3, [0.0, 0.0]),
        (4, [1.0, nan]),
        (5, [inf, 1.0]),
        (6, [1.0, None]),
        (7, [1.0, 2.0]),
        (8, [1.0, 2.0]),
        (8, [1.0, 2.0]),
        (9, [1e30, 2e30]),
        (10, [1e-30, 2e-30]),
        (11, [1.0, 2.0, 0.0]),
        (None, [1.0, 2.0]),
        (None, [-1.0, 2.0]),
        (None, None),
    ]
    found = linked(frame(spark, rows))
    assert len(found) == len(rows)
    alone = [(i, 0, i, True) for i in (*range(7), 11)]
    near = [(i, 5, 7, i == 7) for i in (7, 8, 8, 9, 10)]
    missing = [(None, 0, None, None), (None, 0, None, None), (None, 5, 7, None)]
    assert found == sorted(alone + near + missing, key=str)


def test_no_vectors(spark):
    assert linked(frame(spark, [])) == []
    assert linked(frame(spark, [(1, None)])) == [(1, 0, 1, True)]
    assert linked(frame(spark, [(1, [1.0])])) == [(1, 0, 1, True)]
