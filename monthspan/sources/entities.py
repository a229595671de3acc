"""One directory per entity on a file system that tasks reach by plain paths.

Spark's writer makes six processes for a directory there, to set modes, and its reader brings every file's name to the
driver; both cost far more than the rows of a small entity. Here tasks write and read the files through Arrow, and an
index beside them tells the directories, so names stay with the tasks too.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthspan.panel import Panel, col, task_count

INDEX = "_index"
PATH = "path"
# As Spark names directories, so that its reader understands them.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
_TEXT = "_text"
# Rows that a task hands on at once.
_BATCH = 10_000


def escaped(text: str) -> str:
    return _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", text)


def write(frame: DataFrame, local: str, index: str, panel: Panel, rows: int) -> None:
    """Write one file per entity below the folder ``local`` and an index of them to ``index``.

    All rows of a directory are in one task, so a file holds one entity and a task that runs again writes the same
    files; each takes its name when it is complete.
    """
    tasks = task_count(frame.sparkSession, rows)
    named = frame.withColumn(_TEXT, _directory_text(panel))
    ordered = named.repartition(tasks, _TEXT).sortWithinPartitions(_TEXT, *map(col, panel.keys))
    entity = T.StructField(panel.entity, frame.schema[panel.entity].dataType)
    schema = T.StructType([entity, T.StructField("directory", T.StringType()), T.StructField("rows", T.LongType())])
    ordered.mapInArrow(_writer(local, panel.entity), schema).write.parquet(index)


def read(spark: SparkSession, local: str, index: str, panel: Panel) -> DataFrame:
    """All rows of the directories that the index names, with the ``path`` of each row's file."""
    held = spark.read.parquet(index)
    total = held.agg(F.sum("rows")).first()[0]
    if not total:
        raise FileNotFoundError(f"no entities in {local}")
    first = held.select("directory").first()["directory"]
    data = spark.read.parquet(f"file://{_quoted(local)}/{_quoted(first)}").schema
    schema = T.StructType([*data, held.schema[panel.entity], T.StructField(PATH, T.StringType())])
    dealt = held.repartition(task_count(spark, total))
    return dealt.mapInArrow(_reader(local, panel.entity), schema)


def _quoted(path: str) -> str:
    """A path that Spark reads does not take for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _directory_text(panel: Panel) -> Column:
    text = col(panel.entity).cast("string")
    return F.when(text != "", text)


def _writer(local: str, entity: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name, attempt = f"part-{task.partitionId():05d}.parquet", task.taskAttemptId()
        os.makedirs(local, exist_ok=True)
        prefix = f"{escaped(entity)}="
        done: list[tuple] = []
        current, sink = None, None

        def close() -> None:
            if sink is not None:
                sink.close()
                folder = f"{local}/{done[-1][1]}"
                os.replace(f"{folder}/.{name}-{attempt}", f"{folder}/{name}")

        def index(batch: pa.RecordBatch) -> pa.RecordBatch:
            values, folders, counts = zip(*done)
            kind = batch.schema.field(entity).type
            return pa.RecordBatch.from_arrays(
                [pa.array(values, kind), pa.array(folders, pa.string()), pa.array(counts, pa.int64())],
                [entity, "directory", "rows"],
            )

        for batch in batches:
            place, texts = batch.schema.get_field_index(entity), batch.column(_TEXT)
            data = batch.drop_columns([entity, _TEXT])
            runs = pc.run_end_encode(texts)
            start = 0
            for end, text in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                folder = prefix + (_NO_VALUE if text is None else escaped(text))
                if folder != current:
                    close()
                    if len(done) >= _BATCH:
                        yield index(batch)
                        done.clear()
                    try:
                        os.mkdir(f"{local}/{folder}")
                    except FileExistsError:
                        pass  # by an attempt that broke off
                    sink = pq.ParquetWriter(f"{local}/{folder}/.{name}-{attempt}", data.schema)
                    current = folder
                    done.append((None if text is None else batch.column(place)[start].as_py(), folder, 0))
                sink.write_batch(data.slice(start, end - start))
                done[-1] = (*done[-1][:2], done[-1][2] + end - start)
                start = end
        close()
        if done:
            yield index(batch)

    return run


def _reader(local: str, entity: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows_of(held: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = held.column(held.schema.get_field_index(entity))
        for value, folder in zip(values, held.column("directory").to_pylist()):
            # What is there, whatever the index says of it.
            for name in sorted(os.listdir(f"{local}/{folder}")):
                if name[0] in "_.":
                    continue
                path = f"{local}/{folder}/{name}"
                with pq.ParquetFile(path) as file:
                    for part in file.iter_batches(_BATCH, use_threads=False):
                        added = [pa.repeat(value, part.num_rows), pa.repeat(path, part.num_rows)]
                        yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, entity, PATH])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for held in batches:
            for part in rows_of(held):
                waiting.append(part)
                rows += part.num_rows
                if rows >= _BATCH:
                    yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                    waiting, rows = [], 0
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return run
