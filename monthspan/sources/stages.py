"""Stage tables: Parquet directories with versions.

Each write goes to a folder of its own inside the stage's directory, and counts only when a row has been appended to
the list of commits beside it. Readers take the last version that was committed, so a write that is killed leaves
the version before it as it is. The last two versions are kept. A stage has one writer at a time. A directory without
commits is read as plain Parquet.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthspan.operators.rejects import FAULTS, accepted
from monthspan.panel import Panel, col, task_count
from monthspan.sources import entities
from monthspan.sources.files import list_files
from monthspan.sources.files import scratch_dir as scratch_dir
from monthspan.sources.raw import SOURCE_FILE, SOURCE_POS

# The classic range of output files per stage.
FEWEST_FILES = 10
MOST_FILES = 50
# Versions of a stage that stay.
VERSIONS = 2
_INDEX = "_index"
_COMMIT = "number bigint, version string, content string"


@dataclass(frozen=True)
class Commit:
    """A version of a stage table.

    ``source`` tells what it was made from, ``faulty`` how many rows were left out for their faults, ``checks`` what
    the checks of the write found: name, offences and one example. ``buckets`` are the number of buckets by ``keys[0]``,
    sorted by ``keys``, and ``schema`` their columns.
    """

    number: int
    version: str
    rows: int
    faulty: int = 0
    source: str = ""
    checks: list[dict] = field(default_factory=list)
    buckets: int = 0
    keys: list[str] = field(default_factory=list)
    schema: str = ""


def file_count(n: int, low: int = FEWEST_FILES, high: int = MOST_FILES) -> int:
    """Clamp a number of inputs to a number of output files."""
    return max(low, min(n, high))


def commits(spark: SparkSession, directory: str) -> list[Commit]:
    """The versions that stay, the last one first."""
    path = f"{directory}/_commits"
    if not _exists(spark, path):
        return []
    rows = spark.read.schema(_COMMIT).json(path).orderBy(F.desc("number")).limit(VERSIONS).collect()
    return [Commit(**json.loads(row["content"])) for row in rows]


def current_path(spark: SparkSession, directory: str) -> str:
    """The folder of the last version, or the directory itself if it has none."""
    found = commits(spark, directory)
    return f"{directory}/{found[0].version}" if found else directory


def read_stage(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, directory))


def read_rows_in_order(spark: SparkSession, directory: str) -> tuple[DataFrame, list[str]]:
    """A stage table and the columns that give its rows their order.

    Tables without source_pos are ordered by the rows' places in the Parquet files.
    """
    rows = read_stage(spark, directory)
    if SOURCE_POS in rows.columns:
        return rows, [SOURCE_FILE, SOURCE_POS]
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return rows.select("*", place.alias(SOURCE_POS)), [SOURCE_POS]


def write_stage(
    frame: DataFrame,
    directory: str,
    files: int | None = None,
    panel: Panel | None = None,
    checks: Mapping[str, Column] | None = None,
    source: str = "",
    faulty: int = 0,
    file_bytes: int | None = None,
) -> Commit:
    """Write a new version of a stage table.

    By default the file sizes follow the plan's own partitions, which scale with the data. With
    ``files``, rows are spread over that many files first: by entity and in date order for a panel,
    evenly otherwise. With ``file_bytes``, files get about that many bytes of shuffled rows each, whatever their
    number: small entities share a file, and a large one is split. Faulty rows are left out and counted, besides those that ``faulty`` tells of. ``checks`` are conditions that offending rows meet;
    they are counted in the same pass, with the least offending row's first column and date as an example.
    """
    observed, seen = _observed(frame, panel or Panel(), checks or {})
    version, number = _next_version(frame.sparkSession, directory)
    with _advisory_size(frame.sparkSession, file_bytes):
        _arrange(observed, files, panel, file_bytes).write.parquet(f"{directory}/{version}")
    return _commit(frame.sparkSession, directory, Commit(number, version, source=source, **_counts(seen, checks, faulty)))


def write_panel(
    frame: DataFrame,
    directory: str,
    panel: Panel = Panel(),
    checks: Mapping[str, Column] | None = None,
    source: str = "",
    faulty: int = 0,
    buckets: int | None = None,
) -> Commit:
    """Write a new version of a stage table in buckets by entity, in date order inside each bucket.

    What reads it with ``read_panel`` finds each entity in one partition and shuffles nothing. The
    number of buckets must be that of the shuffle that the rows come from, by default the session's; then the write
    adds none.
    """
    spark = frame.sparkSession
    observed, seen = _observed(frame, panel, checks or {})
    version, number = _next_version(spark, directory)
    path = f"{directory}/{version}"
    buckets = buckets or task_count(spark)
    keys = [panel.entity, *[k for k in panel.keys if k != panel.entity]]
    writer = observed.write.format("parquet").option("path", path)
    writer.bucketBy(buckets, panel.entity).sortBy(*keys).saveAsTable(_table(path))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in observed.schema)
    layout = {"buckets": buckets, "keys": keys, "schema": schema}
    return _commit(spark, directory, Commit(number, version, source=source, **layout, **_counts(seen, checks, faulty)))


def read_panel(spark: SparkSession, directory: str) -> DataFrame:
    """A stage table with its buckets, whichever session wrote it."""
    found = commits(spark, directory)
    if not found or not found[0].buckets:
        return read_stage(spark, directory)
    path = f"{directory}/{found[0].version}"
    if not spark.catalog.tableExists(_table(path)):
        _register(spark, path, found[0])
    return spark.table(_table(path))


def _register(spark: SparkSession, path: str, commit: Commit) -> None:
    """Make the buckets known to this session's catalog, after a look at the files' names."""
    bucket = F.regexp_extract("file_name", r"_([0-9]{5})(?:\.|$)", 1).try_cast("int")
    astray = list_files(spark, path, "*.parquet").filter(bucket.isNull() | (bucket >= commit.buckets))
    if not astray.isEmpty():
        raise ValueError(f"{path} holds files that belong to none of its {commit.buckets} buckets")
    keys = ", ".join(f"`{key}`" for key in commit.keys)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"create table {_table(path)} ({commit.schema}) using parquet clustered by (`{commit.keys[0]}`) "
        f"sorted by ({keys}) into {commit.buckets} buckets location '{location}'"
    )


def _table(path: str) -> str:
    return f"monthspan_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def _observed(
    frame: DataFrame, panel: Panel, checks: Mapping[str, Column]
) -> tuple[DataFrame, Observation]:
    """The rows to write, and what will be known of them when they are written."""
    seen = Observation()
    clean = F.size(FAULTS) == 0 if FAULTS in frame.columns else F.lit(True)
    marks = {f"_check_{name}": F.coalesce(offends, F.lit(False)) for name, offends in checks.items()}
    marked = frame.withColumns(marks) if marks else frame
    key = [F.col(f"`{frame.columns[0]}`").cast("string")]
    if panel.date in frame.columns:
        key.append(col(panel.date).cast("string"))
    found = [F.count_if(clean).alias("rows"), F.count_if(~clean).alias("faulty")]
    for name in checks:
        bad = F.col(f"_check_{name}") & clean
        example = F.min(F.when(bad, F.struct(*[part.alias(f"k{i}") for i, part in enumerate(key)])))
        found += [F.count_if(bad).alias(f"n_{name}"), F.to_json(example).alias(f"e_{name}")]
    observed = marked.observe(seen, *found).drop(*marks)
    return (accepted(observed) if FAULTS in frame.columns else observed), seen


def _counts(seen: Observation, checks: Mapping[str, Column] | None, faulty: int) -> dict:
    found = seen.get
    return {
        "rows": found["rows"],
        "faulty": found["faulty"] + faulty,
        "checks": [
            {"check": name, "offences": found[f"n_{name}"], "example": _example(found[f"e_{name}"])}
            for name in checks or {}
        ],
    }


def _example(key: str | None) -> str | None:
    return " ".join(json.loads(key).values()) if key else None


def _next_version(spark: SparkSession, directory: str) -> tuple[str, int]:
    found = commits(spark, directory)
    number = found[0].number + 1 if found else 1
    return f"v{number}-{uuid.uuid4().hex[:12]}", number


def _commit(spark: SparkSession, directory: str, commit: Commit) -> Commit:
    """Append to the list of commits; only then does a version count. Drop versions that are too old."""
    row = spark.createDataFrame([(commit.number, commit.version, json.dumps(asdict(commit)))], _COMMIT)
    row.coalesce(1).write.mode("append").json(f"{directory}/_commits")
    kept = {found.version for found in commits(spark, directory)}
    for name in _names(spark, directory, "v*-*"):
        if name not in kept:
            spark.sql(f"drop table if exists {_table(f'{directory}/{name}')}")
            drop_dir(spark, f"{directory}/{name}")
    return commit


def write_by_entity(frame: DataFrame, directory: str, panel: Panel = Panel(), rows: int = 0) -> None:
    """One directory per entity, each file holding one entity. Opt-in: it makes many small files.

    ``rows``, where the caller knows about how many there are, sets the number of tasks. Nothing is to be seen in the
    directory before all is written; what was there before is replaced.
    """
    spark = frame.sparkSession
    local = _local_path(spark, directory)
    if local is None:
        ordered = frame.repartition(task_count(spark, rows), col(panel.entity)).sortWithinPartitions(*map(col, panel.keys))
        ordered.write.mode("overwrite").partitionBy(panel.entity).parquet(directory)
        return
    apart = f"{directory.rstrip('/')}-{uuid.uuid4().hex}"
    try:
        entities.write(frame, _local_path(spark, apart), f"{apart}/{entities.INDEX}", panel, rows)
    except Exception:
        drop_dir(spark, apart)
        raise
    drop_dir(spark, directory)
    path, system = _file_system(spark, directory)
    system.rename(_file_system(spark, apart)[0], path)
    system.create(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")).close()


def read_by_entity(spark: SparkSession, directory: str, panel: Panel = Panel()) -> DataFrame:
    """All rows of the entities' directories, with the ``path`` of each row's file."""
    local = _local_path(spark, directory)
    if local is None or not _exists(spark, f"{directory}/{entities.INDEX}"):
        return spark.read.parquet(directory).select("*", F.col("_metadata.file_path").alias(entities.PATH))
    return entities.read(spark, local, f"{directory}/{entities.INDEX}", panel)


def write_clustered(
    frame: DataFrame,
    directory: str,
    panel: Panel = Panel(),
    file_bytes: int | None = None,
    group_bytes: int = 8 << 20,
) -> Commit:
    """Write a new version of a stage table in ranges of entities, with an index of where each entity is.

    Files hold about ``file_bytes`` of shuffled rows each (by default what Spark advises), in row groups of
    ``group_bytes`` with Bloom filters on the entity, so their number follows the data and not the entities. An entity
    that is too large for a file goes on in the next one. The index has a row per entity and file.
    """
    spark = frame.sparkSession
    observed, seen = _observed(frame, panel, {})
    version, number = _next_version(spark, directory)
    path, keys = f"{directory}/{version}", [col(k) for k in (panel.entity, *panel.keys)]
    with _advisory_size(spark, file_bytes):
        writer = observed.repartitionByRange(*keys).sortWithinPartitions(*keys).write
        writer = writer.option(f"parquet.bloom.filter.enabled#{panel.entity}", "true")
        writer.option("parquet.block.size", group_bytes).parquet(path)
        place = {"file_name": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")}
        rows = spark.read.parquet(path).withColumns(place)
        index = rows.groupBy(col(panel.entity), "file_name").agg(
            F.min("_row").alias("first_row"),
            F.count(F.lit(1)).alias("rows"),
            F.min(col(panel.date)).alias("first_date"),
            F.max(col(panel.date)).alias("last_date"),
        )
        order = [col(panel.entity), "first_date"]
        index.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{path}/{_INDEX}")
    return _commit(spark, directory, Commit(number, version, source="", **_counts(seen, {}, 0)))


def read_index(spark: SparkSession, directory: str) -> DataFrame:
    """Where a clustered stage table holds each entity: file_name, first_row, rows, first_date and last_date."""
    return spark.read.parquet(f"{current_path(spark, directory)}/{_INDEX}")


def read_entities(spark: SparkSession, directory: str, wanted: DataFrame | Sequence, panel: Panel = Panel()) -> DataFrame:
    """All rows of some entities of a clustered stage table, a sequence of them or a table's first column.

    The index tells the files, whose names (never more than the table has) pass the driver; no other file is opened.
    Inside them a sequence is a pushed filter, which reads the row groups of these entities only.
    """
    entity = col(panel.entity)
    path, index = current_path(spark, directory), read_index(spark, directory)
    if isinstance(wanted, DataFrame):
        ids = wanted.select(F.col(f"`{wanted.columns[0]}`").alias(panel.entity)).distinct()
        held = index.join(ids, panel.entity, "left_semi")
    else:
        held = index.filter(entity.isin(list(wanted)))
    names = [row["file_name"] for row in held.select("file_name").distinct().collect()]
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).parquet(*[f"{path}/{name}" for name in names]) if names else spark.createDataFrame([], schema)
    return rows.join(ids, panel.entity, "left_semi") if isinstance(wanted, DataFrame) else rows.filter(entity.isin(list(wanted)))


@contextmanager
def _advisory_size(spark: SparkSession, file_bytes: int | None) -> Iterator[None]:
    """Let partitions that Spark sizes by itself have about that many bytes, however few they then are."""
    adaptive = "spark.sql.adaptive."
    wanted = {} if file_bytes is None else {
        adaptive + "advisoryPartitionSizeInBytes": str(file_bytes),
        adaptive + "coalescePartitions.parallelismFirst": "false",
        adaptive + "coalescePartitions.minPartitionSize": str(max(1, file_bytes // 5)),
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _arrange(
    frame: DataFrame, files: int | None, panel: Panel | None, file_bytes: int | None = None
) -> DataFrame:
    if file_bytes is not None:
        if files is not None:
            raise ValueError("files and file_bytes exclude each other")
        frame = frame.hint("rebalance", *([col(panel.entity)] if panel else []))
    if panel is None:
        return frame if files is None else frame.repartition(files)
    if files is not None:
        frame = frame.repartition(files, col(panel.entity))
    return frame.sortWithinPartitions(*map(col, panel.keys))


def move_files(spark: SparkSession, contents: DataFrame, write, directory: str, first_name: str) -> None:
    """Write files to a directory of their own, name the first one, and move them all together.

    Only names pass the driver, those of one call's files.
    """
    apart = f"{directory}-{uuid.uuid4().hex}"
    write(contents, apart)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(apart), hadoop.Path(directory)
    system = source.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    system.mkdirs(target)
    found = sorted(s.getPath().getName() for s in system.globStatus(hadoop.Path(source, "part-*")))
    for i, name in enumerate(found):
        # A one-part path: the name is taken as it is written, special characters included.
        system.rename(hadoop.Path(source, name), hadoop.Path(target, name if i else first_name))
    system.delete(source, True)


def drop_dir(spark: SparkSession, directory: str) -> None:
    """Remove a scratch directory that nothing reads any more."""
    path, system = _file_system(spark, directory)
    system.delete(path, True)


def _exists(spark: SparkSession, directory: str) -> bool:
    path, system = _file_system(spark, directory)
    return system.exists(path)


def _names(spark: SparkSession, directory: str, pattern: str) -> list[str]:
    """Names of a directory's folders; of few, as only some versions are kept."""
    path, system = _file_system(spark, directory)
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path) if status.isDirectory()]
    return [name for name in names if fnmatch(name, pattern)]


def _local_path(spark: SparkSession, directory: str) -> str | None:
    """The plain path of a directory, if its file system is that of the machines."""
    path, system = _file_system(spark, directory)
    return system.makeQualified(path).toUri().getPath() if system.getUri().getScheme() == "file" else None


def _file_system(spark: SparkSession, directory: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
