"""Looking at files without reading them whole: listing, names, Parquet footers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow.fs
import pyarrow.parquet
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthspan.panel import task_count

# Rows that a task may sort as it scans them.
MOST_SCANNED = 500_000
_NUMBER = "_number"


def file_name() -> Column:
    """The base name of a scanned row's file, as it is written on disk.

    The scan's own column holds it percent-encoded; a plus sign there is a plus sign.
    """
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def list_files(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """Non-empty files as (path, file_name, length, modificationTime); no content is read.

    Raises FileNotFoundError when the directory holds no such file, and ValueError when one of them
    begins with an underscore or a dot: Spark's readers pass over such files, and leaving out rows
    without a word would be worse than stopping.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if hidden := _hidden(spark, directory, pattern):
        raise ValueError(f"Spark does not read files whose names begin like this one: {hidden}")
    try:
        files = reader.load(directory).select("path", "length", "modificationTime", file_name().alias("file_name"))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no directory {directory}") from error
        raise
    if files.isEmpty():
        raise FileNotFoundError(f"no {pattern} files in {directory}")
    return files.select("path", "file_name", "length", "modificationTime")


def spread(rows: DataFrame) -> DataFrame:
    """A scan's rows, dealt to more tasks where one would read more than ``MOST_SCANNED``, as it does of a large row
    group or of files that compress well. Reads no column to find out."""
    tasks = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count"))
    most, total = tasks.first()
    if not most or most <= MOST_SCANNED:
        return rows
    numbered = rows.withColumn(_NUMBER, F.monotonically_increasing_id())
    return numbered.repartition(task_count(rows.sparkSession, total), _NUMBER).drop(_NUMBER)


def _hidden(spark: SparkSession, directory: str, pattern: str) -> str | None:
    """A file of the pattern that Spark would pass over; only the names of such files are listed."""
    if pattern == "*":
        return None  # includes the marks that Spark itself leaves in its directories
    hadoop = spark._jvm.org.apache.hadoop.fs
    directory = hadoop.Path(directory)
    system = directory.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(directory) or not system.getFileStatus(directory).isDirectory():
        return None
    found = system.globStatus(hadoop.Path(directory, "[_.]" + pattern))
    return found[0].getPath().toString() if found else None


def with_parquet_schema(files: DataFrame) -> DataFrame:
    """Add ``schema``, the names and types in the file's footer, to a listing."""
    schema = f"{_ddl(files)}, schema string"
    return files.mapInPandas(lambda batches: _map_paths(batches, "schema", _footer), schema)


def schema_variants(spark: SparkSession, directory: str) -> DataFrame:
    """Distinct schemas among the Parquet files of a directory; one row means no drift."""
    files = with_parquet_schema(list_files(spark, directory, "*.parquet"))
    return files.groupBy("schema").agg(F.count("*").alias("files"), F.min("path").alias("example"))


def _ddl(frame: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in frame.dtypes)


def _map_paths(batches: Iterator[pd.DataFrame], name: str, read: Any) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(**{name: batch["path"].map(read)})


def _open(path: str) -> Any:
    local = re.sub("^file:/+", "/", path)
    if local.startswith("/"):
        return pyarrow.fs.LocalFileSystem().open_input_file(local)
    system, inner = pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return system.open_input_file(inner)


def _footer(path: str) -> str:
    with _open(path) as handle:
        return str(pyarrow.parquet.read_schema(handle).remove_metadata())


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory that all machines see: under spark.checkpoint.dir, else in the warehouse.

    A warehouse on the driver's own disk is shared with nobody, so on a cluster that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
        if not local and _is_local(shared):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _is_local(directory: str) -> bool:
    return directory.startswith(("file:", "/"))
