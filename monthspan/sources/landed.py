"""Lease index, landed files and their integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthspan.operators.dedup import keep_first
from monthspan.panel import DEFAULT_MIN_YEAR, col
from monthspan.sources.files import file_name, list_files
from monthspan.sources.raw import PATTERN, keep_from_year

INDEX_POS = "index_pos"


def read_lease_index(spark: SparkSession, path: str, quoted_breaks: bool = False) -> DataFrame:
    """Index file, every column text, plus the row's place in it.

    All parts have one header. They are read in parallel pieces, unless ``quoted_breaks`` says that
    cells in quotes may hold line breaks: each part is then read by one task.
    """
    index = spark.read.csv(path, header=True, escape='"', multiLine=quoted_breaks)
    place = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return index.select("*", place.alias(INDEX_POS))


def current_leases(
    index: DataFrame, min_year: int = DEFAULT_MIN_YEAR, position: str = INDEX_POS
) -> DataFrame:
    """Index rows from ``min_year`` on, the first row of each URL."""
    return keep_first(keep_from_year(index, min_year), ["URL"], [position])


def landed_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """(file_name, length) of the non-empty files that are already there."""
    try:
        return list_files(spark, raw_dir, PATTERN).select("file_name", "length")
    except FileNotFoundError:
        return spark.createDataFrame([], "file_name string, length bigint")


def not_landed(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest rows whose file is absent or empty."""
    return manifest.join(landed.filter(F.col("length") > 0), "file_name", "left_anti")


def file_lines(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Lines of all landed files, read in parallel pieces."""
    lines = spark.read.option("pathGlobFilter", PATTERN).text(raw_dir)
    return lines.select(file_name().alias("file_name"), F.col("value").alias("line"))


def integrity(expected: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per expected file: is it there with content, valid UTF-8, with a row after the header?

    Blank lines are no content and no rows. Spark lists no empty files, so the expected names must come from elsewhere; a name without
    lines is an empty or absent file. A line end cannot lie inside a UTF-8 character, so a file is
    valid exactly when all its lines are, and no file has to fit into one task.
    """
    checked = lines.groupBy("file_name").agg(
        F.count_if(F.trim("line") != "").alias("lines"), F.bool_and(F.is_valid_utf8("line")).alias("utf8")
    )
    joined = expected.select("file_name").distinct().join(checked, "file_name", "left")
    n = F.coalesce(col("lines"), F.lit(0))
    valid = F.coalesce(col("utf8"), F.lit(False))
    return joined.select(
        "file_name",
        n.alias("lines"),
        (n > 0).alias("has_content"),
        valid.alias("valid_utf8"),
        (n > 1).alias("has_rows"),
        ((n > 1) & valid).alias("ok"),
    )
