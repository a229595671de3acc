"""The data dictionary: the schema of the raw files, stated as data, never inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DICTIONARY_COLUMNS = ["column", "description", "dtype", "nullable", "categories"]

# Dictionary label -> Spark type.
TYPES: dict[str, T.DataType] = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "string": T.StringType(),
    "categorical": T.StringType(),
}

# Column, label, nullable, categories of the monthly files.
MONTHLY = [
    ("LEASE_KID", "int", "no", ""),
    ("LEASE", "string", "yes", ""),
    ("DOR_CODE", "int", "yes", ""),
    ("API_NUMBER", "string", "yes", ""),
    ("FIELD", "string", "yes", ""),
    ("PRODUCING_ZONE", "string", "yes", ""),
    ("OPERATOR", "string", "yes", ""),
    ("COUNTY", "string", "yes", ""),
    ("TOWNSHIP", "int", "yes", ""),
    ("TWN_DIR", "categorical", "yes", "S|N"),
    ("RANGE", "int", "yes", ""),
    ("RANGE_DIR", "categorical", "yes", "E|W"),
    ("SECTION", "int", "yes", ""),
    ("SPOT", "string", "yes", ""),
    ("LATITUDE", "float", "yes", ""),
    ("LONGITUDE", "float", "yes", ""),
    ("MONTH-YEAR", "string", "no", ""),
    ("PRODUCT", "categorical", "no", "O|G"),
    ("WELLS", "int", "yes", ""),
    ("PRODUCTION", "float", "yes", ""),
]
# Fixed value: the archive files carry one more column.
ARCHIVE = [*MONTHLY, ("URL", "string", "yes", "")]


def build_schema(rows: Iterable[tuple[str, str, str, str]]) -> T.StructType:
    """(column, label, nullable, categories) rows to a schema; the rules travel as field metadata."""
    fields = []
    for name, label, nullable, categories in rows:
        if label not in TYPES:
            raise ValueError(f"column '{name}' is declared as '{label}', which is no known type")
        declared = [c.strip() for c in categories.split("|") if c.strip()]
        metadata = {"dtype": label, "required": nullable == "no", "categories": declared}
        fields.append(T.StructField(name, TYPES[label], True, metadata))
    return T.StructType(fields)


def monthly_schema() -> T.StructType:
    return build_schema(MONTHLY)


def archive_schema() -> T.StructType:
    return build_schema(ARCHIVE)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary file as a table of texts, blanks kept as ``""``."""
    table = spark.read.csv(path, header=True, escape='"', multiLine=True)
    missing = [c for c in DICTIONARY_COLUMNS if c not in table.columns]
    if missing:
        raise ValueError(f"data dictionary lacks columns: {missing}")
    return table.select(*DICTIONARY_COLUMNS).na.fill("")


def with_types(dictionary: DataFrame) -> DataFrame:
    """Adds ``spark_type``, the type of each declared column; null for an unknown label."""
    kind = F.lit(None).cast("string")
    for label, declared in TYPES.items():
        kind = F.when(F.col("dtype") == label, declared.simpleString()).otherwise(kind)
    return dictionary.withColumn("spark_type", kind)


def load_dictionary(spark: SparkSession, path: str) -> list[dict[str, str]]:
    """The rows of a dictionary file. One row per column of the data."""
    return [row.asDict() for row in read_dictionary(spark, path).collect()]


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    rows = load_dictionary(spark, path)
    return build_schema((r["column"], r["dtype"], r["nullable"], r["categories"]) for r in rows)


def categories(schema: T.StructType) -> dict[str, list[str]]:
    """Declared value set of every categorical column."""
    return {
        f.name: f.metadata["categories"]
        for f in schema
        if f.metadata.get("dtype") == "categorical"
    }
