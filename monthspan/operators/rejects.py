"""Errors as data: rows carry the faults found in them.

A checked step adds to the array column ``faults`` instead of raising an error, and puts null where a value could
not be read. What happens to faulty rows is decided later: they are kept apart (``accepted`` and ``rejected``), or
the first one ends the query (``strict``). The error is raised by an expression that itself asks whether there are
faults, so it holds under any order of evaluation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAULTS = "faults"
FAULT_TYPE = "array<struct<column: string, text: string, reason: string>>"


class RejectedRows(ValueError):
    """Faulty rows were kept apart; ``count`` of them, in the table ``directory``."""

    def __init__(self, count: int, directory: str, examples: Sequence[str]):
        super().__init__(f"{count} rows with faults, kept in {directory}, such as: " + "; ".join(examples))
        self.count, self.directory = count, directory


def fault(column: str | None, text: Column, reason: Column) -> Column:
    """An array of one fault where there is a reason, else of none."""
    found = F.struct(
        F.lit(column).cast("string").alias("column"), text.cast("string").alias("text"), reason.alias("reason")
    )
    return F.when(reason.isNotNull(), F.array(found).cast(FAULT_TYPE)).otherwise(none())


def none() -> Column:
    return F.array().cast(FAULT_TYPE)


def with_faults(frame: DataFrame, faults: Sequence[Column]) -> DataFrame:
    """Add arrays of faults to those that the rows have."""
    known = [F.col(FAULTS)] if FAULTS in frame.columns else []
    found = [*known, *faults]
    return frame.withColumn(FAULTS, F.concat(*found) if found else none())


def accepted(frame: DataFrame) -> DataFrame:
    """Rows without faults."""
    return frame.filter(F.size(FAULTS) == 0).drop(FAULTS)


def rejected(frame: DataFrame, place: Sequence[str]) -> DataFrame:
    """One row per fault: the columns that tell the row's place, column, text and reason."""
    found = frame.filter(F.size(FAULTS) > 0).select(*place, F.explode(FAULTS).alias("fault"))
    return found.select(*place, "fault.column", "fault.text", "fault.reason")


def strict(frame: DataFrame, where: Column | None = None) -> DataFrame:
    """Rows as they are; a faulty one is an error that names its first fault and ``where`` it stands."""
    first = F.get(FAULTS, F.lit(0))
    message = F.concat_ws(
        " ",
        F.concat(F.lit("column "), first["column"]),
        F.concat(first["reason"], F.lit(": "), F.coalesce(first["text"], F.lit("null"))),
        F.concat(F.lit("in "), where) if where is not None else F.lit(None).cast("string"),
    )
    good = F.when(F.size(FAULTS) == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return frame.filter(good).drop(FAULTS)
