"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthspan.panel import Panel, col

_RANK = "_rank"


def keep_first(frame: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """The row with the smallest position of each key.

    Spark turns ``row_number = 1`` into a group limit on both sides of the shuffle, so every task
    sends at most one row per key however often the key repeats. That holds only while the shuffle
    belongs to this window: repartitioning the input by key beforehand would send all copies.
    """
    first = Window.partitionBy(*map(col, keys)).orderBy(*map(col, position))
    return frame.withColumn(_RANK, F.row_number().over(first)).filter(f"{_RANK} = 1").drop(_RANK)


def deduplicate(
    frame: DataFrame, position: Sequence[str], panel: Panel = Panel()
) -> DataFrame:
    """First row of each (entity, date), or of each (entity, date, product)."""
    return keep_first(frame, panel.keys, position)
