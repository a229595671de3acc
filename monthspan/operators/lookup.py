"""Joining one value per key to many rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEY = "_lookup_key"


def look_up(frame: DataFrame, key: str, lookup: DataFrame) -> DataFrame:
    """Add the other columns of ``lookup``, which has one row per key, to the rows of ``frame``.

    One key, or the rows without a key, may be a large part of the frame. Spark splits such a
    partition among tasks, but only when both sides of the join come straight from a shuffle. The
    lookup has mostly just been grouped by the key, and Spark would join that without shuffling it
    again; wrapping the key makes it a new one, so the lookup, the small side, is shuffled too.
    """
    keyed = lookup.filter(F.col(key).isNotNull()).withColumn(_KEY, F.struct(key)).drop(key)
    joined = frame.withColumn(_KEY, F.struct(key)).join(keyed, _KEY, "left")
    return joined.drop(_KEY)
