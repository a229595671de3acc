"""Calendar operators: date spans and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthspan.panel import Panel, col, task_count

# Months that a gap may have; a longer one can only be a wrong year.
MOST_MONTHS = 12_000

_NEXT = "_next_date"
_MONTH = "_month"


def entity_span(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """First and last month of every entity, its rows, and the months its span covers."""
    first, last = F.min(col(panel.date)), F.max(col(panel.date))
    return frame.groupBy(col(panel.entity)).agg(
        first.alias("first_date"),
        last.alias("last_date"),
        F.count("*").alias("rows"),
        (F.months_between(last, first).cast("bigint") + 1).alias("months"),
    )


def fill_date_gaps(
    frame: DataFrame,
    panel: Panel = Panel(),
    zero_fill_nulls: bool = True,
    mark_filled: str | None = None,
    rows: int = 0,
) -> DataFrame:
    """Give every series all months between its first and its last.

    An inserted month has volume 0 and the latest known value of every other column; nulls in
    existing rows take the latest known value as well. A null volume of an existing row becomes 0,
    or stays null with ``zero_fill_nulls=False``. ``mark_filled`` names an optional boolean column.

    Needs unique (series, date), as ``deduplicate`` leaves it. Each row is stretched up to the month
    before the next row of its series, so there is no calendar table and no join: one shuffle by
    entity, on rows that deduplication has bounded to one per month and product. ``rows``, where the caller knows about
    how many there are, sets its number of partitions, so that what a task stretches and sorts is bounded.

    A gap of more than ``MOST_MONTHS`` months is an error; nothing is dropped or cut short.
    """
    # Rows of an entity together serve the windows by product as well as those by month.
    frame = frame.repartition(task_count(frame.sparkSession, rows), col(panel.entity))
    in_order = panel.along_series()
    known = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = {*panel.series, panel.date, *panel.volumes}
    carried = [c for c in frame.columns if c not in fixed]
    known_so_far = frame.withColumns(
        {c: F.last(col(c), ignorenulls=True).over(known) for c in carried}
        | {_NEXT: F.lead(col(panel.date)).over(in_order)}
    )
    too_long = F.raise_error(
        F.concat(F.lit(f"a gap of more than {MOST_MONTHS} months ends with "), col(_NEXT).cast("string"))
    ).cast("date")
    until = F.when(F.months_between(_NEXT, col(panel.date)) > MOST_MONTHS, too_long).otherwise(
        F.greatest(col(panel.date), F.add_months(col(_NEXT), -1))
    )
    stretched = known_so_far.withColumn(
        _MONTH, F.explode(F.sequence(col(panel.date), until, F.expr("interval 1 month")))
    )
    is_inserted = col(_MONTH) != col(panel.date)
    replaced = {panel.date: col(_MONTH)}
    for volume in panel.volumes:
        reported = F.coalesce(col(volume), F.lit(0.0)) if zero_fill_nulls else col(volume)
        replaced[volume] = F.when(is_inserted, F.lit(0.0)).otherwise(reported)
    columns = [replaced.get(c, col(c)).alias(c) for c in frame.columns]
    if mark_filled:
        columns.append(is_inserted.alias(mark_filled))
    return stretched.select(*columns)
