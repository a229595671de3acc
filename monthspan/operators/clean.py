"""Row cleaning: dates, category sets, physical bounds. Projections and filters only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthspan.functions.months import claims_month, is_month, month_start, why_no_month
from monthspan.operators import rejects
from monthspan.panel import OIL, OIL_CAP, Panel, col
from monthspan.sources.dictionary import categories


def parse_date(frame: DataFrame, panel: Panel = Panel(), on_bad_date: str = "drop") -> DataFrame:
    """Append the month as a date; drop rows that are no month.

    Yearly totals (month 0) and starting values (month -1) always go. A month above 12 goes too, or
    is an error with ``on_bad_date="fail"``. Years 1 to 9999 are kept; a month of any other year is
    always an error, as no date can hold it.
    """
    return rejects.strict(checked_date(frame, panel, on_bad_date))


def checked_date(frame: DataFrame, panel: Panel = Panel(), on_bad_date: str = "drop") -> DataFrame:
    """As ``parse_date``, but errors are faults of the rows, whose date is null."""
    if on_bad_date not in ("drop", "fail"):
        raise ValueError(f"on_bad_date is 'drop' or 'fail', not '{on_bad_date}'")
    text = col(panel.month_year)
    dated = frame.filter(is_month(text) if on_bad_date == "drop" else claims_month(text))
    dated = dated.withColumn(panel.date, month_start(text))
    return rejects.with_faults(dated, [rejects.fault(panel.month_year, text, why_no_month(text))])


def cast_categoricals(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Null every category value outside its declared set; rows stay."""
    declared = {n: c for n, c in categories(schema).items() if n in frame.columns}
    return frame.withColumns({n: F.when(col(n).isin(c), col(n)) for n, c in declared.items()})


def validate_bounds(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Null negative volumes, and oil volumes above the monthly cap."""
    volume = col(panel.volume)
    invalid = (volume < 0) | (panel.is_product(OIL) & (volume > OIL_CAP))
    return frame.withColumn(panel.volume, F.when(invalid, F.lit(None)).otherwise(volume))


def clean_rows(
    frame: DataFrame, schema: T.StructType, panel: Panel = Panel(), on_bad_date: str = "drop"
) -> DataFrame:
    return rejects.strict(checked_rows(frame, schema, panel, on_bad_date))


def checked_rows(
    frame: DataFrame, schema: T.StructType, panel: Panel = Panel(), on_bad_date: str = "drop"
) -> DataFrame:
    """As ``clean_rows``, with the rows' faults."""
    return (
        frame.transform(checked_date, panel, on_bad_date)
        .transform(cast_categoricals, schema)
        .transform(validate_bounds, panel)
    )
