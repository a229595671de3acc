"""Reading texts of the form M-YYYY.

Filters are pushed below the projections they refer to and repeat their expressions there, so each
question is kept short.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. A date holds the years 1 to 9999.
DIGITS = r"^[0-9]+$"
TWO_NUMBERS = r"^[0-9]+-[0-9]+(?:-|$)"
YEARLY_TOTAL = r"^0+-"
MONTH = r"^0*(?:[1-9]|1[0-2])-[0-9]+(?:-|$)"
DATE = r"^0*(?:[1-9]|1[0-2])-0*[1-9][0-9]{0,3}(?:-|$)"


def is_from_year(text: Column, min_year: int) -> Column:
    """Is the last piece a number, and not before ``min_year``? Never null."""
    piece = F.substring_index(text, "-", -1)
    return F.coalesce(piece.rlike(DIGITS) & (piece.try_cast("bigint") >= min_year), F.lit(False))


def is_month(text: Column) -> Column:
    """Are the first two pieces a month, 1 to 12, and a year of any size?

    Not so for a yearly total (month 0) or a starting value (month -1).
    """
    return F.coalesce(text.rlike(MONTH), F.lit(False))


def claims_month(text: Column) -> Column:
    """Are the first two pieces numbers, the first of them not 0?"""
    claims = text.rlike(TWO_NUMBERS) & ~text.rlike(YEARLY_TOTAL)
    return F.coalesce(claims, F.lit(False))


def month_start(text: Column) -> Column:
    """First day of the month; null for what is no month and for a year that no date can hold."""
    month = F.substring_index(text, "-", 1).try_cast("int")
    year = F.substring_index(F.substring_index(text, "-", 2), "-", -1).try_cast("int")
    return F.when(text.rlike(DATE), F.make_date(year, month, F.lit(1)))


def why_no_month(text: Column) -> Column:
    """The reason why a text that claims a month has no date; null for texts that claim none."""
    return (
        F.when(text.rlike(DATE), F.lit(None).cast("string"))
        .when(is_month(text), F.lit("no date has the year"))
        .when(claims_month(text), F.lit("no such month"))
    )
