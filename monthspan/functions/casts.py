"""Text to typed value, column by column, as the data dictionary demands.

No cast raises an error: a value that can't be read is null, and a second expression tells why. So the order in
which filters and projections are worked out cannot matter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: texts that count as numbers. Spark alone would also take '1.0d' and 'NaN'. A text is
# matched before it is cast, because a failing try_cast costs an exception per row.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)\s*$"


def to_float(text: Column) -> Column:
    """Number or null; never NaN, never an error."""
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def _integer(text: Column) -> Column:
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))


def to_nullable_int(text: Column) -> Column:
    """'7' and '7.0' are 7; null for anything else."""
    number = to_float(text)
    return F.coalesce(_integer(text), F.when(number % 1 == 0, number.try_cast("bigint")))


def why_no_nullable_int(text: Column) -> Column:
    """The reason why a text is an error where an integer or nothing is expected; garbage is nothing."""
    wrong = to_float(text).isNotNull() & to_nullable_int(text).isNull()
    return F.when(wrong, F.lit("is not a whole number"))


def to_required_int(text: Column) -> Column:
    """Like an integer cast; fractions are cut off; null for blank or garbage."""
    return F.coalesce(_integer(text), to_float(text).try_cast("bigint"))


def why_no_required_int(text: Column) -> Column:
    """The reason why a text is an error where an integer is expected."""
    return F.when(to_required_int(text).isNull(), F.lit("needs a number"))


def to_text(text: Column) -> Column:
    """Blank becomes null."""
    return F.nullif(text, F.lit(""))
