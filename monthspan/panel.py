"""Column roles of a monthly panel, and the windows every operator shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

# Fixed values of the data model.
OIL = "O"
GAS = "G"
OIL_CAP = 50_000.0
DECLINE_MIN = -1.0
DECLINE_MAX = 10.0
DEFAULT_MIN_YEAR = 2024
# Reported rows that a task may get where they are stretched, collected or sorted whole.
ROWS_PER_TASK = 50_000


def col(name: str) -> Column:
    """Column by its exact name, safe for names such as MONTH-YEAR."""
    return F.col(f"`{name}`")


def task_count(spark: SparkSession, rows: int = 0) -> int:
    """Tasks for that many rows: the session's shuffle partitions, or more, so that no task's share grows with the table.

    Given to ``repartition``, it also keeps Spark from merging partitions by the bytes that they have before their
    rows are stretched.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


@dataclass(frozen=True)
class Panel:
    """Which column plays which role.

    ``by_product=True`` keeps oil and gas rows of one month apart: the row key becomes
    (entity, date, product) instead of (entity, date).
    """

    entity: str = "LEASE_KID"
    date: str = "production_date"
    month_year: str = "MONTH-YEAR"
    product: str = "PRODUCT"
    volume: str = "PRODUCTION"
    water: str | None = None
    by_product: bool = False

    @property
    def keys(self) -> list[str]:
        """Columns that identify a row after deduplication."""
        return [self.entity, self.date] + ([self.product] if self.by_product else [])

    @property
    def series(self) -> list[str]:
        """Columns that identify one gap-free run of months."""
        return [self.entity] + ([self.product] if self.by_product else [])

    @property
    def volumes(self) -> list[str]:
        """Columns that are zero, not carried over, in a month without a report."""
        return [self.volume] + ([self.water] if self.water else [])

    def along_series(self) -> WindowSpec:
        """All rows of an entity, or of an entity's product, in date order."""
        return Window.partitionBy(*map(col, self.series)).orderBy(col(self.date))

    def is_product(self, product: str) -> Column:
        """True or false, never null: a row without product is neither oil nor gas."""
        return F.coalesce(col(self.product) == product, F.lit(False))

    def own_volume(self, product: str) -> Column:
        """The row's volume when the row is of this product, else null."""
        return F.when(self.is_product(product), col(self.volume))
