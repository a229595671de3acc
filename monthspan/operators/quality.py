"""Data-quality checks. Unless said otherwise a check returns the offending rows: none means pass."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthspan.operators.calendar import entity_span
from monthspan.panel import GAS, OIL, OIL_CAP, Panel, col
from monthspan.sources.dictionary import categories
from monthspan.sources.files import file_name
from monthspan.sources.stages import read_stage


def write_checks(panel: Panel = Panel(), schema: T.StructType | None = None, columns: Sequence[str] = ()) -> dict[str, Column]:
    """Conditions by name that offending rows of a table meet, for checks in the pass that writes it: bounds, units,
    categories, running totals and gaps, as far as the table's ``columns`` tell. The windows are those of the
    features, so that they add no shuffle to a panel."""
    checks = {"bounds": _any(_bounds(panel, columns)), "units": _over_cap(panel)}
    if schema is not None:
        checks["category"] = _any([~col(n).isin(c) for n, c in categories(schema).items() if n in columns])
    if panel.date in columns:
        before = F.lag(col(panel.date)).over(panel.along_series())
        checks["complete"] = F.trunc(col(panel.date), "month") != F.add_months(F.trunc(before, "month"), 1)
    idle = {n: c for n, c in _idle_months(panel).items() if n in columns}
    if idle:
        earlier = panel.along_series().rowsBetween(Window.unboundedPreceding, -1)
        before = {n: F.last(F.col(n), ignorenulls=True).over(earlier) for n in idle}
        checks["monotone"] = _any([offence for n, c in idle.items() for offence in _falls(F.col(n), before[n], c)])
    return checks


def out_of_bounds(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Negative or infinite volume, negative gas-oil ratio, water cut outside [0, 1]."""
    return frame.filter(_any(_bounds(panel, frame.columns)))


def _bounds(panel: Panel, columns: Sequence[str]) -> list[Column]:
    volume = col(panel.volume)
    offences = [(volume < 0) | F.isnan(volume) | (F.abs(volume) == float("inf"))]
    if "gor" in columns:
        offences.append(F.col("gor") < 0)
    if "water_cut" in columns:
        offences.append(~F.col("water_cut").between(0.0, 1.0))
    return offences


def over_cap(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Oil volumes that can only be a unit error."""
    return frame.filter(_over_cap(panel))


def _over_cap(panel: Panel) -> Column:
    return panel.is_product(OIL) & (col(panel.volume) > OIL_CAP)


def not_monotone(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Running totals that fall, or that move in a month without volume of the product."""
    earlier = panel.along_series().rowsBetween(Window.unboundedPreceding, -1)
    marked = frame
    offences = []
    for total, idle in _idle_months(panel).items():
        before = f"_before_{total}"
        marked = marked.withColumn(before, F.last(F.col(total), ignorenulls=True).over(earlier))
        offences += _falls(F.col(total), F.col(before), idle)
    return marked.filter(_any(offences)).select(*map(col, frame.columns))


def _idle_months(panel: Panel) -> dict[str, Column]:
    """For each running total, whether a row's month has no volume of its product."""
    idle = {
        "cum_oil": panel.is_product(OIL) & (col(panel.volume) == 0),
        "cum_gas": panel.is_product(GAS) & (col(panel.volume) == 0),
    }
    return idle | ({"cum_water": col(panel.water) == 0} if panel.water else {})


def _falls(total: Column, before: Column, idle: Column) -> list[Column]:
    return [total < before, idle & (total != F.coalesce(before, F.lit(0.0)))]


def incomplete(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Entities whose number of rows differs from the months of their span."""
    return entity_span(frame, panel).filter("rows <> months")


def zero_and_null(raw: DataFrame, filled: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Reported zeros that were lost, and missing volumes that became zero.

    ``raw`` is deduplicated but neither bounded nor filled. The second kind is no fault when nulls
    are zero-filled on purpose; it is listed because it hides missing data.
    """
    both = _side_by_side(raw, filled, panel)
    lost = (F.col("raw_volume") == 0) & ~F.col("panel_volume").eqNullSafe(0.0)
    hidden = F.col("raw_volume").isNull() & (F.col("panel_volume") == 0)
    finding = F.when(lost, "zero_lost").when(hidden, "null_to_zero")
    return both.withColumn("finding", finding).filter("finding is not null")


def spot_check(
    raw: DataFrame, filled: DataFrame, panel: Panel = Panel(), one_in: int = 1
) -> DataFrame:
    """Raw against processed volume for a sample of the keys: those whose entity and month, counted
    from year 0, add up to a multiple of ``one_in``. Every row has ``agrees``; false is an offence.

    A volume out of bounds is expected to be missing or zero in the panel.
    """
    if one_in > 1:
        month = F.year(col(panel.date)) * 12 + F.month(col(panel.date))
        raw = raw.filter(F.pmod(col(panel.entity) + month, F.lit(one_in)) == 0)
    raw_volume, panel_volume = F.col("raw_volume"), F.col("panel_volume")
    invalid = (raw_volume < 0) | (panel.is_product(OIL) & (raw_volume > OIL_CAP))
    unknown = F.coalesce(invalid, F.lit(True))
    agrees = F.when(unknown, F.coalesce(panel_volume, F.lit(0.0)) == 0).otherwise(
        raw_volume.eqNullSafe(panel_volume)
    )
    return _side_by_side(raw, filled, panel).withColumn("agrees", agrees)


def row_counts(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Rows before and after deduplication, and keys that it takes rows from, in one aggregation."""
    keys = frame.groupBy(*map(col, panel.keys)).agg(F.count("*").alias("_rows"))
    counts = keys.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("before"),
        F.count("*").alias("after"),
        F.count_if(F.col("_rows") > 1).alias("repeated_keys"),
    )
    return counts.unpivot([], counts.columns, "measure", "rows")


def out_of_order(spark: SparkSession, directory: str, panel: Panel = Panel()) -> DataFrame:
    """Rows of a stage table that come before an earlier month of their entity, in file order.

    A row is compared with the one before it. Rows of one piece of a file are compared where they are read; the
    pieces then meet as summaries, one row per entity and piece with its first and last month, so a hot entity moves
    no more than that and its offences. A month may stand twice only by product.
    """
    rows = read_stage(spark, directory).select(
        col(panel.entity).alias("entity"),
        F.unix_date(col(panel.date).cast("date")).alias("day"),
        file_name().alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.row_index").alias("row_index"),
    )
    kind = rows.schema["entity"].dataType.simpleString()
    schema = f"entity {kind}, file_name string, row_index bigint, first int, last int, offends boolean"
    found = rows.mapInArrow(_in_pieces(0 if panel.by_product else 1), schema)
    # Offences are rows of the result already, each apart; only summaries follow on each other.
    alone = F.when(F.col("offends"), F.col("row_index")).otherwise(F.lit(-1))
    pieces = Window.partitionBy("entity", alone).orderBy("file_name", "row_index")
    before = F.lag("last").over(pieces)
    least = F.col("_before") + (0 if panel.by_product else 1)
    late = F.col("offends") | (F.col("_before").isNotNull() & (F.col("first") < least))
    return found.withColumn("_before", before).filter(late).select(
        F.col("entity").alias(panel.entity),
        F.date_from_unix_date("first").alias(panel.date),
        "file_name",
        "row_index",
    )


def _in_pieces(step: int):
    """Offences inside each piece of a file, and a summary of every entity's rows there.

    A day is an offence when it is below the entity's day before plus ``step``. What is held is one entry per entity
    of the piece being read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held, kind = None, {}, None

        def batch_of(entities, name, places, first, last, offends):
            n = len(entities)
            columns = [
                pa.array(entities, kind), pa.array([name] * n, pa.string()), pa.array(places, pa.int64()),
                pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array([offends] * n, pa.bool_()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["entity", "file_name", "row_index", "first", "last", "offends"])

        def summary():
            places, first, last = zip(*held.values())
            return batch_of(list(held), piece[0], places, first, last, False)

        for batch in batches:
            kind = batch.schema.field("entity").type
            names, blocks = batch.column("file_name").to_pylist(), batch.column("block").to_pylist()
            starts = [i for i in range(len(names)) if not i or (names[i], blocks[i]) != (names[i - 1], blocks[i - 1])]
            for start, end in zip(starts, [*starts[1:], len(names)]):
                if (names[start], blocks[start]) != piece:
                    if held:
                        yield summary()
                    piece, held = (names[start], blocks[start]), {}
                part = batch.slice(start, end - start)
                entities, days = part.column("entity").to_pylist(), part.column("day").to_pylist()
                bad, first_place = [], part.column("row_index")[0].as_py()
                for i, (entity, day) in enumerate(zip(entities, days)):
                    known = held.get(entity)
                    if known is None:
                        held[entity] = [first_place + i, day, day]
                        continue
                    if day is not None and known[2] is not None and day < known[2] + step:
                        bad.append(i)
                    known[2] = day
                if bad:
                    places = [first_place + i for i in bad]
                    yield batch_of([entities[i] for i in bad], piece[0], places, [days[i] for i in bad], [None] * len(bad), True)
        if held:
            yield summary()

    return work


def undeclared_categories(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with a category value outside its declared set."""
    declared = {n: c for n, c in categories(schema).items() if n in frame.columns}
    return frame.filter(_any([~col(n).isin(c) for n, c in declared.items()]))


def _any(offences: list[Column]) -> Column:
    return reduce(Column.__or__, [F.coalesce(o, F.lit(False)) for o in offences])


def _side_by_side(raw: DataFrame, filled: DataFrame, panel: Panel) -> DataFrame:
    """Volumes of both tables by key. Only a product may be null, and then equals a null product."""
    named = [panel.entity, panel.date, panel.product]
    left = raw.select(*map(col, named), col(panel.volume).alias("raw_volume"))
    right = filled.select(
        *[col(k).alias(f"_{k}") for k in panel.keys], col(panel.volume).alias("panel_volume")
    )
    same = [col(k) == col(f"_{k}") for k in (panel.entity, panel.date)]
    if panel.by_product:
        same.append(col(panel.product).eqNullSafe(col(f"_{panel.product}")))
    return left.join(right, same, "left").select(*map(col, named), "raw_volume", "panel_volume")
