"""Window features of a panel.

Windows run over the rows of one series in date order: all rows of an entity, other products
included, or with ``Panel.by_product`` the rows of one product. The input is one row per key
(``Panel.keys``), so a series' rows are bounded by the calendar. Every window partitions by the entity,
alone or with more, so one shuffle by entity serves them all.

A feature is described by the window values it needs and by what it makes of them. The window values
become columns first, so that each is computed once however many features refer to it.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthspan.functions.volumes import clip, finite, not_nan, ratio, share
from monthspan.operators.lookup import look_up
from monthspan.panel import DECLINE_MAX, DECLINE_MIN, GAS, OIL, Panel, col

PRODUCTS = {"oil": OIL, "gas": GAS}
# The rolling windows, in months, and the features in their order.
ROLLING_MONTHS = (3, 6)
FEATURES = [
    "cum_oil",
    "cum_gas",
    "cum_water",
    "gor",
    "water_cut",
    "decline_rate",
    "rolling_3m_oil",
    "rolling_6m_oil",
    "rolling_3m_gas",
    "rolling_6m_gas",
    "lag1_oil",
    "lag1_gas",
]
WATER_FEATURES = ["rolling_3m_water", "rolling_6m_water", "lag1_water"]


class Feature(NamedTuple):
    windows: dict[str, Column]
    results: dict[str, Column]


def add_cumulative(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Running totals per product. Rows of the other product add nothing; a row of the product
    without a volume has no total, and the total goes on after it."""
    return _apply(frame, [_cumulative(panel)])


def add_ratios(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Gas-oil ratio and water cut of each (entity, date), on every row of the pair."""
    return _apply(frame, [_ratios(panel)])


def add_entity_ratios(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """The same ratios per entity, for a table without dates.

    Rows per entity are unbounded here, so the sums are aggregated (partly before the shuffle) and
    looked up; a hot entity can be split in that join, but not in a window.
    """
    totals = frame.groupBy(col(panel.entity)).agg(
        *[F.sum(volume).alias(name) for name, volume in _month_volumes(panel).items()]
    )
    joined = look_up(frame, panel.entity, totals)
    return joined.select(*map(col, frame.columns), *_named(_ratio_results(panel)))


def add_decline_rate(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Relative change against the previous row, clipped; null after a zero or missing volume."""
    return _apply(frame, [_decline(panel)])


def add_rolling(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """Mean of the last n rows per product; null unless all n hold a volume of the product."""
    return _apply(frame, [_rolling(panel)])


def add_lags(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """The previous row's volume, when that row is of the product."""
    return _apply(frame, [_lags(panel)])


def add_features(frame: DataFrame, panel: Panel = Panel()) -> DataFrame:
    """All twelve features, in their fixed order; with a water column also its averages and lag."""
    parts = [_cumulative, _ratios, _decline, _rolling, _lags]
    names = FEATURES + (WATER_FEATURES if panel.water else [])
    return _apply(frame, [part(panel) for part in parts]).select(*map(col, frame.columns), *names)


def _apply(frame: DataFrame, parts: list[Feature]) -> DataFrame:
    windows = {name: value for part in parts for name, value in part.windows.items()}
    results = {name: value for part in parts for name, value in part.results.items()}
    return frame.withColumns(windows).select(*map(col, frame.columns), *_named(results))


def _named(columns: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]


def _null() -> Column:
    return F.lit(None).cast("double")


def _cumulative(panel: Panel) -> Feature:
    so_far = panel.along_series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    volumes = {name: (panel.is_product(letter), col(panel.volume)) for name, letter in PRODUCTS.items()}
    if panel.water:
        volumes["water"] = (F.lit(True), col(panel.water))
    windows, results = {}, {}
    for name, (own, volume) in volumes.items():
        windows[f"_total_{name}"] = F.sum(F.when(own, volume).otherwise(0.0)).over(so_far)
        results[f"cum_{name}"] = F.when(~own | volume.isNotNull(), F.col(f"_total_{name}"))
    return Feature(windows, {"cum_water": _null()} | results)


def _month_volumes(panel: Panel) -> dict[str, Column]:
    return {f"_month_{name}": volume for name, volume in _own_volumes(panel).items()}


def _ratio_results(panel: Panel) -> dict[str, Column]:
    oil, gas, water = (
        F.coalesce(F.col(f"_month_{name}"), F.lit(0.0)) for name in ("oil", "gas", "water")
    )
    cut = share(ratio(water, oil + water)) if panel.water else _null()
    return {"gor": ratio(gas, oil), "water_cut": cut}


def _ratios(panel: Panel) -> Feature:
    month = Window.partitionBy(col(panel.entity), col(panel.date))
    sums = {name: F.sum(volume).over(month) for name, volume in _month_volumes(panel).items()}
    return Feature(sums, _ratio_results(panel))


def _decline(panel: Panel) -> Feature:
    before = F.col("_before")
    rate = not_nan(F.try_divide(col(panel.volume) - before, before))
    return Feature(
        {"_before": F.lag(col(panel.volume)).over(panel.along_series())},
        {"decline_rate": clip(rate, DECLINE_MIN, DECLINE_MAX)},
    )


def _own_volumes(panel: Panel) -> dict[str, Column]:
    volumes = {name: panel.own_volume(letter) for name, letter in PRODUCTS.items()}
    return volumes | ({"water": col(panel.water)} if panel.water else {})


def _earlier(panel: Panel, name: str, rows_back: int) -> dict[str, Column]:
    """Own-product volumes of the 1 to ``rows_back`` previous rows."""
    volume, rows = _own_volumes(panel)[name], panel.along_series()
    return {f"_{name}_{back}": F.lag(volume, back).over(rows) for back in range(1, rows_back + 1)}


def _rolling(panel: Panel) -> Feature:
    # The sum of a row and its predecessors is null as soon as one of them is null or missing, which
    # is the rule for short windows too; offsets are cheaper than a sliding frame.
    windows, results = {}, {}
    for name, volume in _own_volumes(panel).items():
        earlier = _earlier(panel, name, max(ROLLING_MONTHS) - 1)
        windows |= earlier
        volumes = [finite(v) for v in [volume, *map(F.col, earlier)]]
        for months in ROLLING_MONTHS:
            results[f"rolling_{months}m_{name}"] = reduce(add, reversed(volumes[:months])) / months
    return Feature(windows, results)


def _lags(panel: Panel) -> Feature:
    names = list(_own_volumes(panel))
    windows = {key: value for name in names for key, value in _earlier(panel, name, 1).items()}
    return Feature(windows, {f"lag1_{name}": F.col(f"_{name}_1") for name in names})
