import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from monthspan import Panel
from monthspan.operators import calendar, clean, dedup, features
from monthspan.sources.dictionary import monthly_schema
from tests.helpers import (
    LEASE, model_features, model_filled, model_unique, month, oil, panel, values,
)

SCHEMA = monthly_schema()
BY_PRODUCT = Panel(by_product=True)
WATER = Panel(water="WATER")


# Cleaning


def test_parse_date(spark):
    texts = ["1-2024", "0-2024", "-1-2024", "13-2024", "x-2024", None, "12-2024"]
    frame = spark.createDataFrame([(t, 0.0) for t in texts], "`MONTH-YEAR` string, PRODUCTION double")
    parsed = clean.parse_date(frame)
    assert parsed.columns == ["MONTH-YEAR", "PRODUCTION", "production_date"]
    assert [tuple(r) for r in parsed.collect()] == [
        ("1-2024", 0.0, dt.date(2024, 1, 1)), ("12-2024", 0.0, dt.date(2024, 12, 1)),
    ]
    with pytest.raises(PySparkException, match="no such month: 13-2024"):
        clean.parse_date(frame, on_bad_date="fail").collect()
    good = frame.filter("`MONTH-YEAR` is null or `MONTH-YEAR` <> '13-2024'")
    assert clean.parse_date(good, on_bad_date="fail").count() == 2
    with pytest.raises(ValueError):
        clean.parse_date(frame, on_bad_date="skip")


def test_cast_categoricals(spark):
    frame = spark.createDataFrame(
        [("X", "S", "E"), ("O", "S", "X"), (None, "N", "W")], ["PRODUCT", "TWN_DIR", "RANGE_DIR"]
    )
    assert [tuple(r) for r in clean.cast_categoricals(frame, SCHEMA).collect()] == [
        (None, "S", "E"), ("O", "S", None), (None, "N", "W"),
    ]


@pytest.mark.parametrize(
    ("volume", "product", "expected"),
    [(-5.0, "O", None), (100000.0, "O", None), (0.0, "O", 0.0), (100000.0, "G", 100000.0),
     (50000.0, "O", 50000.0), (-1.0, None, None), (60000.0, None, 60000.0), (None, "O", None),
     (float("inf"), "O", None), (float("inf"), "G", float("inf"))],
)
def test_validate_bounds(spark, volume, product, expected):
    frame = spark.createDataFrame([(volume, product)], "PRODUCTION double, PRODUCT string")
    assert clean.validate_bounds(frame).first()["PRODUCTION"] == expected


# Deduplication


def test_first_row_wins_and_a_second_pass_changes_nothing(spark):
    rows = panel(spark, [(1, 100, "O"), (1, 200, "G"), (2, 5, "O")])
    rows = rows.withColumn("pos", F.when(F.col("PRODUCTION") == 200, 2).otherwise(1))
    once = dedup.deduplicate(rows, ["pos"])
    assert values(once, "PRODUCTION") == [100.0, 5.0]
    assert once.exceptAll(dedup.deduplicate(once, ["pos"])).count() == 0
    assert dedup.deduplicate(rows, ["pos"], BY_PRODUCT).count() == 3


def test_repeats_are_dropped_before_the_shuffle(spark):
    """A third of all rows share one key; the plan limits that key on both sides of the exchange."""
    rows = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(LEASE)).otherwise(F.col("id")).alias("LEASE_KID"),
        F.lit(month(1)).alias("production_date"),
        F.col("id").alias("pos"),
    )
    unique = dedup.deduplicate(rows, ["pos"])
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert unique.count() == 20001
    assert unique.filter(F.col("LEASE_KID") == LEASE).first()["pos"] == 0


# Calendar


def test_gap_is_filled_with_zero_and_latest_values(spark):
    rows = panel(spark, [(1, 100, "O"), (3, 200, "O")]).withColumn(
        "FIELD", F.when(F.month("production_date") == 1, "A")
    )
    filled = calendar.fill_date_gaps(rows, mark_filled="is_filled")
    assert filled.columns == [*rows.columns, "is_filled"]
    assert values(filled, "production_date") == [month(1), month(2), month(3)]
    assert values(filled, "PRODUCTION") == [100.0, 0.0, 200.0]
    assert values(filled, "PRODUCT") == ["O"] * 3
    assert values(filled, "FIELD") == ["A"] * 3
    assert values(filled, "is_filled") == [False, True, False]
    assert set(values(filled, "LEASE_KID")) == {LEASE}


def test_gap_fill_over_a_year_and_again(spark):
    rows = panel(spark, [(1, 0, "O"), (15, 100, "O")])
    filled = calendar.fill_date_gaps(rows)
    assert values(filled, "production_date") == [month(i) for i in range(1, 16)]
    assert values(filled, "PRODUCTION") == [0.0] * 14 + [100.0]
    assert filled.exceptAll(calendar.fill_date_gaps(filled)).count() == 0


def test_missing_volumes(spark):
    rows = panel(spark, [(1, None, "O"), (3, 5, None)])
    assert values(calendar.fill_date_gaps(rows), "PRODUCTION") == [0.0, 0.0, 5.0]
    kept = calendar.fill_date_gaps(rows, zero_fill_nulls=False)
    assert values(kept, "PRODUCTION") == [None, 0.0, 5.0]
    assert values(kept, "PRODUCT") == ["O", "O", "O"]


def test_series_by_product(spark):
    rows = panel(spark, [(1, 1, "O"), (3, 3, "O"), (2, 5, "G")])
    filled = calendar.fill_date_gaps(rows, BY_PRODUCT)
    assert [(r["production_date"], r["PRODUCT"], r["PRODUCTION"]) for r in
            filled.orderBy("PRODUCT", "production_date").collect()] == [
        (month(2), "G", 5.0), (month(1), "O", 1.0), (month(2), "O", 0.0), (month(3), "O", 3.0),
    ]


def test_empty_panel_keeps_its_schema(spark):
    rows = oil(spark, 1).filter("false")
    filled = calendar.fill_date_gaps(rows)
    assert filled.count() == 0 and filled.columns == rows.columns
    made = features.add_features(filled)
    assert made.count() == 0 and made.columns == [*rows.columns, *features.FEATURES]
    assert {made.schema[c].dataType.simpleString() for c in features.FEATURES} == {"double"}


def test_entity_span(spark):
    row = calendar.entity_span(panel(spark, [(2, 1, "O"), (5, 1, "O")])).first()
    assert tuple(row) == (LEASE, month(2), month(5), 2, 4)


# Features


@pytest.mark.parametrize(
    ("volumes", "expected"),
    [((10, 20, 0, 5), [10, 30, 30, 35]), ((0, 0, 10), [0, 0, 10]), ((100, 50, 0, 200), [100, 150, 150, 350]),
     ((1, None, 2), [1, None, 3]), ((None, 4), [None, 4])],
)
def test_cumulative_oil(spark, volumes, expected):
    made = features.add_cumulative(oil(spark, *volumes))
    assert values(made, "cum_oil") == expected
    assert values(made, "cum_water") == [None] * len(volumes)


def test_cumulative_of_the_other_product_stays_flat(spark):
    made = features.add_cumulative(panel(spark, [(1, 10, "O"), (2, 7, "G"), (3, 1, None), (4, 2, "O")]))
    assert values(made, "cum_oil") == [10, 10, 10, 12]
    assert values(made, "cum_gas") == [0, 7, 7, 7]


@pytest.mark.parametrize(
    ("oil_volume", "gas_volume", "expected"),
    [(0, 5, None), (0, 0, None), (10, 0, 0.0), (10, 50, 5.0), (None, 5, None), (10, None, 0.0), (0.1, 1e6, 1e7)],
)
def test_gor(spark, oil_volume, gas_volume, expected):
    rows = panel(spark, [(1, oil_volume, "O"), (1, gas_volume, "G")])
    for make in (features.add_ratios, features.add_entity_ratios):
        made = make(rows, BY_PRODUCT)
        assert values(made, "gor") == [expected, expected]
        assert values(made, "water_cut") == [None, None]
        assert made.columns == [*rows.columns, "gor", "water_cut"]


@pytest.mark.parametrize(
    ("oil_volume", "water", "expected"),
    [(100, 0.0, 0.0), (0, 50.0, 1.0), (30, 10.0, 0.25), (10, -5.0, None), (-5, 10.0, None), (0, 0.0, None),
     (10, None, 0.0)],
)
def test_water_cut(spark, oil_volume, water, expected):
    rows = panel(spark, [(1, oil_volume, "O")]).withColumn("WATER", F.lit(water).cast("double"))
    assert values(features.add_ratios(rows, WATER), "water_cut") == [expected]


def test_cumulative_water(spark):
    rows = oil(spark, 1, 1, 1).withColumn("WATER", F.when(F.month("production_date") != 2, 3.0))
    assert values(features.add_cumulative(rows, WATER), "cum_water") == [3, None, 6]
    gap = panel(spark, [(1, 1, "O"), (3, 1, "O")]).withColumn("WATER", F.lit(3.0))
    assert values(calendar.fill_date_gaps(gap, WATER), "WATER") == [3, 0, 3]


@pytest.mark.parametrize(
    ("volumes", "expected"),
    [((100, 80), -0.2), ((100, 0), -1.0), ((1, 100), 10.0), ((0, 0), None), ((0, 5), None), ((10, 15), 0.5),
     ((100, -50), -1.0), ((None, 5), None), ((5, None), None)],
)
def test_decline_rate(spark, volumes, expected):
    rows = oil(spark, *volumes).unionByName(panel(spark, [(1, 7, "O")], lease=1))
    made = features.add_decline_rate(rows).filter(F.col("LEASE_KID") == LEASE)
    assert values(made, "decline_rate")[0] is None
    assert values(made, "decline_rate")[1] == (None if expected is None else pytest.approx(expected))


def test_infinite_volumes_make_no_nan(spark):
    inf = float("inf")
    made = features.add_features(panel(spark, [(1, inf, "G"), (2, 5, "G"), (3, inf, "G"), (4, inf, "G"), (5, 1, "G")]))
    assert values(made, "decline_rate") == [None, None, 10.0, None, None]
    assert values(made, "rolling_3m_gas") == [None] * 5
    assert values(made, "cum_gas") == [inf] * 5


def test_rolling(spark):
    made = features.add_rolling(oil(spark, 100, 200, 300, 400))
    assert values(made, "rolling_3m_oil") == [None, None, 200, 300]
    assert values(made, "rolling_6m_oil") == [None] * 4
    assert values(made, "rolling_3m_gas") == [None] * 4
    six = features.add_rolling(oil(spark, *range(1, 9)))
    assert values(six, "rolling_6m_oil") == [None] * 5 + [3.5, 4.5, 5.5]
    broken = features.add_rolling(panel(spark, [(1, 1, "O"), (2, 2, "G"), (3, 3, "O"), (4, 5, "O"), (5, 7, "O")]))
    assert values(broken, "rolling_3m_oil") == [None, None, None, None, 5]


def test_lags(spark):
    made = features.add_lags(oil(spark, 10, 20, 30))
    assert values(made, "lag1_oil") == [None, 10, 20]
    mixed = features.add_lags(panel(spark, [(1, 10, "O"), (2, 20, "G"), (3, 30, "O")]))
    assert values(mixed, "lag1_oil") == [None, 10, None]
    assert values(mixed, "lag1_gas") == [None, None, 20]


def test_months_shared_by_oil_and_gas(spark):
    rows = panel(spark, [(1, 10, "O"), (1, 50, "G"), (2, 20, "O"), (2, 60, "G")])
    made = features.add_features(rows, BY_PRODUCT)
    assert values(made, "cum_oil") == [10, 0, 30, 0]
    assert values(made, "cum_gas") == [0, 50, 0, 110]
    assert values(made, "gor") == [5, 5, 3, 3]
    assert values(made, "lag1_oil") == [None, None, 10, None]


# The whole chain against a plain-Python model, however the rows are spread


def random_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    return [
        (
            rng.randint(1, 6),
            month(rng.randint(1, 40)),
            rng.choice(["O", "O", "G", None]),
            rng.choice([None, 0.0, float(rng.randint(1, 900))]),
            rng.choice([None, "a", "b"]),
        )
        for _ in range(120)
    ]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_chain_equals_the_model(spark, seed, partitions):
    rows = random_rows(seed)
    columns = "LEASE_KID long, production_date date, PRODUCT string, PRODUCTION double, FIELD string, pos long"
    data = [(*row, i) for i, row in enumerate(rows)]
    random.Random(seed).shuffle(data)
    frame = spark.createDataFrame(data, columns).repartition(partitions)
    filled = frame.transform(dedup.deduplicate, ["pos"]).drop("pos").transform(calendar.fill_date_gaps)
    made = [r.asDict() for r in features.add_features(filled).orderBy("LEASE_KID", "production_date").collect()]
    expected = model_filled(model_unique(rows))
    names = ["LEASE_KID", "production_date", "PRODUCT", "PRODUCTION", "FIELD"]
    assert [tuple(r[n] for n in names) for r in made] == expected
    for mine, model in zip(made, model_features(expected)):
        for name, value in model.items():
            assert mine[name] == (None if value is None else pytest.approx(value, rel=1e-9)), name


def test_a_gap_beyond_a_thousand_years_is_an_error(spark):
    rows = spark.createDataFrame(
        [(1, dt.date(1, 1, 1), 1.0, "O"), (1, dt.date(2000, 1, 1), 2.0, "O")],
        "LEASE_KID bigint, production_date date, PRODUCTION double, PRODUCT string",
    )
    with pytest.raises(PySparkException, match="a gap of more than 12000 months"):
        calendar.fill_date_gaps(rows).collect()


def test_products_have_windows_of_their_own(spark):
    rows = panel(spark, [(m, v, p) for m in (1, 2, 3) for p, v in (("O", 10 * m), ("G", 100 * m))])
    made = features.add_features(rows, BY_PRODUCT)
    oil_rows, gas_rows = (made.filter(f"PRODUCT = '{p}'") for p in "OG")
    assert values(oil_rows, "cum_oil") == [10, 30, 60] and values(gas_rows, "cum_gas") == [100, 300, 600]
    assert values(oil_rows, "rolling_3m_oil") == [None, None, 20]
    assert values(gas_rows, "rolling_3m_gas") == [None, None, 200]
    assert values(gas_rows, "lag1_gas") == [None, 100, 200]
    assert values(gas_rows, "decline_rate") == [None, 1.0, 0.5]
    assert values(made, "gor") == [10.0] * 6
    mixed = features.add_features(rows)
    assert values(mixed.filter("PRODUCT = 'O'"), "rolling_3m_oil") == [None] * 3


def test_water_has_averages_and_a_lag(spark):
    rows = oil(spark, 1, 2, 3, 4).selectExpr("*", "PRODUCTION * 2 as WATER")
    made = features.add_features(rows, Panel(water="WATER"))
    assert values(made, "rolling_3m_water") == [None, None, 4.0, 6.0]
    assert values(made, "rolling_6m_water") == [None] * 4
    assert values(made, "lag1_water") == [None, 2.0, 4.0, 6.0]
    assert made.columns[-3:] == features.WATER_FEATURES
