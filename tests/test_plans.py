"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from monthspan.operators import calendar, features
from monthspan.plans.queries import QUERIES
from tests.helpers import oil

SF = "/root/testdata/sf0.001"
LAZY = [n for n in QUERIES if n not in {
    "raw_scan", "union_files", "source_files", "dictionary_scan", "clamped_files", "entity_layout", "schema_drift",
    "file_order", "stage_roundtrip", "acquire_job", "ingest_job", "transform_job", "features_job", "whole_run",
    "all_stages", "rejected_rows", "stage_report", "committed_versions",
}]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node


def test_two_shuffles_for_the_whole_chain(spark):
    plan = plan_of(QUERIES["features_all"](spark, SF))
    assert plan.count("Exchange ") == 2
    assert "Exchange hashpartitioning(LEASE_KID" in plan


@pytest.mark.parametrize("name", ["features_product", "ratio_features", "fill_date_gaps_product"])
def test_two_shuffles_by_product(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert plan.count("Exchange ") == 2
    assert "Exchange hashpartitioning(LEASE_KID#" in plan


def test_features_after_gap_filling_add_no_shuffle(spark):
    filled = calendar.fill_date_gaps(oil(spark, 1, 2))
    assert plan_of(filled).count("Exchange ") == 1
    assert plan_of(features.add_features(filled)).count("Exchange ") == 1


def test_each_window_value_is_computed_once(spark):
    plan = plan_of(features.add_features(oil(spark, 1, 2)))
    offsets = [line for line in plan.splitlines() if "lag(" in line]
    assert len(offsets) == 1
    assert offsets[0].count("lag(") == 11


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["entity_span"](spark, SF))
    schema = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert "o_totalprice" not in schema and "o_orderstatus" not in schema


def test_cleaning_shuffles_nothing(spark):
    for name in ("clean_rows", "typed_cast", "year_filter", "dq_bounds", "page_parameters"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, SF)), name


def test_a_hot_entity_is_split_in_the_ratio_join(spark):
    """A third of all rows is one entity: the join reads its partition in several pieces."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        row = F.col("id")
        rows = spark.range(0, 300000, numPartitions=8).select(
            F.when(row % 3 == 0, -1).otherwise(row % 5000).alias("LEASE_KID"),
            F.when(row % 2 == 0, "O").otherwise("G").alias("PRODUCT"),
            (row % 100).cast("double").alias("PRODUCTION"),
        )
        made = features.add_entity_ratios(rows)
        assert made.filter("LEASE_KID = -1").agg(F.countDistinct("gor")).first()[0] == 1
        assert len(made.collect()) == 300000
        assert "isSkew=true" in plan_of(made) or "skewed" in plan_of(made)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_raw_files_to_features_in_two_shuffles_without_python(spark):
    plan = plan_of(QUERIES["all_stages"](spark, SF))
    assert plan.count("Exchange ") == 2
    assert plan.index("Final") < plan.index("Partial")
    assert "Python" not in plan and "Arrow" not in plan
