"""What one task gets must not grow with the table."""

import pytest
from pyspark.sql import functions as F

import monthspan.panel
from monthspan import Panel
from monthspan.operators import calendar
from monthspan.operators.features import add_features
from monthspan.plans import given, jobs, queries
from monthspan.sources import files, stages
from tests.helpers import panel


def partitions(frame) -> int:
    return frame.select(F.spark_partition_id().alias("p")).rdd.getNumPartitions()


def leases(spark, n: int):
    rows = spark.range(n).select(F.col("id").alias("LEASE_KID"), F.explode(F.array(F.lit(1), F.lit(4))).alias("month"))
    return rows.select(
        "LEASE_KID",
        F.make_date(F.lit(2024), "month", F.lit(1)).alias("production_date"),
        F.lit("O").alias("PRODUCT"),
        F.lit(1.0).alias("PRODUCTION"),
    )


@pytest.mark.parametrize("by_product", [False, True])
def test_gap_filling_gets_more_tasks_for_more_rows(spark, by_product):
    """Merged by their few bytes, all rows would be stretched and sorted by one task."""
    roles = Panel(by_product=by_product)
    rows = leases(spark, 100)
    assert partitions(calendar.fill_date_gaps(rows, roles)) == 8
    made = add_features(calendar.fill_date_gaps(rows, roles, rows=20 * monthspan.panel.ROWS_PER_TASK), roles)
    assert partitions(made) == 20
    assert made.count() == 400


def test_a_scan_of_many_rows_is_dealt_to_more_tasks(spark, monkeypatch):
    rows = spark.range(100).coalesce(1)
    assert partitions(files.spread(rows)) == 1
    monkeypatch.setattr(files, "MOST_SCANNED", 50)
    dealt = files.spread(rows)
    assert partitions(dealt) == 8 and dealt.columns == ["id"]
    assert sorted(r["id"] for r in dealt.collect()) == list(range(100))
    assert files.spread(rows.limit(0)).count() == 0


def test_transform_writes_as_many_buckets_as_its_rows_need(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(monthspan.panel, "ROWS_PER_TASK", 2)
    monkeypatch.setattr(files, "MOST_SCANNED", 5)
    paths = jobs.Paths(interim=str(tmp_path / "interim"), processed=str(tmp_path / "processed"))
    rows = panel(spark, [(1, 1, "O"), (4, 2, "O")])
    for lease in range(14):
        rows = rows.unionByName(panel(spark, [(1, 1, "O"), (4, 2, "O")], lease=lease))
    rows = rows.withColumn("MONTH-YEAR", F.date_format("production_date", "M-yyyy")).drop("production_date")
    stages.write_stage(rows.coalesce(1), paths.interim)
    jobs.transform(spark, paths)
    assert stages.commits(spark, paths.processed)[0].buckets == 15
    made = stages.read_panel(spark, paths.processed)
    assert made.groupBy("LEASE_KID").count().filter("count = 4").count() == 15
    assert "Exchange" not in add_features(made)._jdf.queryExecution().executedPlan().toString()


def test_raw_texts_are_put_together_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(monthspan.panel, "ROWS_PER_TASK", 4000)
    rows = spark.range(80_000).select(F.col("id").alias(given.POSITION), F.lit("x").alias("A"))
    contents = given.raw_contents(rows, ["A"], "\n")
    assert partitions(contents) == 20
    queries.write_raw_files(contents, str(tmp_path / "raw"))
    texts = [p.read_text() for p in sorted((tmp_path / "raw").glob("part-*"))]
    assert [t.count("x") for t in texts] == [4000] * 20


def by_entity(spark, directory: str) -> list:
    found = stages.read_by_entity(spark, directory, Panel(entity="e")).groupBy("e")
    return found.agg(F.count("*"), F.countDistinct("path"), F.sum("v")).collect()


def test_directories_per_entity_are_written_and_read_by_tasks(spark, tmp_path):
    """Spark's writer makes processes for every directory, and its reader lists them all on the driver."""
    rows = spark.range(60_000).select(
        F.expr("""case when id < 25000 then 'hot' when id % 7 = 0 then null when id % 7 = 1 then ''
            else element_at(array('a/b=c', 'x y', '100%', 'é', '.'), int(id % 7) - 1) end""").alias("e"),
        F.expr("date_add(date'2000-01-01', int(id))").alias("production_date"),
        F.col("id").alias("v"),
    )
    directory = str(tmp_path / "a")
    stages.write_by_entity(rows.limit(3), directory, Panel(entity="e"))
    stages.write_by_entity(rows, directory, Panel(entity="e"), rows=20 * monthspan.panel.ROWS_PER_TASK)
    expected = rows.groupBy(F.nullif("e", F.lit("")).alias("e")).agg(F.count("*"), F.lit(1), F.sum("v"))
    found = by_entity(spark, directory)
    assert sorted(found, key=str) == sorted(expected.collect(), key=str)
    index = spark.read.parquet(f"{directory}/_index")
    assert index.count() == index.select("directory").distinct().count() == 7
    assert index.agg(F.sum("rows")).first()[0] == 60_000
    plan = stages.read_by_entity(spark, directory, Panel(entity="e"))._jdf.queryExecution().executedPlan().toString()
    assert "e=hot" not in plan and "MapInArrow" in plan
    # Spark's reader finds the same rows in the same directories.
    read = spark.read.parquet(directory)
    assert read.exceptAll(rows.selectExpr("production_date", "v", "nullif(e, '') as e")).count() == 0
    assert read.count() == 60_000


def test_a_write_by_entity_that_breaks_off_leaves_what_was_there(spark, tmp_path):
    directory = str(tmp_path / "a")
    stages.write_by_entity(leases(spark, 5), directory)
    broken = leases(spark, 9).withColumn("PRODUCTION", F.raise_error(F.lit("broken off")).cast("double"))
    with pytest.raises(Exception, match="broken off"):
        stages.write_by_entity(broken, directory)
    assert stages.read_by_entity(spark, directory).groupBy("LEASE_KID").count().count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["a"]


@pytest.mark.parametrize("name", ["all_stages", "whole_run"])
def test_runs_over_raw_files_deal_their_rows_to_as_many_tasks_as_they_need(spark, tmp_path, monkeypatch, name):
    """Merged by their few bytes, rows would be stretched and sorted by about one task a core."""
    orders = spark.range(6000).selectExpr(
        "id as o_orderkey", "id % 40 as o_custkey", "element_at(array('O', 'F', 'P'), int(id % 3) + 1) as o_orderstatus",
        "double(id) as o_totalprice", "timestamp(add_months(date'1998-01-01', int(id * 7 % 90))) as o_orderdate",
        "'1-URGENT' as o_orderpriority",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    pages = spark.createDataFrame([(1, "https://h.example/", "<p>")], "page_id bigint, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    expected = queries.QUERIES[name](spark, str(tmp_path))
    monkeypatch.setattr(monthspan.panel, "ROWS_PER_TASK", 300)
    made = queries.QUERIES[name](spark, str(tmp_path))
    assert made.count() == expected.count() > 0 and made.exceptAll(expected).count() == 0
    if name == "all_stages":
        assert partitions(made) == 20
    else:
        read = made.select(F.regexp_extract(F.col("_metadata.file_name"), "^part-([0-9]{5})", 1).alias("task"))
        assert read.distinct().count() > 8
