"""Every query against its SQL on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from monthspan.plans.oracles import ORACLES
from monthspan.plans.queries import QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() > 0
    assert frame.columns[-12:][0] == "cum_oil"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF), db, ORACLES[name]) is None


@pytest.mark.parametrize(
    "name", ["parse_date", "clean_rows", "typed_cast", "features_all", "dq_zero_null", "dq_spot", "ingest_job", "rejected_rows"]
)
@pytest.mark.parametrize(
    "setting", [("spark.sql.codegen.hugeMethodLimit", "8000"), ("spark.sql.codegen.wholeStage", "false")]
)
def test_the_order_of_evaluation_does_not_matter(spark, db, name, setting):
    """Both settings work out shared expressions before the conditions that stand in front of them."""
    before = spark.conf.get(setting[0])
    spark.conf.set(*setting)
    try:
        assert difference(QUERIES[name](spark, SF), db, ORACLES[name]) is None
    finally:
        spark.conf.set(setting[0], before)


def test_everything_works_without_the_queries_for_training_data(tmp_path):
    """The subpackage and the pipeline may be absent."""
    root = Path(__file__).parent.parent
    shutil.copytree(root / "monthspan", tmp_path / "monthspan", ignore=shutil.ignore_patterns("llm"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    told = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert told.stdout.split() == [str(len(QUERIES))] * 2


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kathmandu", "Pacific/Apia"])
def test_the_time_zone_does_not_matter(spark, db, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert difference(queries()["features_all"](spark, SF), db, oracle_sql()["features_all"]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_scratch_tables_go_to_the_shared_folder(spark):
    from monthspan.sources.stages import scratch_dir

    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second


def test_scratch_tables_without_a_shared_folder(spark, monkeypatch):
    """The warehouse serves instead, unless it lies on one machine of several."""
    from monthspan.sources import stages

    warehouse, get = spark.conf.get("spark.sql.warehouse.dir"), spark.conf.get
    monkeypatch.setattr(
        type(spark.conf), "get", lambda _, key, *d: d[0] if key == "spark.checkpoint.dir" else get(key, *d)
    )
    assert stages.scratch_dir(spark, "x").startswith(warehouse)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stages.scratch_dir(spark, "x")
