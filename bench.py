"""Time the headline queries; prints one JSON line.

Each query is built and run to the end into a sink that discards the rows. The first run of a query
loads classes and compiles code; the second is the one reported.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from monthspan.plans.queries import QUERIES

HEADLINE = [
    "lease_index",
    "typed_cast",
    "clean_rows",
    "deduplicate",
    "fill_date_gaps",
    "cumulative",
    "ratio_features",
    "ratio_entity",
    "decline_rate",
    "rolling",
    "rolling_water",
    "lag_features",
    "features_all",
    "features_product",
    "part_features",
    "file_integrity",
    "lease_manifest",
    "acquire_job",
    "raw_scan",
    "ingest_job",
    "transform_job",
    "features_job",
    "all_stages",
    "whole_run",
    "dq_spot",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        # The tables are far smaller than a cluster's: without this, AQE would merge a shuffle
        # into fewer partitions than there are cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Call-site capture costs a round trip per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # The JVM never compiles methods above 8,000 bytes; let Spark split such stages instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.monotonic()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.monotonic() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    timed = {}
    for name in names:
        seconds(spark, sf_dir, name)
        timed[name] = round(seconds(spark, sf_dir, name), 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
