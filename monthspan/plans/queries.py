"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthspan.functions.links import query_parameter
from monthspan.operators import calendar, clean, dedup, features, manifest, quality
from monthspan.panel import Panel, task_count
from monthspan.plans import given, jobs
from monthspan.sources import landed, raw, stages
from monthspan.sources.dictionary import DICTIONARY_COLUMNS, MONTHLY, archive_schema, monthly_schema
from monthspan.sources.dictionary import read_dictionary, with_types
from monthspan.sources.files import list_files, schema_variants

Query = Callable[[SparkSession, str], DataFrame]

PANEL = Panel()
BY_PRODUCT = Panel(by_product=True)
WITH_WATER = Panel(water="WATER")
POSITION = [given.POSITION]
SETTINGS = jobs.Settings(min_year=given.MIN_YEAR, page_template=given.PAGE_TEMPLATE)


# Steps that several queries start with


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.raw_panel(spark, sf_dir).transform(raw.keep_from_year, given.MIN_YEAR)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.raw_panel(spark, sf_dir).transform(clean.clean_rows, monthly_schema())


def unique(spark: SparkSession, sf_dir: str, panel: Panel = PANEL) -> DataFrame:
    rows = cleaned(spark, sf_dir)
    return rows.transform(dedup.deduplicate, POSITION, panel).drop(given.POSITION)


def reports(spark: SparkSession, sf_dir: str, table: str = "orders") -> int:
    """The rows of a table, from its files' footers."""
    return given.table(spark, sf_dir, table).count()


def filled(spark: SparkSession, sf_dir: str, panel: Panel = PANEL) -> DataFrame:
    rows = reports(spark, sf_dir)
    return unique(spark, sf_dir, panel).transform(calendar.fill_date_gaps, panel, rows=rows)


def write_filled(spark: SparkSession, directory: str, panel: DataFrame, sf_dir: str) -> None:
    """Write what ``filled`` gives, in as many buckets as its rows come in."""
    stages.write_panel(panel, directory, buckets=task_count(spark, reports(spark, sf_dir)))


def reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated rows, first per month, with volumes as reported."""
    rows = given.raw_panel(spark, sf_dir).transform(clean.parse_date)
    return rows.transform(dedup.deduplicate, POSITION).drop(given.POSITION)


def with_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gap-free panel with a water volume, negative in some months and missing in others."""
    water = F.expr(
        "case when LEASE_KID % 23 = 0 then -PRODUCTION"
        " when month(production_date) = 5 then null else floor(PRODUCTION / 3) end"
    )
    return filled(spark, sf_dir).withColumn("WATER", water.cast("double"))


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.raw_text(spark, sf_dir).drop(given.POSITION)


def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows with types, as a stage table with their positions."""
    schema = monthly_schema()
    rows = given.raw_text(spark, sf_dir)
    position = F.struct(F.lit(0).cast("bigint").alias("block"), F.col(given.POSITION).alias("row"))
    rows = rows.withColumn(raw.SOURCE_FILE, F.lit("orders.txt")).withColumn(raw.SOURCE_POS, position)
    return rows.drop("URL", given.POSITION).transform(raw.enforce_types, schema)


def write_raw_files(contents: DataFrame, directory: str) -> None:
    """Write each text to a file of its own; the names follow the texts' order."""
    tasks = task_count(contents.sparkSession, contents.count() * given.ROWS_PER_FILE)
    in_order = contents.repartitionByRange(tasks, "file").sortWithinPartitions("file").select("content")
    in_order.write.option("maxRecordsPerFile", 1).text(directory)


# Names of the first file of each header, with characters that need care in paths.
ODD_NAMES = {"G": "lp 1.txt", "O": "lp%20+é.txt", None: "lp[1].txt"}


def files_with_three_headers(spark: SparkSession, sf_dir: str) -> str:
    """All raw rows as files: with an extra column, without two columns, and reordered, each with
    line ends of its own. Some names have spaces, percent signs and brackets."""
    directory = stages.scratch_dir(spark, "raw")
    rows = given.raw_text(spark, sf_dir)
    columns = [c for c in rows.columns if c != given.POSITION]
    known = F.col("PRODUCT").isin("G", "O")
    for product, chosen in {
        "G": columns,
        "O": [c for c in columns if c not in ("LEASE", "URL")],
        None: columns[::-1],
    }.items():
        part = rows.filter(F.col("PRODUCT") == product if product else ~known)
        contents = given.raw_contents(part, chosen, given.LINE_ENDS[product], mixed=product == "O")
        stages.move_files(spark, contents, write_raw_files, directory, ODD_NAMES[product])
    return directory


def files_in_order(spark: SparkSession, sf_dir: str) -> str:
    """All raw rows as files whose names and rows follow the position."""
    directory = stages.scratch_dir(spark, "raw")
    rows = given.raw_text(spark, sf_dir)
    write_raw_files(given.raw_contents(rows, [c for c in rows.columns if c != given.POSITION], "\n"), directory)
    return directory


def dictionary_file(spark: SparkSession, rows: DataFrame) -> str:
    path = stages.scratch_dir(spark, "dictionary")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


def monthly_dictionary(spark: SparkSession) -> str:
    """The dictionary of the monthly files, as a file."""
    rows = [(name, "", label, nullable, categories) for name, label, nullable, categories in MONTHLY]
    return dictionary_file(spark, spark.createDataFrame(rows, DICTIONARY_COLUMNS))


# Sources and sinks


def lease_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = given.lease_index(spark, sf_dir)
    return landed.current_leases(index, given.MIN_YEAR, given.POSITION).drop(given.POSITION)


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw.scan_raw(spark, files_with_three_headers(spark, sf_dir), monthly_schema())
    return rows.drop(raw.SOURCE_FILE, raw.SOURCE_POS)


def union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw.scan_raw(spark, files_with_three_headers(spark, sf_dir), archive_schema())
    return rows.groupBy("LEASE_KID", "LEASE", "URL").agg(F.count("*").alias("rows"))


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by file name; the names that Spark's writer makes up count together."""
    rows = raw.scan_raw(spark, files_with_three_headers(spark, sf_dir), monthly_schema())
    name = F.regexp_replace(raw.SOURCE_FILE, "^part-.*", "part")
    return rows.groupBy(name.alias("source_file")).agg(F.count("*").alias("rows"))


def dictionary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dictionary_file(spark, given.dictionary(spark, sf_dir))
    return read_dictionary(spark, path).transform(with_types)


def clamped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per lease from a stage of as many files as three inputs get."""
    directory = stages.scratch_dir(spark, "stage")
    stages.write_stage(given.raw_panel(spark, sf_dir), directory, files=stages.file_count(3))
    files = list_files(spark, stages.current_path(spark, directory), "*.parquet").count()
    rows = stages.read_stage(spark, directory).groupBy("LEASE_KID").agg(F.count("*").alias("rows"))
    return rows.withColumn("files", F.lit(files))


def sized_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per lease of a stage whose files are sized by bytes; leases share files."""
    directory = stages.scratch_dir(spark, "stage")
    stages.write_stage(unique(spark, sf_dir), directory, panel=Panel(), file_bytes=8 << 20)
    lease = F.col("LEASE_KID").cast("bigint").alias("LEASE_KID")
    return stages.read_stage(spark, directory).groupBy(lease).agg(F.count("*").alias("rows"))


def entity_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and files of every lease's own directory."""
    directory = stages.scratch_dir(spark, "entities")
    stages.write_by_entity(unique(spark, sf_dir), directory, rows=reports(spark, sf_dir))
    rows = stages.read_by_entity(spark, directory)
    return rows.groupBy(F.col("LEASE_KID").cast("bigint").alias("LEASE_KID")).agg(
        F.count("*").alias("rows"), F.countDistinct("path").alias("files")
    )


def entity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index of a clustered table says of each lease, and the rows that reading every twentieth lease by
    itself gives."""
    directory = stages.scratch_dir(spark, "clustered")
    stages.write_clustered(unique(spark, sf_dir), directory)
    index = stages.read_index(spark, directory)
    leases = index.groupBy(F.col("LEASE_KID").cast("bigint").alias("LEASE_KID")).agg(
        F.sum("rows").alias("rows"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")
    )
    wanted = index.select("LEASE_KID").filter("LEASE_KID % 20 = 0")
    read = stages.read_entities(spark, directory, wanted).groupBy("LEASE_KID").agg(F.count("*").alias("looked_up"))
    return leases.join(read, "LEASE_KID", "left")


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schemas of a stage whose later files have a column more."""
    directory = stages.scratch_dir(spark, "stage")
    rows = given.raw_panel(spark, sf_dir).select("LEASE_KID", "PRODUCT", "PRODUCTION")
    rows.filter("LEASE_KID % 2 = 0").write.parquet(directory)
    rows.filter("LEASE_KID % 2 = 1").drop("PRODUCT").write.mode("append").parquet(directory)
    return schema_variants(spark, directory).select("schema")


def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = stages.scratch_dir(spark, "stage")
    stages.write_stage(given.raw_panel(spark, sf_dir), directory)
    return stages.read_stage(spark, directory)


def file_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = given.table(spark, sf_dir, "customer")
    expected = customers.select(F.concat(F.lit("lp"), "c_custkey", F.lit(".txt")).alias("file_name"))
    return landed.integrity(expected, given.document_lines(spark, sf_dir))


def with_bad_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw texts with leases, sections and dates that can't be, of any year."""
    key = F.col(given.POSITION)
    return given.raw_text(spark, sf_dir).withColumns(
        {
            "LEASE_KID": F.when(key % 71 == 0, "none").when(key % 73 == 0, "").otherwise(F.col("LEASE_KID")),
            "SECTION": F.when(key % 67 == 0, "7.5").otherwise(F.col("SECTION")),
            "MONTH-YEAR": F.when(key % 79 == 0, "5-12345").otherwise(F.col("`MONTH-YEAR`")),
        }
    )


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faults that ingest and transform keep apart, from files with bad cells, surplus cells and a file
    without leases; some files are read in pieces."""
    rows = with_bad_cells(spark, sf_dir)
    columns = [c for c in rows.columns if c not in (given.POSITION, "URL")]
    raw_dir = stages.scratch_dir(spark, "raw")
    for product, chosen in {"G": columns, "O": [*columns, "URL"], "P": [c for c in columns if c != "LEASE_KID"]}.items():
        part = rows.filter(F.col("PRODUCT") == product)
        # Two cells more than the header has.
        contents = given.raw_contents(part, chosen, "\r\n", surplus=31 if product == "O" else 0)
        stages.move_files(spark, contents, write_raw_files, raw_dir, f"lp {product}.txt")
    directories = {name: stages.scratch_dir(spark, name) for name in ("interim", "processed", "rejects")}
    paths = jobs.Paths(raw=raw_dir, **directories)
    jobs.run(spark, paths, ["ingest", "transform"], replace(SETTINGS, on_reject="keep", whole_up_to=100_000))
    faults = [stages.read_stage(spark, paths.rejects_of(stage)) for stage in ("ingest", "transform")]
    stages.drop_dir(spark, raw_dir)
    every = faults[0].withColumn("stage", F.lit("ingest")).unionByName(faults[1].withColumn("stage", F.lit("transform")))
    return every.groupBy("stage", "column", "reason", "text").agg(F.count("*").alias("rows"))


def stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks found when a panel that was never bounded nor filled was written."""
    directory = stages.scratch_dir(spark, "stage")
    rows = reported(spark, sf_dir).transform(features.add_cumulative)
    checks = quality.write_checks(PANEL, monthly_schema(), rows.columns)
    stages.write_stage(rows, directory, checks=checks)
    return jobs.report(spark, directory)


def committed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per lease of a panel after a second write that broke off; its buckets come from the list of commits."""
    directory = stages.scratch_dir(spark, "panel")
    write_filled(spark, directory, filled(spark, sf_dir), sf_dir)
    broken = filled(spark, sf_dir).withColumn("PRODUCTION", F.raise_error(F.lit("broken off")).cast("double"))
    try:
        write_filled(spark, directory, broken, sf_dir)
    except PySparkException:
        pass
    return stages.read_panel(spark, directory).groupBy("LEASE_KID").agg(F.count("*").alias("rows"))


# Schema and casts


def typed_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = monthly_schema()
    return text_rows(spark, sf_dir).transform(raw.align_columns, schema).transform(raw.enforce_types, schema)


def absent_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text_rows(spark, sf_dir).drop("LEASE", "TOWNSHIP", "LATITUDE", "RANGE_DIR")
    schema = monthly_schema()
    return rows.transform(raw.align_columns, schema).transform(raw.enforce_types, schema)


def canonical_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text_rows(spark, sf_dir)
    return rows.select(*reversed(rows.columns)).transform(raw.align_columns, monthly_schema())


# Filters and cleaning


def year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent(spark, sf_dir)


def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some months lie a thousand years ahead."""
    ahead = F.expr("regexp_replace(`MONTH-YEAR`, '-1', '-2')")
    text = F.when(F.col(given.POSITION) % 103 == 0, ahead).otherwise(F.col("`MONTH-YEAR`"))
    return given.raw_panel(spark, sf_dir).withColumn("MONTH-YEAR", text).transform(clean.parse_date)


def cast_categoricals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.raw_panel(spark, sf_dir).transform(clean.cast_categoricals, monthly_schema())


def validate_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.raw_panel(spark, sf_dir).transform(clean.validate_bounds)


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir)


def sorted_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique(spark, sf_dir).sortWithinPartitions(*PANEL.keys)


# Deduplication and calendar


def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).transform(dedup.deduplicate, POSITION)


def deduplicate_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).transform(dedup.deduplicate, POSITION, BY_PRODUCT)


def entity_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique(spark, sf_dir).transform(calendar.entity_span)


def fill_date_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled(spark, sf_dir)


def fill_date_gaps_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserted months marked, missing volumes left missing."""
    rows = unique(spark, sf_dir)
    return calendar.fill_date_gaps(rows, zero_fill_nulls=False, mark_filled="is_filled", rows=reports(spark, sf_dir))


def fill_date_gaps_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled(spark, sf_dir, BY_PRODUCT)


# Features


def cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On reported months only, so that missing volumes occur."""
    return unique(spark, sf_dir).transform(features.add_cumulative)


def cumulative_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_water(spark, sf_dir).transform(features.add_cumulative, WITH_WATER)


def ratio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled(spark, sf_dir, BY_PRODUCT).transform(features.add_ratios, BY_PRODUCT)


def ratio_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned(spark, sf_dir).select("LEASE_KID", "PRODUCT", "PRODUCTION", given.POSITION)
    return rows.transform(features.add_entity_ratios)


def water_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_water(spark, sf_dir).transform(features.add_ratios, WITH_WATER)


def decline_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled(spark, sf_dir).transform(features.add_decline_rate)


def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique(spark, sf_dir).transform(features.add_rolling)


def rolling_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_water(spark, sf_dir).transform(features.add_rolling, WITH_WATER)
    return rows.transform(features.add_lags, WITH_WATER)


def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled(spark, sf_dir).transform(features.add_lags)


def features_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled(spark, sf_dir).transform(features.add_features)


def features_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled(spark, sf_dir, BY_PRODUCT).transform(features.add_features, BY_PRODUCT)


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain on the larger table."""
    rows = given.part_panel(spark, sf_dir).transform(clean.clean_rows, monthly_schema())
    rows = rows.transform(dedup.deduplicate, ["position"]).drop("position")
    rows = rows.transform(calendar.fill_date_gaps, rows=reports(spark, sf_dir, "lineitem"))
    return rows.transform(features.add_features)


# Manifest


def lease_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lease of every URL of the index, whatever its year."""
    index = given.lease_index(spark, sf_dir).transform(dedup.keep_first, ["URL"], POSITION)
    return index.drop(given.POSITION).transform(manifest.with_lease_id)


def page_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return given.table(spark, sf_dir, "pages").select(
        "page_id",
        query_parameter(url, "page").alias("page"),
        query_parameter(url, "utm_source").alias("utm_source"),
    )


def download_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.lease_pages(spark, sf_dir).transform(manifest.download_links)


def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = download_links(spark, sf_dir).filter("file_name is not null")
    return landed.not_landed(wanted, given.landed(spark, sf_dir)).select("lease_id", "file_name")


def lease_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.lease_manifest(
        lease_index(spark, sf_dir),
        given.lease_pages(spark, sf_dir),
        given.landed(spark, sf_dir),
        given.PAGE_TEMPLATE,
    )


# Jobs: each writes its stage tables to fresh directories and returns the last one


def write_index(spark: SparkSession, sf_dir: str) -> str:
    index = stages.scratch_dir(spark, "index")
    rows = given.lease_index(spark, sf_dir).repartitionByRange(given.POSITION)
    rows = rows.sortWithinPartitions(given.POSITION).drop(given.POSITION)
    rows.write.option("header", True).csv(index)
    return index


def acquire_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest as the job writes it, from an index in CSV and no landed files."""
    names = ["raw", "pages", "manifest"]
    paths = jobs.Paths(
        lease_index=write_index(spark, sf_dir), **{name: stages.scratch_dir(spark, name) for name in names}
    )
    stages.write_stage(given.lease_pages(spark, sf_dir), paths.pages)
    jobs.acquire(spark, paths, SETTINGS)
    for directory in (paths.lease_index, paths.pages):
        stages.drop_dir(spark, directory)
    return stages.read_stage(spark, paths.manifest)


def ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the dictionary file, from files whose rows end at any line end."""
    interim = stages.scratch_dir(spark, "interim")
    paths = jobs.Paths(
        dictionary=monthly_dictionary(spark), raw=files_with_three_headers(spark, sf_dir), interim=interim
    )
    jobs.ingest(spark, paths, replace(SETTINGS, quoted_breaks=False))
    for directory in (paths.dictionary, paths.raw):
        stages.drop_dir(spark, directory)
    return stages.read_stage(spark, interim).drop(raw.SOURCE_FILE, raw.SOURCE_POS)


def transform_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = jobs.Paths(
        interim=stages.scratch_dir(spark, "interim"), processed=stages.scratch_dir(spark, "processed")
    )
    stages.write_stage(typed_rows(spark, sf_dir), paths.interim)
    jobs.transform(spark, paths, SETTINGS)
    stages.drop_dir(spark, paths.interim)
    return stages.read_panel(spark, paths.processed).drop(raw.SOURCE_FILE)


def features_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = jobs.Paths(
        processed=stages.scratch_dir(spark, "processed"), features=stages.scratch_dir(spark, "features")
    )
    write_filled(spark, paths.processed, filled(spark, sf_dir), sf_dir)
    jobs.features(spark, paths, SETTINGS)
    stages.drop_dir(spark, paths.processed)
    return stages.read_stage(spark, paths.features)


def all_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files to features in one plan, without stage tables between."""
    rows = raw.ingest_rows(spark, files_in_order(spark, sf_dir), monthly_schema(), given.MIN_YEAR)
    position = [raw.SOURCE_FILE, raw.SOURCE_POS]
    count = reports(spark, sf_dir)
    panel = jobs.transform_rows(rows, position, monthly_schema(), SETTINGS, count).drop(raw.SOURCE_FILE)
    return panel.transform(features.add_features)


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four stages over stage tables."""
    names = ["pages", "manifest", "interim", "processed", "features"]
    paths = jobs.Paths(
        lease_index=write_index(spark, sf_dir),
        raw=files_in_order(spark, sf_dir),
        **{name: stages.scratch_dir(spark, name) for name in names},
    )
    stages.write_stage(given.lease_pages(spark, sf_dir), paths.pages)
    jobs.run(spark, paths, settings=SETTINGS)
    for directory in (paths.lease_index, paths.raw, paths.pages, paths.interim, paths.processed):
        stages.drop_dir(spark, directory)
    return stages.read_stage(spark, paths.features).drop(raw.SOURCE_FILE)


# Quality checks


def dq_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On volumes, ratios and shares, some of each out of bounds."""
    rows = given.raw_panel(spark, sf_dir).withColumns(
        {
            "gor": F.expr("double(case when o_orderkey % 41 = 0 then -1.5 when o_orderkey % 5 > 0 then 2 end)"),
            "water_cut": F.expr(
                "double(case o_orderkey % 37 when 0 then 1.5 when 1 then -0.5 when 2 then 1 when 3 then null else 0 end)"
            ),
        }
    )
    return rows.transform(quality.out_of_bounds)


def dq_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.raw_panel(spark, sf_dir).transform(quality.over_cap)


def dq_monotone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On volumes that were never bounded, where negative months make totals fall."""
    water = F.expr("case when month(production_date) % 4 = 0 then -1.0 else PRODUCTION end")
    rows = reported(spark, sf_dir).withColumn("WATER", water)
    return rows.transform(features.add_cumulative, WITH_WATER).transform(quality.not_monotone, WITH_WATER)


def dq_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On reported months only, where gaps are left."""
    return unique(spark, sf_dir).transform(quality.incomplete)


def dq_zero_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.zero_and_null(reported(spark, sf_dir), filled(spark, sf_dir))


def dq_spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key in three, as the sample's rule has it."""
    return quality.spot_check(reported(spark, sf_dir), filled(spark, sf_dir), one_in=3)


def dq_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(cleaned(spark, sf_dir))


def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months out of order in files that follow the order keys."""
    directory = stages.scratch_dir(spark, "stage")
    rows = cleaned(spark, sf_dir).repartitionByRange(given.POSITION)
    stages.write_stage(rows.sortWithinPartitions(given.POSITION), directory)
    return quality.out_of_order(spark, directory).select("LEASE_KID", "production_date")


def dq_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.undeclared_categories(given.raw_panel(spark, sf_dir), monthly_schema())


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in [
        lease_index,
        raw_scan,
        union_files,
        source_files,
        dictionary_scan,
        clamped_files,
        entity_layout,
        entity_lookup,
        sized_files,
        schema_drift,
        stage_roundtrip,
        file_integrity,
        rejected_rows,
        stage_report,
        committed_versions,
        typed_cast,
        absent_column,
        canonical_select,
        year_filter,
        parse_date,
        cast_categoricals,
        validate_bounds,
        clean_rows,
        sorted_panel,
        deduplicate,
        deduplicate_product,
        entity_span,
        fill_date_gaps,
        fill_date_gaps_marked,
        fill_date_gaps_product,
        cumulative,
        cumulative_water,
        ratio_features,
        ratio_entity,
        water_cut,
        decline_rate,
        rolling,
        rolling_water,
        lag_features,
        features_all,
        features_product,
        part_features,
        lease_ids,
        page_parameters,
        download_links,
        pending_files,
        lease_manifest,
        acquire_job,
        ingest_job,
        transform_job,
        features_job,
        all_stages,
        whole_run,
        dq_bounds,
        dq_units,
        dq_monotone,
        dq_complete,
        dq_zero_null,
        dq_spot,
        dq_rowcount,
        file_order,
        dq_category,
    ]
}
