"""The four stages as Spark jobs, and a run over them.

Every stage reads its input lazily and ends in one write, so a lost executor costs only its tasks. A write is a new
version of the stage's table, which counts once it is complete; a run that is killed can be resumed after the last
stage that was. Rows with faults end no stage halfway: the good rows are written, the faults go to a table of their
own, and then the stage fails, unless told to go on.
"""

from __future__ import annotations

import hashlib
import logging
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthspan.operators.calendar import fill_date_gaps
from monthspan.operators.clean import checked_rows, clean_rows
from monthspan.operators.dedup import deduplicate
from monthspan.operators.features import add_features
from monthspan.operators.manifest import LINK_MARKER, lease_manifest
from monthspan.operators.quality import write_checks
from monthspan.operators.rejects import FAULTS, RejectedRows, accepted, rejected
from monthspan.panel import DEFAULT_MIN_YEAR, Panel, task_count
from monthspan.sources import stages
from monthspan.sources.dictionary import load_schema, monthly_schema
from monthspan.sources.files import list_files, spread
from monthspan.sources.landed import current_leases, landed_files, read_lease_index
from monthspan.sources.raw import PATTERN, SOURCE_FILE, SOURCE_POS, WHOLE_UP_TO, checked_ingest

logger = logging.getLogger(__name__)
STAGES = ["acquire", "ingest", "transform", "features"]


@dataclass(frozen=True)
class Paths:
    """Where each stage reads and writes; only the paths of the requested stages are needed.

    With ``dictionary``, the path of a data dictionary, its columns are the schema.
    """

    dictionary: str = ""
    lease_index: str = ""
    pages: str = ""
    raw: str = ""
    manifest: str = ""
    interim: str = ""
    processed: str = ""
    features: str = ""
    rejects: str = ""

    def rejects_of(self, stage: str) -> str:
        """Where a stage's faults go: beside its table, if nothing else is said."""
        beside = {"ingest": self.interim, "transform": self.processed}[stage].rstrip("/") + "_rejects"
        return f"{self.rejects.rstrip('/')}/{stage}" if self.rejects else beside


@dataclass(frozen=True)
class Settings:
    """What a run may vary.

    By default the sizes of output files follow the data. ``files`` fixes their number instead, and
    ``files="clamp"`` gives the classic 10 to 50, by the number of input files. ``file_bytes`` sizes files instead.
    """

    panel: Panel = Panel()
    schema: T.StructType | None = None
    min_year: int = DEFAULT_MIN_YEAR
    page_template: str = "https://example.org/month?f_lc={lease_id}"
    link_marker: str = LINK_MARKER
    on_bad_date: str = "drop"
    zero_fill_nulls: bool = True
    files: int | str | None = None
    file_bytes: int | None = None
    quoted_breaks: bool = True
    whole_up_to: int = WHOLE_UP_TO
    on_reject: str = "fail"


def declared(spark: SparkSession, paths: Paths, settings: Settings) -> T.StructType:
    """The schema of the dictionary file, or of the settings, or of the monthly files."""
    if paths.dictionary:
        return load_schema(spark, paths.dictionary)
    return settings.schema or monthly_schema()


def transform_rows(
    rows: DataFrame,
    position: Sequence[str],
    schema: T.StructType,
    settings: Settings = Settings(),
    count: int = 0,
) -> DataFrame:
    """Typed rows to a clean, unique, gap-free panel.

    Two shuffles. The first is by row key, after each task has dropped its own repeats. The second
    is by entity and carries at most one row per key, so no entity can outgrow a task. ``count``,
    about how many rows there are, sets the second one's number of partitions.
    """
    clean = rows.transform(clean_rows, schema, settings.panel, settings.on_bad_date)
    return _panel_of(clean, position, settings, count)


def _panel_of(clean: DataFrame, position: Sequence[str], settings: Settings, count: int) -> DataFrame:
    panel = settings.panel
    unique = clean.transform(deduplicate, position, panel).drop(SOURCE_POS)
    return unique.transform(fill_date_gaps, panel, settings.zero_fill_nulls, rows=count)


def acquire(spark: SparkSession, paths: Paths, settings: Settings = Settings()) -> None:
    """Lease index and stored lease pages to a manifest of the files to request."""
    leases = current_leases(read_lease_index(spark, paths.lease_index), settings.min_year)
    manifest = lease_manifest(
        leases,
        stages.read_stage(spark, paths.pages),
        landed_files(spark, paths.raw),
        settings.page_template,
        settings.link_marker,
    )
    stages.write_stage(manifest, paths.manifest)


def ingest(spark: SparkSession, paths: Paths, settings: Settings = Settings()) -> None:
    """Raw files to one typed table, without any shuffle unless a number of files is asked for.

    Faults of rows, cells and files go to a table of their own; the rows without any are written all the same.
    """
    schema = declared(spark, paths, settings)
    rows = checked_ingest(
        spark, paths.raw, schema, settings.min_year, settings.quoted_breaks, settings.whole_up_to
    )
    files = _files(spark, settings, paths.raw, PATTERN)
    source = _source(spark, paths, settings, "ingest")
    commit = stages.write_stage(rows, paths.interim, files, source=source, file_bytes=settings.file_bytes)
    _keep_faults(rows, commit, paths.rejects_of("ingest"), settings)


def transform(spark: SparkSession, paths: Paths, settings: Settings = Settings()) -> None:
    """Typed table to the processed panel, in date order inside each entity.

    Unless a number of files is asked for, the panel is written in buckets by entity. Dates that can't be are
    faults. What the rows hold is checked while they are written.
    """
    schema, panel = declared(spark, paths, settings), settings.panel
    rows, position = stages.read_rows_in_order(spark, paths.interim)
    checked = spread(rows).transform(checked_rows, schema, panel, settings.on_bad_date)
    # Reads one column. Metrics observed below a shuffle never arrive when no row gets through it.
    count, faulty = checked.agg(F.count(F.lit(1)), F.count_if(F.size(FAULTS) > 0)).first()
    filled = _panel_of(accepted(checked), position, settings, count)
    checks = write_checks(panel, schema, filled.columns)
    files, source = _files(spark, settings, paths.interim), _source(spark, paths, settings, "transform")
    if files is None and settings.file_bytes is None:
        buckets = task_count(spark, count)
        commit = stages.write_panel(filled, paths.processed, panel, checks, source, faulty, buckets)
    else:
        commit = stages.write_stage(
            filled, paths.processed, files, panel, checks, source, faulty, settings.file_bytes
        )
    _keep_faults(checked, commit, paths.rejects_of("transform"), settings)


def features(spark: SparkSession, paths: Paths, settings: Settings = Settings()) -> None:
    """Processed panel to the panel with all features; no shuffle where the panel has buckets."""
    panel = stages.read_panel(spark, paths.processed)
    result = panel.transform(add_features, settings.panel)
    files = _files(spark, settings, paths.processed)
    checks = write_checks(settings.panel, None, result.columns)
    source = _source(spark, paths, settings, "features")
    stages.write_stage(
        result, paths.features, files, settings.panel, checks, source, file_bytes=settings.file_bytes
    )


def report(spark: SparkSession, directory: str) -> DataFrame:
    """What the checks found when the last version of a stage table was written: check, offences and an example."""
    found = stages.commits(spark, directory)
    rows = [(c["check"], c["offences"], c["example"]) for c in found[0].checks] if found else []
    return spark.createDataFrame(rows, "check string, offences bigint, example string")


def _keep_faults(checked: DataFrame, commit: stages.Commit, directory: str, settings: Settings) -> None:
    """Write the faults that the stage's write has counted. Without any, nothing is read again."""
    if settings.on_reject not in ("fail", "keep"):
        raise ValueError(f"on_reject is 'fail' or 'keep', not '{settings.on_reject}'")
    if not commit.faulty:
        return
    found = rejected(checked, [SOURCE_FILE, SOURCE_POS] if SOURCE_FILE in checked.columns else [SOURCE_POS])
    stages.write_stage(found, directory, source=commit.version)
    if settings.on_reject == "fail":
        shown = stages.read_stage(checked.sparkSession, directory).limit(5).collect()
        examples = [f"{r['column'] or 'row'} {r['reason']}: {r['text']}" for r in shown]
        raise RejectedRows(commit.faulty, directory, examples)


def _source(spark: SparkSession, paths: Paths, settings: Settings, stage: str) -> str:
    """What a stage's table is made from: the settings, and the version or the files that the stage reads."""
    if stage == "ingest":
        listed = list_files(spark, paths.raw, PATTERN).agg(
            F.count("*"), F.sum("length"), F.sum(F.xxhash64("path", "length", "modificationTime") % 2**31)
        )
        read = [*listed.first(), paths.dictionary]
    else:
        found = stages.commits(spark, {"transform": paths.interim, "features": paths.processed}[stage])
        read = [found[0].version if found else uuid.uuid4().hex]
    return hashlib.sha256(repr((stage, read, settings)).encode()).hexdigest()


def committed(spark: SparkSession, paths: Paths, settings: Settings, stage: str) -> bool:
    """Was the stage's table made, whole and without faults left to report, from what the stage would read now?"""
    directory = {"ingest": paths.interim, "transform": paths.processed, "features": paths.features}.get(stage)
    found = stages.commits(spark, directory) if directory else []
    fails = found and found[0].faulty and settings.on_reject == "fail"
    return bool(found) and not fails and found[0].source == _source(spark, paths, settings, stage)


def _files(
    spark: SparkSession, settings: Settings, source: str, pattern: str = "*.parquet"
) -> int | None:
    if settings.files != "clamp":
        return settings.files
    return stages.file_count(list_files(spark, stages.current_path(spark, source), pattern).count())


_JOBS: dict[str, Callable[[SparkSession, Paths, Settings], None]] = {
    "acquire": acquire,
    "ingest": ingest,
    "transform": transform,
    "features": features,
}


def run(
    spark: SparkSession,
    paths: Paths,
    requested: Sequence[str] | None = None,
    settings: Settings = Settings(),
    resume: bool = False,
) -> dict[str, float]:
    """Run stages in the requested order, all four by default; seconds per stage.

    An unknown stage is an error before anything runs. A failing stage ends the run. With ``resume``, a stage whose
    table was made from the same input under the same settings is not run again.
    """
    names = list(requested) if requested else STAGES
    unknown = [name for name in names if name not in _JOBS]
    if unknown:
        raise ValueError(f"unknown stage: {unknown[0]}")
    seconds = {}
    for name in names:
        if resume and committed(spark, paths, settings, name):
            logger.info("%s is up to date", name)
            continue
        start = time.monotonic()
        logger.info("running %s", name)
        try:
            _JOBS[name](spark, paths, settings)
        except Exception:
            logger.exception("%s broke off; %.1f s spent on it", name, time.monotonic() - start)
            raise
        seconds[name] = time.monotonic() - start
        logger.info("%s took %.1f s", name, seconds[name])
    return seconds
