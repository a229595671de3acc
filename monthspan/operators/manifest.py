"""Lease manifest: which files to request, worked out as joins instead of one request at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthspan.functions.links import first_link, lease_page_url, query_parameter
from monthspan.operators.lookup import look_up

# The names that the index URLs, the pages and the download links use.
LEASE_PARAMETER = "f_lc"
FILE_PARAMETER = "p_file_name"
LINK_MARKER = "anon_blobber.download"


def with_lease_id(leases: DataFrame, required: bool = False) -> DataFrame:
    """Add the lease id found in the URL; without one it is null, or an error when required."""
    lease_id = query_parameter(F.col("URL"), LEASE_PARAMETER)
    if required:
        message = F.concat(F.lit(f"no {LEASE_PARAMETER} parameter in URL "), F.col("URL"))
        lease_id = F.coalesce(lease_id, F.raise_error(message).cast("string"))
    return leases.withColumn("lease_id", lease_id)


def download_links(pages: DataFrame, marker: str = LINK_MARKER) -> DataFrame:
    """(lease_id, html) to (lease_id, link, file_name), one row per lease.

    A lease whose page was stored more than once keeps the smallest of its links. Only the links
    are shuffled, never the pages.
    """
    links = pages.select("lease_id", first_link(F.col("html"), marker).alias("link"))
    links = links.groupBy("lease_id").agg(F.min("link").alias("link"))
    return links.withColumn("file_name", query_parameter(F.col("link"), FILE_PARAMETER))


def lease_manifest(
    leases: DataFrame,
    pages: DataFrame,
    landed: DataFrame,
    page_template: str,
    marker: str = LINK_MARKER,
) -> DataFrame:
    """One row per lease with what is known about its file.

    Status: ``bad_url`` no lease id, ``no_link`` no usable download link, ``landed`` the file is
    there and not empty, ``pending`` the file has to be requested. A lease that fails does not stop
    the others.
    """
    there = landed.filter(F.col("length") > 0).select("file_name").distinct()
    there = there.withColumn("is_landed", F.lit(True))
    status = (
        F.when(F.col("lease_id").isNull(), "bad_url")
        .when(F.col("file_name").isNull(), "no_link")
        .when(F.col("is_landed"), "landed")
        .otherwise("pending")
    )
    return (
        look_up(with_lease_id(leases), "lease_id", download_links(pages, marker))
        .transform(look_up, "file_name", there)
        .select(
            "URL",
            "lease_id",
            lease_page_url(page_template, F.col("lease_id")).alias("page_url"),
            "link",
            "file_name",
            status.alias("status"),
        )
    )
