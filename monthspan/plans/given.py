"""The given tables seen as monthly production data.

Orders are the reports of a lease (the customer); their status is the product, their price the
volume. Order keys decide which reports carry which irregularity, so every cleaning rule has work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthspan.panel import task_count
from monthspan.sources.files import spread

MIN_YEAR = 1998
POSITION = "o_orderkey"
PAGE_TEMPLATE = "https://h.example/month?f_lc={lease_id}"

MONTH_YEAR = """concat(
    case when o_orderkey % 97 = 0 then '0' when o_orderkey % 89 = 0 then '-1'
         when o_orderkey % 83 = 0 then '13' else cast(month(o_orderdate) as string) end,
    '-', case when o_orderkey % 101 = 0 then 'total' else cast(year(o_orderdate) as string) end)"""
PRODUCT = "case o_orderstatus when 'F' then 'G' else o_orderstatus end"
VOLUME = """cast(floor(o_totalprice / 8) as bigint)
    * case when o_orderkey % 53 = 0 then -1 when o_orderkey % 61 = 0 then 0 else 1 end"""
VOLUME_OR_NULL = f"case when o_orderkey % 59 <> 0 then {VOLUME} end"

# Raw text columns of a monthly file, as SQL over orders.
RAW_TEXT = {
    "LEASE_KID": "cast(o_custkey as string)",
    "LEASE": "concat('LEASE ', o_custkey)",
    "DOR_CODE": "case when o_orderkey % 7 = 0 then '' else cast(100000 + o_custkey as string) end",
    "API_NUMBER": "concat('15-', o_custkey % 199)",
    "FIELD": "case when o_orderpriority like '4%' then '' else o_orderpriority end",
    "PRODUCING_ZONE": "concat('ZONE ', o_orderkey % 5)",
    "OPERATOR": "concat('OPERATOR, \"', o_custkey % 31, '\" LLC')",
    "COUNTY": "concat('COUNTY ', o_custkey % 105)",
    "TOWNSHIP": "concat(o_custkey % 35 + 1, '.0')",
    "TWN_DIR": "case o_orderkey % 11 when 0 then 'X' when 1 then 'N' else 'S' end",
    "RANGE": "cast(o_custkey % 43 + 1 as string)",
    "RANGE_DIR": "case o_orderkey % 3 when 0 then 'E' when 1 then 'W' else 'e' end",
    "SECTION": "case when o_orderkey % 6 = 0 then '' else cast(o_custkey % 36 + 1 as string) end",
    "SPOT": "case when o_orderkey % 4 = 0 then 'NENENE' else '' end",
    "LATITUDE": "case when o_orderkey % 17 = 0 then 'n/a' else concat(37 + o_custkey % 3, '.5') end",
    "LONGITUDE": "case when o_orderkey % 19 = 0 then 'NaN' else concat('-', 95 + o_custkey % 7, '.25') end",
    "MONTH-YEAR": MONTH_YEAR,
    "PRODUCT": PRODUCT,
    "WELLS": "case when o_orderkey % 13 = 0 then 'unknown' else cast(o_orderkey % 4 as string) end",
    "PRODUCTION": f"coalesce(cast({VOLUME_OR_NULL} as string), '')",
    "URL": "concat('https://h.example/x?a=1&f_lc=', o_custkey)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of a raw file as texts, plus the position."""
    columns = [F.expr(sql).alias(name) for name, sql in RAW_TEXT.items()]
    return spread(table(spark, sf_dir, "orders")).select(*columns, POSITION)


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed columns that cleaning and features need, plus the position."""
    return spread(table(spark, sf_dir, "orders")).select(
        F.col("o_custkey").alias("LEASE_KID"),
        F.nullif(F.expr(RAW_TEXT["FIELD"]), F.lit("")).alias("FIELD"),
        F.expr(RAW_TEXT["TWN_DIR"]).alias("TWN_DIR"),
        F.expr(MONTH_YEAR).alias("MONTH-YEAR"),
        F.expr(PRODUCT).alias("PRODUCT"),
        F.expr(f"cast({VOLUME_OR_NULL} as double)").alias("PRODUCTION"),
        POSITION,
    )


def part_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A longer panel: line items by part and shipping month."""
    return spread(table(spark, sf_dir, "lineitem")).select(
        F.col("l_partkey").alias("LEASE_KID"),
        F.expr("concat(month(l_shipdate), '-', year(l_shipdate))").alias("MONTH-YEAR"),
        F.expr("case l_linestatus when 'F' then 'G' else l_linestatus end").alias("PRODUCT"),
        F.col("l_quantity").alias("PRODUCTION"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("position"),
    )


def lease_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per report; every tenth customer's URL lacks the lease parameter."""
    parameter = "case when o_custkey % 10 = 9 then 'other=' else 'a=1&f_lc=' end"
    return table(spark, sf_dir, "orders").select(
        F.expr(MONTH_YEAR).alias("MONTH-YEAR"),
        F.expr(f"concat('https://h.example/x?', {parameter}, o_custkey)").alias("URL"),
        POSITION,
    )


def lease_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages; their links to words that begin with 'the' become download links, with the
    ampersand written in one of three ways."""
    ampersand = F.expr("element_at(array('&amp;', '&#38;', '&#x26;'), int(page_id % 3) + 1)")
    link = F.concat(
        F.lit('href="/anon_blobber.download?x=1'), ampersand, F.lit("p_file_name=lp"), "page_id",
        F.lit(".txt"), ampersand, F.lit("w="),
    )
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("lease_id"),
        F.replace("html", F.lit('href="/the'), link).alias("html"),
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as landed files; a file of an even document is empty."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("lp"), "doc_id", F.lit(".txt")).alias("file_name"),
        (F.col("n_chars") * (F.col("doc_id") % 2)).alias("length"),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as landed files, line by line, whole texts.

    Every seventh one ends in bytes that are no UTF-8; every fifth one ends in blank lines.
    """
    lines = F.split("text", "\n")
    blank = F.concat(lines, F.array(F.lit(""), F.lit(" ")))
    invalid = F.concat(lines, F.array(F.unhex(F.lit("FFFE")).cast("string")))
    chosen = F.when(F.expr("doc_id % 5 = 0"), blank).when(F.expr("doc_id % 7 = 0"), invalid)
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("lp"), "doc_id", F.lit(".txt")).alias("file_name"),
        F.explode(chosen.otherwise(lines)).alias("line"),
    )


# Rows of a raw file, and what ends the rows of each product's files.
ROWS_PER_FILE = 4000
LINE_ENDS = {"G": "\n", "O": "\r\n", None: "\r"}


def raw_contents(
    rows: DataFrame, columns: list[str], line_end: str, mixed: bool = False, surplus: int = 0
) -> DataFrame:
    """Whole texts of raw files with the given columns, ``ROWS_PER_FILE`` positions in each, in order.

    With ``mixed``, every third row ends in LF whatever the others end in. One in ``surplus`` rows has two more cells
    than the header.
    """
    header = ",".join(f'"{c}"' if "," in c else c for c in columns)
    cells = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), {"escape": '"', "emptyValue": ""})
    end = F.when(F.lit(mixed) & (F.col(POSITION) % 3 == 0), "\n").otherwise(line_end)
    if surplus:
        cells = F.concat(cells, F.when(F.col(POSITION) % surplus == 0, ",more,").otherwise(""))
    lines = rows.select(
        F.floor(F.col(POSITION) / ROWS_PER_FILE).alias("file"),
        F.struct(POSITION, F.concat(cells, end).alias("line")).alias("row"),
    )
    # Spread by the number of lines, so that a task's texts don't grow with the table.
    lines = lines.repartition(task_count(rows.sparkSession, rows.count()), "file")
    files = lines.groupBy("file").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    text = F.concat(F.lit(header + line_end), F.array_join(F.transform("rows", lambda r: r["line"]), ""))
    return files.select("file", text.alias("content"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the rows of a data dictionary, with quotes, commas, blanks and an unknown type."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('C', p_partkey) as column",
        "case when p_partkey % 5 = 0 then '' else concat('\"', p_name, '\", ', p_type) end as description",
        "element_at(array('int', 'float', 'string', 'categorical', 'decimal'), int(p_partkey % 5) + 1) as dtype",
        "if(p_partkey % 3 = 0, 'no', 'yes') as nullable",
        "if(p_partkey % 5 = 3, concat(p_brand, '|', p_type), '') as categories",
    )
