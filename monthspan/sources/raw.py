"""Raw monthly files: CSV texts whose headers differ from file to file.

LF, CRLF and a lone CR end a row outside quotes, whatever a file's size or its other rows look like. A
quote has a meaning only where a cell begins; inside, a doubled quote is a quote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthspan.functions import casts
from monthspan.functions.months import is_from_year
from monthspan.operators import rejects
from monthspan.panel import DEFAULT_MIN_YEAR, col
from monthspan.sources.files import file_name, list_files, scratch_dir

PATTERN = "*.txt"
SOURCE_FILE = "source_file"
# Where a row stood in its file. Stage tables are unordered, so "first" needs a value to sort by.
SOURCE_POS = "source_pos"

# A cell in quotes, and one that may hold line breaks there; possessive, so that no text is tried twice.
_QUOTED = r'"(?:[^"]++|"")*+"'
_CELL = rf"((?:{_QUOTED})?+[^,]*+)"
_ROW = r"{cell}(?:,{cell})*+".format(cell=rf"(?:(?:{_QUOTED})?+[^,\r\n]*+)")
_LINE = r"[^\r\n]++"
# In a line that may hold carriage returns: whole cells from where one begins, and then a quote that does not close;
# what is left of quotes, and the quote that closes them.
_OUTSIDE = rf'(?:(?:{_QUOTED}[^,\r]*+|(?!")[^,\r]*+)[,\r])*+"(?:[^"]++|"")*+'
_INSIDE = r'(?:[^"]++|"")*+"'
_ABSENT = "is required and absent"
# Bytes of a file that one task reads at once.
WHOLE_UP_TO = 64 << 20


def scan_raw(
    spark: SparkSession,
    raw_dir: str,
    schema: T.StructType,
    quoted_breaks: bool = True,
    whole_up_to: int = WHOLE_UP_TO,
) -> DataFrame:
    """All raw rows as texts: the schema's columns in order, then source_file and source_pos.

    Each row is read by its own file's header. Columns that the schema does not name are dropped;
    nullable columns that a file lacks are null; a file lacking a required column is an error, and so
    is a row with more cells than its header, blank ones included. Blank lines count for nothing.

    With ``quoted_breaks`` a cell in quotes may hold line breaks; without, every line end ends a row. Neither
    depends on a file's size: files of up to ``whole_up_to`` bytes are read at once, each by one task, larger
    ones in pieces by many tasks, and the rows are the same.
    """
    rows = checked_scan(spark, raw_dir, schema, quoted_breaks, whole_up_to)
    return rejects.strict(rows, F.col(SOURCE_FILE))


def checked_scan(
    spark: SparkSession,
    raw_dir: str,
    schema: T.StructType,
    quoted_breaks: bool = True,
    whole_up_to: int = WHOLE_UP_TO,
) -> DataFrame:
    """As ``scan_raw``, but errors are faults of the rows. A file without a required column gives one faulty row
    for each such column's absence in all: its header."""
    files = list_files(spark, raw_dir, PATTERN)  # an error without files; no content is read
    long = not files.filter(F.col("length") > whole_up_to).isEmpty()
    rows = _whole_files(spark, raw_dir, schema, quoted_breaks, whole_up_to if long else None)
    if long:
        rows = rows.unionByName(_pieces(spark, raw_dir, schema, quoted_breaks, whole_up_to))
    values = [
        F.nullif(F.get("_cells", F.get("_places", F.lit(i)) - 1), F.lit("")) for i in range(len(schema))
    ]
    surplus = F.slice("_cells", F.col("_width") + 1, F.greatest(F.size("_cells"), F.lit(1)))
    too_long = (F.size("_absent") == 0) & (F.size("_cells") > F.col("_width"))
    surplus = rejects.fault(
        None, F.array_join(surplus, ","), F.when(too_long, F.lit("row with more cells than its header"))
    )
    absent = F.transform(
        "_absent",
        lambda name: F.struct(
            name.alias("column"), F.lit(None).cast("string").alias("text"), F.lit(_ABSENT).alias("reason")
        ),
    )
    rows = rows.select(
        *[value.alias(f.name, metadata=f.metadata) for f, value in zip(schema, values)],
        F.col("_file").alias(SOURCE_FILE),
        F.struct(F.col("_block").alias("block"), F.col("_row").alias("row")).alias(SOURCE_POS),
        absent.cast(rejects.FAULT_TYPE).alias(rejects.FAULTS),
        surplus.alias("_surplus"),
    )
    return rejects.with_faults(rows, [F.col("_surplus")]).drop("_surplus")


def split_cells(line: Column) -> Column:
    """A row's cells, quotes removed."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",{_CELL}"), F.lit(1))
    return F.when(F.contains(line, F.lit('"')), F.transform(cells, _unquoted)).otherwise(cells)


def _unquoted(cell: Column) -> Column:
    inside = F.regexp_extract(cell, f"^(?:{_QUOTED})", 0)
    behind = F.substring(cell, F.length(inside) + 1, F.length(cell))
    inside = F.substring(inside, F.lit(2), F.greatest(F.length(inside) - 2, F.lit(0)))
    return F.concat(F.replace(inside, F.lit('""'), F.lit('"')), behind)


def _with_header(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """For a header's cells in ``_header``: the place of each of the schema's columns (0: absent; a repeated name
    counts only the first time), the number of cells, and the required columns that are absent."""
    places = F.array(*[F.array_position("_header", f.name) for f in schema])
    required = [f.name for f in schema if f.metadata.get("required")]
    absent = F.array(*[F.when(F.array_position("_header", n) == 0, n).cast("string") for n in required])
    return rows.withColumns(
        {
            "_places": places,
            "_width": F.size("_header"),
            "_absent": F.array_compact(absent) if required else F.array().cast("array<string>"),
        }
    )


def _header(line: Column) -> Column:
    return split_cells(F.regexp_replace(line, "^\ufeff", ""))


def _rows_of(text: Column, quoted_breaks: bool) -> Column:
    """The rows of a text that begins where a row begins, blank ones left out."""
    found = F.regexp_extract_all(text, F.lit(_ROW if quoted_breaks else _LINE), F.lit(0))
    return F.filter(found, lambda row: F.trim(row) != "")


def _whole_files(
    spark: SparkSession, raw_dir: str, schema: T.StructType, quoted_breaks: bool, up_to: int | None
) -> DataFrame:
    texts = spark.read.option("pathGlobFilter", PATTERN).text(raw_dir, wholetext=True)
    if up_to is not None:  # prunes the listing
        texts = texts.filter(F.col("_metadata.file_size") <= up_to)
    rows = texts.select(file_name().alias("_file"), _rows_of(F.col("value"), quoted_breaks).alias("_rows"))
    rows = rows.filter(F.size("_rows") > 0)
    rows = rows.select("_file", "_rows", _header(F.get("_rows", F.lit(0))).alias("_header"))
    rows = _with_header(rows, schema)
    # Of a file that lacks a column only the header is left, to say so.
    kept = F.when(F.size("_absent") > 0, F.slice("_rows", 1, 1)).otherwise(F.col("_rows"))
    # Cells are cut before rows are spread, once: filters on them are not pushed below that.
    cells = F.posexplode(F.transform(kept, split_cells)).alias("_row", "_cells")
    rows = rows.select("_file", "_absent", "_places", "_width", cells)
    return rows.filter((F.col("_row") > 0) | (F.size("_absent") > 0)).select(
        "_file",
        "_absent",
        "_places",
        "_width",
        F.lit(0).cast("bigint").alias("_block"),
        F.col("_row").cast("bigint").alias("_row"),
        "_cells",
    )


def _pieces(
    spark: SparkSession, raw_dir: str, schema: T.StructType, quoted_breaks: bool, above: int
) -> DataFrame:
    """Rows of the files above a size, read in pieces of any size.

    A first pass tells each file's first line and whether any of its lines ends inside quotes. Where none does,
    which is the rule, every line begins a row, and lines are read as they come. Where one does, ``_stitched`` finds
    out which lines go together. Where cells may hold line breaks, lines end at line feeds alone, so that carriage
    returns are kept; a file that has no line feed is then one line, held by one task.
    """
    lines = _lines(spark, raw_dir, above, quoted_breaks)
    ends_open = _ends_open(F.col("_line")) if quoted_breaks else F.lit(False)
    filled = F.when(F.trim(F.regexp_replace("_line", "\r", "")) != "", F.struct("_block", "_at"))
    files = lines.groupBy("_path").agg(
        F.bool_or(ends_open).alias("_open"), F.min_by("_line", filled).alias("_first"), F.min(filled).alias("_start")
    )
    directory = scratch_dir(spark, "headers")
    files.filter("_start is not null").write.parquet(directory)
    files = spark.read.parquet(directory)
    plain = files.filter("not _open").select(
        "_path", "_start", _header(F.get(_rows_of(F.col("_first"), quoted_breaks), F.lit(0))).alias("_header")
    )
    rows = _spread(lines.join(_with_header(plain, schema), "_path"), quoted_breaks)
    if quoted_breaks and not files.filter("_open").isEmpty():
        texts = _stitched(lines.join(files.filter("_open").select("_path"), "_path", "left_semi"))
        first = texts.groupBy("_path").agg(
            F.min(F.struct("_block", "_at")).alias("_start"), F.min_by("_line", F.struct("_block", "_at")).alias("_first")
        )
        header = _header(F.get(_rows_of(F.col("_first"), True), F.lit(0))).alias("_header")
        headers = _with_header(first.select("_path", "_start", header), schema)
        rows = rows.unionByName(_spread(texts.join(headers, "_path"), True))
    return rows


def _lines(spark: SparkSession, raw_dir: str, above: int, quoted_breaks: bool) -> DataFrame:
    """Lines with their files and places."""
    reader = spark.read.option("pathGlobFilter", PATTERN)
    line_end = "\n" if quoted_breaks else None
    # The number in the task, whose lines of one piece follow each other.
    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return reader.text(raw_dir, lineSep=line_end).filter(F.col("_metadata.file_size") > above).select(
        F.col("_metadata.file_path").alias("_path"),
        file_name().alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        number.alias("_at"),
        F.col("value").alias("_line"),
    )


def _spread(texts: DataFrame, quoted_breaks: bool) -> DataFrame:
    """Texts that begin where a row begins to rows, without the file's header."""
    starts = F.struct("_block", "_at") == F.col("_start")
    bad = F.size("_absent") > 0
    rows = F.when(bad & ~starts, F.array().cast("array<string>")).otherwise(_rows_of(F.col("_line"), quoted_breaks))
    cells = F.posexplode(F.transform(rows, split_cells)).alias("_part", "_cells")
    spread = texts.select("_file", "_absent", "_places", "_width", "_block", "_at", starts.alias("_starts"), cells)
    header = F.col("_starts") & (F.col("_part") == 0)
    spread = spread.filter(F.when(F.size("_absent") > 0, header).otherwise(~header))
    return spread.select(
        "_file",
        "_absent",
        "_places",
        "_width",
        "_block",
        # A line may hold many rows that end in carriage returns.
        (F.col("_at") * (1 << 30) + F.col("_part")).alias("_row"),
        "_cells",
    )


def _ends_open(line: Column) -> Column:
    """Does a line that begins outside quotes end inside?"""
    return F.contains(line, F.lit('"')) & line.rlike(rf"^{_OUTSIDE}\z")


def _stitched(lines: DataFrame) -> DataFrame:
    """Lines that belong together as one text: _path, _file, _block, _at (of the first one), _line.

    A line takes one of two states, outside or inside quotes, to one of the two. Whatever the state before a piece,
    the one behind each of its lines follows from the last line that leads to the same state from both, and from
    how many lines since then swap them: a prefix scan within pieces. A second scan, over one row per piece, gives
    the state before each piece. A line that begins inside goes to the one before it. A quote that never closes
    takes all that follows into one text, where it is no quote.
    """
    line = F.col("_line")
    quoted = F.contains(line, F.lit('"'))
    closes = quoted & line.rlike(rf"^{_INSIDE}")
    behind = F.regexp_replace(line, rf"^{_INSIDE}", "")
    from_inside = ~closes | behind.rlike(rf"^[^,\r]*+[,\r]{_OUTSIDE}\z")
    in_piece = Window.partitionBy("_path", "_block").orderBy("_at")
    states = lines.select("*", _ends_open(line).cast("int").alias("_out"), from_inside.cast("int").alias("_in"))
    swaps = F.sum(F.when(F.col("_out") > F.col("_in"), 1).otherwise(0)).over(in_piece)
    states = states.withColumn("_swaps", swaps)
    settled = F.when(F.col("_out") == F.col("_in"), (F.col("_out") + F.col("_swaps")) % 2)
    states = states.withColumn("_settled", F.last(settled, ignorenulls=True).over(in_piece))
    # Behind each line: its state, where it doesn't depend on the piece's first one.
    whole = states.groupBy("_path", "_block").agg(
        F.max_by(F.struct("_settled", "_swaps"), "_at").alias("_last"),
    )
    in_file = Window.partitionBy("_path").orderBy("_block")
    flips = F.sum(F.col("_last._swaps")).over(in_file)
    whole = whole.select("_path", "_block", (flips % 2).alias("_flips"), F.col("_last._swaps").alias("_n"), "_last")
    known = F.when(
        F.col("_last._settled").isNotNull(), (F.col("_last._settled") + F.col("_n") + F.col("_flips")) % 2
    )
    whole = whole.withColumn("_known", F.coalesce(F.last(known, ignorenulls=True).over(in_file), F.lit(0)))
    after = (F.col("_known") + F.col("_flips")) % 2
    whole = whole.select("_path", "_block", F.coalesce(F.lag(after).over(in_file), F.lit(0)).alias("_before"))
    states = states.join(whole, ["_path", "_block"])
    state = (F.coalesce("_settled", "_before") + F.col("_swaps")) % 2
    begins_inside = F.coalesce(F.lag(state).over(in_piece), F.col("_before")) == 1
    own = F.when(~begins_inside, F.struct("_block", "_at"))
    states = states.withColumn("_own", F.last(own, ignorenulls=True).over(in_piece))
    # A piece that begins inside continues the last text that an earlier piece began.
    begun = states.groupBy("_path", "_block").agg(F.max("_own").alias("_begun"))
    earlier = F.last("_begun", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    begun = begun.select("_path", "_block", earlier.alias("_earlier"))
    states = states.join(begun, ["_path", "_block"]).withColumn("_text", F.coalesce("_own", "_earlier"))
    texts = states.groupBy("_path", "_file", "_text").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_at", "_line"))).alias("_lines")
    )
    joined = F.array_join(F.transform("_lines", lambda part: part["_line"]), "\n")
    texts = texts.select("_path", "_file", "_text._block", "_text._at", joined.alias("_line"))
    return texts.filter(F.trim(F.regexp_replace("_line", "[\r\n]", "")) != "")


def align_columns(frame: DataFrame, schema: T.StructType, where: str = "input") -> DataFrame:
    """Canonical projection of a table of texts: the schema's columns in its order, the rest
    dropped, absent nullable columns null, absent required columns an error."""
    for field in schema:
        if field.metadata.get("required") and field.name not in frame.columns:
            raise ValueError(f"required column '{field.name}' is absent from {where}")
    present = {name: col(name) for name in frame.columns}
    absent = F.lit(None).cast("string")
    return frame.select(
        *[present.get(f.name, absent).alias(f.name, metadata=f.metadata) for f in schema]
    )


def keep_from_year(
    frame: DataFrame, min_year: int = DEFAULT_MIN_YEAR, month_year: str = "MONTH-YEAR"
) -> DataFrame:
    """Rows whose text ends in a numeric year not before ``min_year``."""
    return frame.filter(is_from_year(col(month_year), min_year))


def enforce_types(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the schema's columns from text; other columns pass through. A text that can't be cast is an error."""
    return rejects.strict(checked_types(frame, schema))


def checked_types(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """As ``enforce_types``, but errors are faults of the rows. Rows that have faults already get no more."""
    present = [f for f in schema if f.name in frame.columns]
    typed = {f.name: _typed(f) for f in present}
    found = [fault for f in present if (fault := _fault(f)) is not None]
    if rejects.FAULTS in frame.columns:
        clear = F.size(rejects.FAULTS) == 0
        found = [F.when(clear, fault).otherwise(rejects.none()) for fault in found]
    checked = rejects.with_faults(frame, found)
    return checked.select(*[typed.get(n, col(n)) for n in checked.columns])


def ingest_rows(
    spark: SparkSession,
    raw_dir: str,
    schema: T.StructType,
    min_year: int = DEFAULT_MIN_YEAR,
    quoted_breaks: bool = True,
    whole_up_to: int = WHOLE_UP_TO,
) -> DataFrame:
    """Raw files to typed rows. The year filter comes first: only kept rows must be castable."""
    rows = checked_ingest(spark, raw_dir, schema, min_year, quoted_breaks, whole_up_to)
    return rejects.strict(rows, F.col(SOURCE_FILE))


def checked_ingest(
    spark: SparkSession,
    raw_dir: str,
    schema: T.StructType,
    min_year: int = DEFAULT_MIN_YEAR,
    quoted_breaks: bool = True,
    whole_up_to: int = WHOLE_UP_TO,
) -> DataFrame:
    """As ``ingest_rows``, but errors are faults of the rows: those of the files' rows of any year, those of cells
    only in the years that are kept."""
    rows = checked_scan(spark, raw_dir, schema, quoted_breaks, whole_up_to)
    kept = is_from_year(col("MONTH-YEAR"), min_year)
    rows = rows.filter(kept | (F.size(rejects.FAULTS) > 0))
    return checked_types(rows, schema)


def _fault(field: T.StructField) -> Column | None:
    if field.metadata["dtype"] != "int":
        return None
    text = col(field.name)
    required = field.metadata["required"]
    reason = casts.why_no_required_int(text) if required else casts.why_no_nullable_int(text)
    return rejects.fault(field.name, text, reason)


def _typed(field: T.StructField) -> Column:
    text, label = col(field.name), field.metadata["dtype"]
    if label == "int":
        value = casts.to_required_int(text) if field.metadata["required"] else casts.to_nullable_int(text)
    elif label == "float":
        value = casts.to_float(text)
    else:
        value = casts.to_text(text)
    return value.alias(field.name, metadata=field.metadata)
