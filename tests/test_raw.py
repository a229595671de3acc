import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from monthspan.operators import rejects
from monthspan.sources import raw
from monthspan.sources.dictionary import archive_schema, build_schema, monthly_schema
from tests.helpers import COLUMNS, LEASE, line, write_file

SCHEMA = monthly_schema()


def ingest(spark, directory, **options):
    return raw.ingest_rows(spark, str(directory), SCHEMA, **options)


def test_sample_row(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [line()])
    row = ingest(spark, tmp_path).first()
    assert row["LEASE_KID"] == LEASE and row["PRODUCTION"] == 143.5 and row["WELLS"] == 2
    assert row["source_file"] == "lp1.txt"
    assert ingest(spark, tmp_path).columns == [*COLUMNS, "source_file", "source_pos"]


def test_old_years_and_sentinels_are_dropped(spark, tmp_path):
    texts = ["3-2023", "-1-1965", "0-1966", "1-abc", "", "6-2024", "3-2025"]
    write_file(tmp_path, "lp1.txt", [line(MONTH_YEAR=t) for t in texts])
    kept = [r["MONTH-YEAR"] for r in ingest(spark, tmp_path).collect()]
    assert sorted(kept) == ["3-2025", "6-2024"]


def test_no_rows_left_keeps_the_schema(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [line(MONTH_YEAR="3-2023")])
    frame = ingest(spark, tmp_path)
    assert frame.count() == 0
    assert [f.dataType for f in frame.schema][:20] == [f.dataType for f in SCHEMA]


def test_only_kept_rows_must_be_castable(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [line(LEASE_KID="x", MONTH_YEAR="3-2023"), line()])
    assert ingest(spark, tmp_path).count() == 1
    write_file(tmp_path, "lp2.txt", [line(LEASE_KID="x")])
    with pytest.raises(PySparkException, match="LEASE_KID"):
        ingest(spark, tmp_path).collect()


def test_required_column_absent(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [line()])
    fewer = [c for c in COLUMNS if c != "LEASE_KID"]
    write_file(tmp_path, "lp2.txt", [line(fewer)], fewer)
    for quoted_breaks in (True, False):
        with pytest.raises(PySparkException, match="LEASE_KID.*lp2.txt"):
            ingest(spark, tmp_path, quoted_breaks=quoted_breaks).collect()


def test_headers_differ_from_file_to_file(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [line(LEASE="A")])
    fewer = [c for c in COLUMNS if c not in ("LEASE", "LATITUDE")]
    write_file(tmp_path, "lp2.txt", [line(fewer, MONTH_YEAR="2-2024")], fewer)
    more = [*reversed(COLUMNS), "URL"]
    write_file(tmp_path, "lp3.txt", [line(more, MONTH_YEAR="3-2024", LEASE="C", URL="u")], more)
    rows = {r["source_file"]: r for r in ingest(spark, tmp_path).collect()}
    assert [rows[f"lp{i}.txt"]["LEASE"] for i in (1, 2, 3)] == ["A", None, "C"]
    assert [rows[f"lp{i}.txt"]["MONTH-YEAR"] for i in (1, 2, 3)] == ["1-2024", "2-2024", "3-2024"]
    assert rows["lp2.txt"]["LATITUDE"] is None and rows["lp3.txt"]["LATITUDE"] == 38.125
    assert {r["LEASE_KID"] for r in rows.values()} == {LEASE}
    archive = raw.scan_raw(spark, str(tmp_path), archive_schema())
    assert {r["source_file"]: r["URL"] for r in archive.collect()} == {
        "lp1.txt": None, "lp2.txt": None, "lp3.txt": "u",
    }


def test_quotes_blanks_and_short_rows(spark, tmp_path):
    rows = [
        line(LEASE='"SMITH, ""BIG"" J"'),
        line(LEASE="", FIELD='""', WELLS="unknown", TOWNSHIP="12.0", LATITUDE="NaN"),
        '1,"two\nlines"' + "," * 15 + "2-2024,G",
    ]
    write_file(tmp_path, "lp1.txt", rows)
    first, second, third = ingest(spark, tmp_path).orderBy("source_file", "source_pos").collect()
    assert first["LEASE"] == 'SMITH, "BIG" J'
    assert second["LEASE"] is None and second["FIELD"] is None and second["WELLS"] is None
    assert second["TOWNSHIP"] == 12 and second["LATITUDE"] is None
    assert third["LEASE"] == "two\nlines" and third["PRODUCT"] == "G" and third["PRODUCTION"] is None


@pytest.mark.parametrize("surplus", [",surplus", ",", ",,lost"])
@pytest.mark.parametrize("quoted_breaks", [True, False])
def test_row_longer_than_its_header(spark, tmp_path, surplus, quoted_breaks):
    write_file(tmp_path, "lp1.txt", [line() + surplus])
    with pytest.raises(PySparkException, match="more cells.*lp1.txt"):
        ingest(spark, tmp_path, quoted_breaks=quoted_breaks).collect()


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        ingest(spark, tmp_path / "absent")
    (tmp_path / "other.csv").write_text("a\n1\n")
    with pytest.raises(FileNotFoundError):
        ingest(spark, tmp_path)


ENDS = {"lf": "\n", "crlf": "\r\n", "cr": "\r"}


@pytest.mark.parametrize("header_end", ENDS)
@pytest.mark.parametrize("row_end", ENDS)
def test_any_line_end_in_pieces_of_any_size(spark, tmp_path, header_end, row_end):
    """Both ways of reading, and every size of pieces, give the rows that pandas gives."""
    lines = [line(LEASE_KID=str(i), LEASE=f'"L, ""{i}"""', PRODUCTION=str(i)) for i in range(600)]
    lines[7] = line(LEASE_KID="7", LEASE='5" pipe', PRODUCTION="7")
    text = ",".join(COLUMNS) + ENDS[header_end] + ENDS[row_end].join(lines) + "\n\r\n" + ENDS[row_end]
    (tmp_path / "lp1.txt").write_bytes(text.encode())
    wanted = pd.read_csv(tmp_path / "lp1.txt", dtype=str, keep_default_na=False)
    wanted = [tuple(v or None for v in row) for row in wanted.itertuples(index=False)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size, quoted_breaks in (("128m", True), ("128m", False), ("3001", True), ("3001", False)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            whole_up_to = 0 if size == "3001" else raw.WHOLE_UP_TO
            rows = raw.scan_raw(spark, str(tmp_path), SCHEMA, quoted_breaks, whole_up_to)
            rows = rows.orderBy("source_file", "source_pos").collect()
            assert [tuple(r)[:20] for r in rows] == wanted
            if whole_up_to == 0 and (row_end != "cr" or not quoted_breaks):
                assert len({r["source_pos"]["block"] for r in rows}) > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def quoted_texts():
    """Files with line breaks and marks in quotes, quotes that mean nothing and quotes that never close."""
    chance = random.Random(11)
    cells = ["a", "", '"two\nlines"', '"crlf\r\nin"', '"cr\rin"', '"say ""x"""', '5" pipe', '"q"tail', '"\n\n"', '"","', '""']
    files = []
    for _ in range(6):
        rows = [",".join([str(i), *chance.choices(cells, k=3)]) for i in range(chance.randint(1, 120))]
        ends = chance.choices(["\n", "\r\n", "\r", "\n\n"], k=len(rows))
        files.append("K,A,B,C\n" + "".join(map("".join, zip(rows, ends))))
    files += [
        "K,A,B,C\n1,x,y,z\n2,\"open,y\n3,a,b,c\n4,\"\"\"\",b,c\n",  # never closes
        'K,"A",B,"C"\r\n1,"' + "long\n" * 300 + '",b,c\r\n2,x,"y\n"\n3',  # a cell over many pieces
        '\n\n"K",A,B,C\n"1\n",2,3,4\n',
        "K,A,B,C",
        '"K\n,A",B\n1,2\n',
    ]
    return files


@pytest.mark.parametrize("size", ["50", "333"])
def test_quoted_line_breaks_in_pieces_of_any_size(spark, tmp_path, size):
    """Pieces give the rows that whole files give, faults included."""
    schema = build_schema([("K", "string", "no", ""), *[(c, "string", "yes", "") for c in "ABC"]])
    for i, text in enumerate(quoted_texts()):
        (tmp_path / f"lp{i}.txt").write_bytes(text.encode())

    def rows(whole_up_to):
        frame = raw.checked_scan(spark, str(tmp_path), schema, True, whole_up_to)
        found = frame.orderBy("source_file", "source_pos").collect()
        return [(*r[:5], r["faults"]) for r in found]

    wanted = rows(1 << 20)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        assert rows(0) == wanted
        assert rows(500) == wanted  # some files at once, others in pieces
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(wanted) > 200 and any(r[5] for r in wanted)


def test_a_large_file_without_breaks_in_quotes_is_not_shuffled(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [line(LEASE='"a, ""b"""')] * 50)
    plan = raw.scan_raw(spark, str(tmp_path), SCHEMA, True, 0)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan


def test_faults_name_every_bad_cell(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [
        line(), line(LEASE_KID="x", WELLS="1.5"), line() + ",more,,", line(LEASE_KID="y", MONTH_YEAR="1-2020"),
    ])
    fewer = [c for c in COLUMNS if c not in ("LEASE_KID", "PRODUCT")]
    write_file(tmp_path, "lp2.txt", [line(fewer)] * 3, fewer)
    for whole_up_to in (0, raw.WHOLE_UP_TO):
        checked = raw.checked_ingest(spark, str(tmp_path), SCHEMA, whole_up_to=whole_up_to)
        found = rejects.rejected(checked, ["source_file"]).collect()
        assert sorted(map(tuple, found), key=str) == sorted([
            ("lp1.txt", "LEASE_KID", "x", "needs a number"),
            ("lp1.txt", "WELLS", "1.5", "is not a whole number"),
            ("lp1.txt", None, "more,,", "row with more cells than its header"),
            ("lp2.txt", "LEASE_KID", None, "is required and absent"),
            ("lp2.txt", "PRODUCT", None, "is required and absent"),
        ], key=str)
        assert rejects.accepted(checked).count() == 1


def test_only_the_option_decides_whether_quotes_hold_line_breaks(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [line(LEASE='"two\nlines"')])
    assert ingest(spark, tmp_path).first()["LEASE"] == "two\nlines"
    rows = raw.scan_raw(spark, str(tmp_path), SCHEMA, quoted_breaks=False)
    assert rows.count() == 2


@pytest.mark.parametrize("quoted_breaks", [True, False])
def test_names_that_need_care(spark, tmp_path, quoted_breaks):
    """Files are read once each, and named as they are on disk."""
    names = ["lp1.txt", "lp[1].txt", "lp 1.txt", "lp%201.txt", "lp+1.txt", "lp{1,2}.txt", "lp*.txt", "lpé.txt"]
    fewer = [c for c in COLUMNS if c != "LEASE"]
    for i, name in enumerate(names):
        columns = fewer if i % 2 else COLUMNS
        write_file(tmp_path, name, [line(columns, LEASE_KID=str(i))], columns)
    rows = ingest(spark, tmp_path, quoted_breaks=quoted_breaks).collect()
    assert sorted((r["LEASE_KID"], r["source_file"]) for r in rows) == list(enumerate(names))


@pytest.mark.parametrize("name", ["_lp1.txt", ".lp1.txt"])
def test_a_file_that_spark_would_pass_over_is_an_error(spark, tmp_path, name):
    write_file(tmp_path, "lp2.txt", [line()])
    write_file(tmp_path, name, [line()])
    with pytest.raises(ValueError, match=name):
        ingest(spark, tmp_path)


def test_a_byte_order_mark_and_leading_blank_lines(spark, tmp_path):
    (tmp_path / "lp1.txt").write_text("\ufeff" + ",".join(COLUMNS) + "\n" + line() + "\n")
    (tmp_path / "lp2.txt").write_text("\n\n" + ",".join(COLUMNS) + "\n" + line() + "\n")
    (tmp_path / "lp3.txt").write_text(",".join(COLUMNS) + "\n")
    for quoted_breaks in (True, False):
        rows = ingest(spark, tmp_path, quoted_breaks=quoted_breaks).collect()
        assert sorted(r["source_file"] for r in rows) == ["lp1.txt", "lp2.txt"]
        assert {r["LEASE_KID"] for r in rows} == {LEASE}


def test_whole_files_are_read_once_without_a_shuffle(spark, tmp_path):
    write_file(tmp_path, "lp1.txt", [line()])
    write_file(tmp_path, "lp2.txt", [line(COLUMNS[::-1])], COLUMNS[::-1])
    plan = ingest(spark, tmp_path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize(
    ("text", "cells"),
    [
        ("a,b", ["a", "b"]),
        ("", [""]),
        (",", ["", ""]),
        ('"a,b",c', ["a,b", "c"]),
        ('"a ""b""",', ['a "b"', ""]),
        ('5" pipe,x', ['5" pipe', "x"]),
        ('"a"b,c', ["ab", "c"]),
        ('"open,c', ['"open', "c"]),
        (' "a",b', [' "a"', "b"]),
        ('"",""""', ["", '"']),
    ],
)
def test_cells(spark, text, cells):
    frame = spark.createDataFrame([(text,)], "line string")
    assert frame.select(raw.split_cells(frame["line"])).first()[0] == cells


def test_align_columns(spark):
    frame = spark.createDataFrame([("1-2024", "O", "7", "x")], ["MONTH-YEAR", "PRODUCT", "LEASE_KID", "more"])
    aligned = raw.enforce_types(raw.align_columns(frame, SCHEMA), SCHEMA)
    assert aligned.columns == COLUMNS
    assert aligned.schema["LATITUDE"].dataType == T.DoubleType()
    assert aligned.first()["LEASE_KID"] == 7
    with pytest.raises(ValueError, match="PRODUCT"):
        raw.align_columns(frame.drop("PRODUCT"), SCHEMA)
