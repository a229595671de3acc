import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from monthspan.functions import casts, links, months, volumes


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("1.5", 1.5), (" 7 ", 7.0), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("-2", -2.0), ("", None),
     (None, None), ("NaN", None), ("1.0d", None), ("n/a", None), ("1,000", None),
     ("inf", float("inf")), ("-Infinity", float("-inf"))],
)
def test_to_float(spark, text, expected):
    assert one(spark, text, casts.to_float) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("12", 12), ("12.0", 12), ("+3", 3), ("1e2", 100), ("", None), (None, None), ("unknown", None),
     ("9007199254740993", 9007199254740993)],
)
def test_nullable_int(spark, text, expected):
    assert one(spark, text, casts.to_nullable_int) == expected
    assert one(spark, text, casts.why_no_nullable_int) is None


@pytest.mark.parametrize("text", ["1.5", "inf", "1e30", "-0.25", "99999999999999999999"])
def test_nullable_int_says_why_a_number_is_none(spark, text):
    assert one(spark, text, casts.to_nullable_int) is None
    assert one(spark, text, casts.why_no_nullable_int) == "is not a whole number"


@pytest.mark.parametrize(
    ("text", "expected"),
    [("1001135839", 1001135839), ("7.9", 7), ("-7.9", -7), ("", None), ("abc", None), (None, None), ("1e30", None),
     ("inf", None)],
)
def test_required_int(spark, text, expected):
    assert one(spark, text, casts.to_required_int) == expected
    assert one(spark, text, casts.why_no_required_int) == (None if expected is not None else "needs a number")


def test_to_text(spark):
    assert one(spark, "", casts.to_text) is None
    assert one(spark, " ", casts.to_text) == " "


@pytest.mark.parametrize(
    ("text", "kept"),
    [("1-2024", True), ("6-2025", True), ("12-2023", False), ("-1-1965", False), ("0-1966", False),
     ("0-2024", True), ("-1-2024", True), ("1-abc", False), ("2024", True), ("1-", False), ("", False),
     (None, False), ("1-+2024", False), ("1-99999999999999999999", False)],
)
def test_year_filter(spark, text, kept):
    assert one(spark, text, lambda c: months.is_from_year(c, 2024)) is kept


@pytest.mark.parametrize(
    ("text", "date"),
    [("1-2024", dt.date(2024, 1, 1)), ("12-1999", dt.date(1999, 12, 1)), ("01-2024", dt.date(2024, 1, 1)),
     ("007-02024", dt.date(2024, 7, 1)), ("1-2024-9", dt.date(2024, 1, 1)), ("0-2024", None),
     ("-1-2024", None), ("13-2024", None), ("1-24", dt.date(24, 1, 1)), ("2024-1", None),
     ("1-1677", dt.date(1677, 1, 1)), ("12-2262", dt.date(2262, 12, 1)), ("4-2300", dt.date(2300, 4, 1)),
     ("12-9999", dt.date(9999, 12, 1)), ("x-2024", None), ("1", None), ("", None), (None, None), ("1-2024x", None)],
)
def test_month_start(spark, text, date):
    assert one(spark, text, months.month_start) == date
    assert one(spark, text, months.is_month) is (date is not None)
    claims = one(spark, text, months.claims_month)
    assert one(spark, text, months.why_no_month) == ("no such month" if claims and date is None else None)


@pytest.mark.parametrize("text", ["1-20244", "1-0", "12-10000", "1-99999999999"])
def test_a_year_that_no_date_holds(spark, text):
    assert one(spark, text, months.month_start) is None
    assert one(spark, text, months.why_no_month) == "no date has the year"


def test_every_month_of_every_year_is_read(spark):
    texts = [(f"{m}-{y}", y * 100 + m) for y in range(1600, 2400) for m in range(0, 14)]
    frame = spark.createDataFrame(texts, "t string, n int").filter(months.is_month(F.col("t")))
    date = months.month_start(F.col("t"))
    rows = frame.select("n", (F.year(date) * 100 + F.month(date)).alias("made")).collect()
    assert all(r["n"] == r["made"] for r in rows)
    assert len(rows) == 12 * 800


def test_guarded_arithmetic(spark):
    frame = spark.createDataFrame(
        [(1.0, 0.0), (0.0, 0.0), (0.0, 2.0), (6.0, 2.0), (None, 2.0), (1.0, None)], "a double, b double"
    )
    assert [r[0] for r in frame.select(volumes.ratio(F.col("a"), F.col("b"))).collect()] == [
        None, None, 0.0, 3.0, None, None,
    ]
    clip = lambda c: volumes.clip(c, -1.0, 10.0)
    for value, expected in [(-5.0, -1.0), (99.0, 10.0), (0.5, 0.5), (None, None), (-1.0, -1.0)]:
        assert one(spark, value, clip, "double") == expected
    for value, expected in [(0.0, 0.0), (1.0, 1.0), (1.01, None), (-0.1, None), (None, None)]:
        assert one(spark, value, volumes.share, "double") == expected
    assert one(spark, float("inf"), volumes.finite, "double") is None
    assert one(spark, float("nan"), volumes.not_nan, "double") is None


@pytest.mark.parametrize(
    ("url", "expected"),
    [("https://h.example/MainLease?f_lc=1001135839", "1001135839"), ("https://h.example/x?other=123", None),
     ("http://a.com?f_lc=1&f_lc=2", "1"), ("http://a.com?f_lc=&f_lc=2", "2"), ("http://a.com?f_lc=", None),
     ("http://a.com?a=1&f_lc=a%20b+c#f_lc=9", "a b c"), ("http://a.com#x?f_lc=1", None),
     ("http://a.com?xf_lc=1", None), ("not a url", None), (None, None),
     ("http://a b.com/{x}?f_lc=3", "3"), ("http://a.com?f_lc=1%2", "1%2")],
)
def test_query_parameter(spark, url, expected):
    assert one(spark, url, lambda c: links.query_parameter(c, "f_lc")) == expected


@pytest.mark.parametrize(
    ("html", "expected"),
    [('<a href="/x">x</a><a class=b href="/get.blob?p=1&amp;q=2">y</a>', "/get.blob?p=1&q=2"),
     ("<A HREF='/get.blob?a'>", "/get.blob?a"), ("<a href=/get.blob>x</a>", "/get.blob"),
     ('<a\n  id="i"\n href = "/b.blob">', "/b.blob"), ('<abbr href="/a.blob">', None),
     ('<!-- <a href="/c.blob"> --><a href="/d.blob">', "/d.blob"),
     ('<script>"<a href=\\"/e.blob\\">"</script>', None), ('<a data-href="/f.blob">', None),
     ('<a href="/1.blob"><a href="/2.blob">', "/1.blob"), ("", None), (None, None),
     ('<a href="/g.blob?a&#38;b&#x26;c&#X26;d">', "/g.blob?a&b&c&d"),
     ('<a href="/h.blob?&#233;&#x1F600;&amp;#38;">', "/h.blob?é😀&#38;"),
     ('<a href="/i.blob?&#0;&#x110000;&#xD800;&unknown;&">', "/i.blob?&#0;&#x110000;&#xD800;&unknown;&")],
)
def test_first_link(spark, html, expected):
    assert one(spark, html, lambda c: links.first_link(c, "blob")) == expected


def test_lease_page_url(spark):
    template = "https://h.example/m?f_lc={lease_id}&x=1"
    assert one(spark, "7", lambda c: links.lease_page_url(template, c)) == "https://h.example/m?f_lc=7&x=1"
