"""Case lists for the column functions, and a plain-Python reading of the number rule."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellframe.functions import scalars as S

NUMBER_UNIT = [
    ("3.5 tỷ", 3.5, ". tỷ"), ("100 m²", 100.0, " m²"), ("100 m2", 1002.0, " m"), ("1,234,567", None, ",,"),
    ("1.200,5", None, ".,"), ("1.200", 1.2, "."), ("Thỏa thuận", None, "Thỏa thuận"), ("", None, None),
    (None, None, None), ("0", 0.0, ""), ("3 - 5", 35.0, " - "), ("..5", 0.5, ".."), (".,5", None, ".,"),
    ("12.", 12.0, "."), ("1..2", 1.2, ".."), ("5,", 5.0, ","), ("a1b2c3.4", 123.4, "abc."),
    ("850 triệu/m²", 850.0, " triệu/m²"), ("  7,5 ", 7.5, "  , "), ("٣ tỷ", None, "٣ tỷ"),
]
PROPERTY_ID = [
    ("/x-pr123.htm", "123"), ("/x-ad9.htm", "9"), ("/x-45.htm", "45"), ("/x-45", "45"), ("/x-pr1-pr2", "2"),
    ("/x-pr123.html", None), ("/x-pr12\n", None), ("/x-12\n", None), ("/xpr12", None), ("/x-PR12", None),
    (".htm", None), ("", None), (None, None), ("/a-1?x=2", None), ("/x-pr1.htm.htm", None), ("/x-pr1.htm\n", None),
]
STRIP = [
    (" a ", "a"), ("\xa0a\xa0", "a"), (" a\n", "a"), ("　", ""), ("\x1c z \x85", "z"), (None, None),
    ("a b", "a b"), ("​a", "​a"),
]


def evaluate(spark, values, *exprs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = df.select("i", *[e.alias(f"e{n}") for n, e in enumerate(exprs)]).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def test_number_and_unit(spark):
    got = evaluate(spark, [c[0] for c in NUMBER_UNIT], S.extract_number("x"), S.extract_unit("x"))
    assert got == [c[1:] for c in NUMBER_UNIT]


def plain_number(text):
    joined = "".join(re.findall(r"[0-9]*\.?,?[0-9]+", text))
    try:
        return float(joined.replace(",", "."))
    except ValueError:
        return None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,- mt", max_size=12), min_size=50, max_size=50))
def test_number_matches_plain_reading(spark, values):
    got = evaluate(spark, values, S.extract_number("x"))
    assert [g[0] for g in got] == [plain_number(v) for v in values]


def test_property_id(spark):
    got = evaluate(spark, [c[0] for c in PROPERTY_ID], S.extract_property_id("x"))
    assert [g[0] for g in got] == [c[1] for c in PROPERTY_ID]


def test_strip(spark):
    got = evaluate(spark, [c[0] for c in STRIP], S.py_strip("x"))
    assert [g[0] for g in got] == [c[1] for c in STRIP]
    every = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    assert evaluate(spark, [every + "a" + every], S.py_strip("x")) == [("a",)]


def test_listing_type_and_rchop(spark):
    cases = [("/a/b.htm", "b"), ("/a/b.c.d", "b"), ("nothing", None), ("/a/", ""), (None, None), ("", None)]
    got = evaluate(spark, [c[0] for c in cases], S.extract_listing_type("x"))
    assert [g[0] for g in got] == [c[1] for c in cases]
    assert evaluate(spark, ["a.htm", "a.htm.htm", "a"], S.rchop("x", ".htm")) == [("a",), ("a.htm",), ("a",)]


def test_links_and_keys(spark):
    row = spark.sql("select 'v' as vendor, '7' as id, cast(null as string) as none, 'sell' as type, ' /a ' as href, '' as blank")
    got = row.select(
        S.listing_key("vendor", "id", "type"), S.listing_key("vendor", "none", "type"), S.absolute_link("vendor", "href"),
        S.contact_link("vendor", "id"), S.contact_link("vendor", "blank"), S.blank_to_null("blank"),
        S.host_name(F.lit("http://h1.example.com:6800"), ".example.com:6800"),
        S.upgrade_scheme(F.lit("http://a?u=http://b")),
    ).first()
    assert tuple(got) == (
        "v:7:sell", "v:FAILURE:sell", "v/a", "v/doanh-nghiep/detail7", None, None, "h1", "https://a?u=https://b",
    )


def test_price_per_sqm(spark):
    df = spark.createDataFrame([(10.0, 4.0), (0.0, 4.0), (10.0, 0.0), (None, 4.0), (10.0, None)], "p double, z double")
    assert [r[0] for r in df.select(S.price_per_sqm("p", "z")).collect()] == [2.5, None, None, None, None]


@pytest.mark.parametrize("start", [dt.datetime(2024, 1, 1, 0, 0, 0, 500000), dt.datetime(2024, 3, 9, 23, 59, 59, 999999)])
def test_durations(spark, start):
    spans = [
        dt.timedelta(), dt.timedelta(seconds=59.999), dt.timedelta(minutes=61), dt.timedelta(days=2, hours=3, minutes=4),
        dt.timedelta(seconds=-1), dt.timedelta(days=-3, microseconds=1), dt.timedelta(microseconds=-1),
    ]
    df = spark.createDataFrame([(i, start + d, start) for i, d in enumerate(spans)], "i int, e timestamp_ntz, b timestamp_ntz")
    got = df.orderBy("i").select(
        S.runtime_minutes("e", "b", compat=True), S.runtime_minutes("e", "b"), S.days_hours_minutes("e", "b")
    ).collect()
    for d, row in zip(spans, got):
        assert row[0] == d.seconds // 60 % 60
        assert row[1] == (d.days * 86400 + d.seconds) // 60
        assert tuple(row[2]) == (d.days, d.seconds // 3600, d.seconds // 60 % 60)


def test_typed_parse(spark):
    df = spark.createDataFrame([("sell", 1.0), ("lease", 1.0), (None, 1.0)], "type string, v double")
    got = [r[0] for r in df.select(S.parse_for_types(F.col("v"), "type", ["sell", "rent"])).collect()]
    assert got == [1.0, None, None]
