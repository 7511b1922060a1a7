"""The coercion contract, spelled out value by value."""

import math

import pytest
from pyspark.sql import functions as F

from smeltery.functions.coerce import best_effort_timestamp, clean_str, duration_ms, iso_date, lax_float, lax_int, strict_str

INVALID = None
# JSON text -> (int, float, str)
MATRIX = {
    '"2024"': (2024, 2024.0, "2024"),
    '" 12 "': (12, 12.0, " 12 "),
    '"+5"': (5, 5.0, "+5"),
    '"007"': (7, 7.0, "007"),
    '"1.0"': (1, 1.0, "1.0"),
    '"12.000"': (12, 12.0, "12.000"),
    '"1_0"': (10, 10.0, "1_0"),
    '"1__0"': (INVALID, INVALID, "1__0"),
    '"1."': (INVALID, 1.0, "1."),
    '"1.5"': (INVALID, 1.5, "1.5"),
    '"1e3"': (INVALID, 1000.0, "1e3"),
    '"-3"': (-3, -3.0, "-3"),
    '""': (INVALID, INVALID, ""),
    '"nan"': (INVALID, math.nan, "nan"),
    '"inf"': (INVALID, math.inf, "inf"),
    '"5d"': (INVALID, INVALID, "5d"),
    '"1_0.5"': (INVALID, 10.5, "1_0.5"),
    '"true"': (INVALID, INVALID, "true"),
    "1.0": (1, 1.0, INVALID),
    "1.5": (INVALID, 1.5, INVALID),
    "1e3": (1000, 1000.0, INVALID),
    "1e10": (10**10, 1e10, INVALID),
    "2024": (2024, 2024.0, INVALID),
    "true": (1, 1.0, INVALID),
    "false": (0, 0.0, INVALID),
    "null": (INVALID, INVALID, INVALID),
    '{"a":1}': (INVALID, INVALID, INVALID),
    "[1]": (INVALID, INVALID, INVALID),
    # Beyond 64 bits: a documented difference, such integers are invalid here.
    "9223372036854775808": (INVALID, 9.223372036854775808e18, INVALID),
}


def test_matrix(spark):
    frame = spark.createDataFrame([(j,) for j in MATRIX], "j string")
    parsed = frame.select("j", F.parse_json("j").alias("v"))
    exprs = (lax_int("v"), lax_float("v"), strict_str("v"))
    rows = parsed.select("j", *(F.expr(e).alias(n) for e, n in zip(exprs, "ifs", strict=True))).collect()
    found = {r.j: (r.i, r.f, r.s) for r in rows}
    for text, expected in MATRIX.items():
        assert repr(found[text]) == repr(expected), text


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first().y


def title(_):
    return F.expr(clean_str("x"))


@pytest.mark.parametrize(
    "raw",
    [" british  ", "MONACO", "saint-denis o'neil 3rd", "côte d'ivoire", "\tmonaco \n", "", "日a b", "Dutch", "ÉCOLE"],
)
def test_clean_str_is_title_and_strip(spark, raw):
    assert one(spark, title, raw) == raw.title().strip()


def test_clean_str_keeps_null(spark):
    assert one(spark, title, None) is None


@pytest.mark.parametrize(
    ("raw", "ms"),
    [("23.456", 23456), ("1:23.456", 83456), ("1:29:18.303", 5358303), ("+5.1", None), ("", None), ("1:2:3:4", None), ("x", None), ("59", 59000)],
)
def test_duration(spark, raw, ms):
    assert one(spark, duration_ms, raw) == ms


@pytest.mark.parametrize(
    "raw",
    ["2024-01-30T12:00:05Z", "20240130T120005", "2024-01-30 12:00:05.999", "20240130120005", "1706616005", "30/01/2024 12:00:05"],
)
def test_timestamp_spellings(spark, raw):
    shown = one(spark, lambda c: F.date_format(best_effort_timestamp(c), "yyyy-MM-dd HH:mm:ss"), raw)
    assert shown == "2024-01-30 12:00:05"


def test_strict_timestamp_raises(spark):
    with pytest.raises(Exception, match="not a timestamp"):
        one(spark, lambda c: best_effort_timestamp(c, strict=True), "soon")


def test_dates(spark):
    assert str(one(spark, iso_date, "1985-01-07")) == "1985-01-07"
    assert one(spark, iso_date, "1985-02-30") is None
    assert one(spark, iso_date, "unknown") is None
