import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions import exprs as X


def test_try_int_is_lenient(spark):
    df = spark.createDataFrame([("1",), ("",), ("1.5",), (" 5 ",), ("abc",), (None,)], "v string")
    got = [r[0] for r in df.select(X.try_int("v")).collect()]
    assert got == [1, None, None, 5, None, None]
    got0 = [r[0] for r in df.select(X.try_int_or_zero("v")).collect()]
    assert got0 == [1, 0, 0, 5, 0, 0]


def test_try_decimal_or_zero(spark):
    df = spark.createDataFrame([("12.345",), ("x",), (None,), ("-0.005",)], "v string")
    got = [r[0] for r in df.select(X.try_decimal_or_zero("v")).collect()]
    assert got == [Decimal("12.35"), Decimal("0.00"), Decimal("0.00"), Decimal("-0.01")]


def test_strip_leading_zeros_and_blank(spark):
    df = spark.createDataFrame([("01",), ("1",), ("000",), ("",), ("  ",), (None,), ("0a0",)], "v string")
    got = [tuple(r) for r in df.select(X.strip_leading_zeros("v"), X.is_blank(X.strip_leading_zeros("v"))).collect()]
    assert got == [("1", False), ("1", False), ("", True), ("", True), ("  ", True), (None, None), ("a0", False)]


def test_sanitise_name(spark):
    df = spark.createDataFrame([('Ingreso 2024: "diario"/v1.CSV',), ("a b.zip",)], "v string")
    got = [r[0] for r in df.select(X.sanitise_name("v")).collect()]
    assert got == ["INGRESO_2024_DIARIOV1", "A_B"]


def test_extract_year(spark):
    df = spark.createDataFrame([("Presupuesto 2023 anual",), ("x12024",), ("1999 y 2025",), ("none",)], "v string")
    assert [r[0] for r in df.select(X.extract_year("v")).collect()] == [2023, None, 2025, None]


def test_lenient_timestamp(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05.123456",), ("2024-01-02",), ("junk",), (None,)], "v string")
    got = [r[0] for r in df.select(X.lenient_timestamp("v")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2), None, None]


def test_safe_ratio_zero_and_null(spark):
    df = spark.createDataFrame(
        [(Decimal("5.00"), Decimal("10.00")), (Decimal("5.00"), Decimal("0.00")), (Decimal("1.00"), None), (Decimal("1.00"), Decimal("3.00"))],
        "n decimal(18,2), d decimal(18,2)",
    )
    got = [r[0] for r in df.select(X.safe_ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("0.500000"), Decimal("0.000000"), None, Decimal("0.333333")]


def test_year_month_key(spark):
    df = spark.createDataFrame([("2024", "3"), ("2024", None), ("x", "1")], "y string, m string")
    assert [r[0] for r in df.select(X.year_month_key("y", "m")).collect()] == [202403, None, None]


def test_resolve_relative_url(spark):
    df = spark.createDataFrame([("/a/b", "https://h.example.org/x/y?q=1"), ("http://o/z", "https://h/")], "h string, u string")
    got = [r[0] for r in df.select(X.resolve_relative_url("h", "u")).collect()]
    assert got == ["https://h.example.org/a/b", "http://o/z"]


def test_like_to_regex():
    import re

    rx = re.compile(X.like_to_regex("P%"), re.I)
    assert rx.match("P01") and rx.match("Provincia") and rx.match("p_x") and not rx.match("VFI")
    assert re.match(X.like_to_regex("a_c"), "abc") and not re.match(X.like_to_regex("a_c"), "abbc")
    assert re.match(X.like_to_regex("a.b%"), "a.bx") and not re.match(X.like_to_regex("a.b"), "axb")


def test_day_first_dates_and_overflow(spark):
    df = spark.createDataFrame([("31/12/2020 10:00:00", "2000000000"), ("31-12-2020", "2020"), ("1/2/2020", "x")], "v string, y string")
    got = [str(r[0]) for r in df.select(X.lenient_timestamp("v")).collect()]
    assert got == ["2020-12-31 10:00:00", "2020-12-31 00:00:00", "2020-02-01 00:00:00"]
    assert [r[0] for r in df.select(X.year_month_key("y", F.lit("3"))).collect()] == [None, 202003, None]
