import datetime as dt

import pytest
from pyspark.sql import types as T

from strata.operators.reshape import select_columns_like, unpivot_to_text
from strata.operators.schema import (
    align,
    append_vintages,
    fitted_schema,
    profile,
    reconcile,
    sanitise_dates,
    shrink,
    widen,
)
from tests.conftest import rows


def test_widen_lattice():
    assert widen(T.ShortType(), T.LongType()) == T.LongType()
    assert widen(T.LongType(), T.ShortType()) is None
    assert widen(T.IntegerType(), T.StringType()) == T.StringType()
    assert widen(T.StringType(), T.LongType()) is None  # text stays text
    assert widen(T.StringType(), T.StringType()) is None
    assert widen(T.DoubleType(), T.DecimalType(18, 2)) is None  # fractional tie keeps existing
    assert widen(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert widen(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert widen(T.TimestampType(), T.IntegerType()) == T.StringType()  # no silent datetime -> int


def test_widen_is_order_independent_on_numbers():
    nums = [T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()]
    for a in nums:
        for b in nums:
            ab = widen(a, b) or a
            ba = widen(b, a) or b
            assert ab == ba


def test_bigint_beside_double_keeps_every_digit(spark):
    assert widen(T.LongType(), T.DoubleType()) == widen(T.DoubleType(), T.LongType()) == widen(T.FloatType(), T.LongType()) == T.StringType()
    out = append_vintages([spark.createDataFrame([(2**53 + 1,)], "v bigint"), spark.createDataFrame([(0.5,)], "v double")])
    assert rows(out) == [("0.5",), ("9007199254740993",)]


def test_reconcile_adds_and_widens():
    stored = T.StructType([T.StructField("a", T.ShortType()), T.StructField("b", T.StringType())])
    new = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.LongType()), T.StructField("c", T.DateType())])
    evolved, changes = reconcile(stored, new)
    assert [(f.name, f.dataType) for f in evolved.fields] == [("a", T.LongType()), ("b", T.StringType()), ("c", T.DateType())]
    assert {(c.column, c.action) for c in changes} == {("a", "widen"), ("c", "add")}


def test_align_reorders_fills_drops_and_is_idempotent(spark):
    df = spark.createDataFrame([(1, "x", 9)], "b int, a string, extra int")
    target = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()), T.StructField("c", T.DateType())])
    out = align(df, target)
    assert out.columns == ["a", "b", "c"] and out.schema == target or [f.dataType for f in out.schema.fields] == [f.dataType for f in target.fields]
    assert rows(out) == [("x", 1, None)]
    assert rows(align(out, target)) == rows(out)


def test_append_vintages_int_and_text(spark):
    v1 = spark.createDataFrame([(1, 10)], "k bigint, v int")
    v2 = spark.createDataFrame([(2, "abc", "n")], "k bigint, v string, w string")
    out = append_vintages([v1, v2])
    assert [f.dataType for f in out.schema.fields] == [T.LongType(), T.StringType(), T.StringType()]
    assert rows(out) == [(1, "10", None), (2, "abc", "n")]


def test_profile_bounds_and_sizes(spark):
    df = spark.createDataFrame(
        [(-40000, 5, "abc", None, 1.5), (3, 32766, "", None, 2.0)],
        "neg int, small int, s string, allnull int, f double",
    )
    got = {r["column_name"]: r["suggested"] for r in profile(df).collect()}
    # negative below the smallint range is not a smallint (both bounds checked)
    assert got == {"neg": "INT", "small": "SMALLINT", "s": "NVARCHAR(100)", "allnull": "SMALLINT", "f": "NUMERIC"}
    long_text = spark.createDataFrame([("x" * 101,)], "s string")
    assert profile(long_text).collect()[0]["suggested"] == "NVARCHAR(200)"


def test_fitted_schema_and_shrink(spark):
    df = spark.createDataFrame([(1, 70000, 5_000_000_000)], "a bigint, b bigint, c bigint")
    sch = fitted_schema(df)
    assert [f.dataType for f in sch.fields] == [T.ShortType(), T.IntegerType(), T.LongType()]
    assert rows(shrink(df)) == [(1, 70000, 5_000_000_000)]


def test_sanitise_dates_only_text_columns_named_fecha(spark):
    df = spark.createDataFrame([("2024-05-06 07:08:09.5", "2024-05-06", 3)], "FECHA_ING string, other string, fecha_num int")
    out = sanitise_dates(df)
    r = out.collect()[0]
    assert r["FECHA_ING"] == dt.datetime(2024, 5, 6, 7, 8, 9) and r["other"] == "2024-05-06" and r["fecha_num"] == 3


def test_select_columns_like():
    cols = ["ccdd", "Provincia", "VFI", "P01", "p02", "vfi_p11a", "Distrito"]
    assert select_columns_like(cols) == ["Provincia", "VFI", "P01", "p02"]
    assert select_columns_like(cols, exclude=["Provincia"]) == ["VFI", "P01", "p02"]
    with pytest.raises(ValueError):
        select_columns_like(["a", "b"])


def test_unpivot_keeps_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, None, "", 7)], "id int, P1 string, P2 string, P3 int")
    out = unpivot_to_text(df, ["id"], ["P1", "P2", "P3"])
    assert rows(out) == [(1, "P1", None), (1, "P2", ""), (1, "P3", "7")]


def test_widening_keeps_every_digit(spark):
    D, F_, B = T.DecimalType, T.FloatType(), T.DoubleType()
    assert widen(D(10, 2), D(18, 4)) == D(18, 4) and widen(D(18, 4), D(10, 2)) is None
    assert widen(D(10, 2), D(8, 6)) == D(14, 6) and widen(D(5, 2), T.LongType()) == D(21, 2)
    assert widen(F_, B) == B and widen(B, F_) is None and widen(D(5, 2), B) == B and widen(F_, T.IntegerType()) == B
    assert widen(D(38, 0), D(38, 30)) == B
