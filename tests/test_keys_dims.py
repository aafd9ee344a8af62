from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.dims import (
    DimensionSpec,
    ensure_members,
    load_dimension,
    lookup_table,
    time_member,
    time_month_spec,
)
from strata.operators.keys import assign_surrogate_keys
from tests.conftest import rows

SPEC = DimensionSpec(
    name="DIM_X",
    id_col="IdX",
    columns=(("CODE", "CAST(code AS STRING)"), ("NAME", "CAST(name AS STRING)")),
    key=("CODE",),
)


import pytest


@pytest.mark.parametrize("small_rows", [10, 1_000_000])  # range path, bounded single-task path
def test_surrogate_keys_equal_global_row_number(spark, small_rows):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).cast("string").alias("k"), (F.col("id") % 3).alias("v"))
    got = assign_surrogate_keys(df, ["k", "v"], "sid", start=10, num_partitions=7, small_rows=small_rows)
    expect = df.select(F.row_number().over(Window.orderBy("k", "v")).alias("rn"), "k", "v")
    a = {(r["k"], r["v"]): r["sid"] for r in got.collect()}
    b = {(r["k"], r["v"]): r["rn"] + 10 for r in expect.collect()}
    assert a == b
    assert sorted(a.values()) == list(range(11, 5011))  # dense, unique


@pytest.mark.parametrize("small_rows", [10, 1_000_000])
def test_surrogate_keys_plan_has_no_single_partition_exchange(spark, small_rows):
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("k"))
    got = assign_surrogate_keys(df, ["k"], "sid", small_rows=small_rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_surrogate_keys_empty(spark):
    df = spark.createDataFrame([], "k string")
    assert assign_surrogate_keys(df, ["k"], "sid").count() == 0


def test_dimension_load_is_incremental_and_idempotent(spark):
    b1 = spark.createDataFrame([("01", "a"), ("02", "b"), ("02", "b2"), (None, "n")], "code string, name string")
    d1 = load_dimension(b1, None, SPEC)
    # two names for one code in one batch -> two rows; NULL key filtered
    assert rows(d1.dim) == [(1, "01", "a"), (2, "02", "b"), (3, "02", "b2")]
    b2 = spark.createDataFrame([("02", "other"), ("03", "c")], "code string, name string")
    d2 = load_dimension(b2, d1.dim, SPEC)
    # a known code is not inserted again; new ids continue after the maximum
    assert rows(d2.dim) == [(1, "01", "a"), (2, "02", "b"), (3, "02", "b2"), (4, "03", "c")]
    again = load_dimension(b2, d2.dim, SPEC)
    assert again.inserted.count() == 0
    assert rows(again.dim) == rows(d2.dim)


def test_dimension_max_id_read_from_stored_table(spark):
    stored = spark.createDataFrame([(40, "x", "X")], "IdX bigint, CODE string, NAME string")
    b = spark.createDataFrame([("y", "Y"), ("x", "dup")], "code string, name string")
    d = load_dimension(b, stored, SPEC)
    assert rows(d.dim) == [(40, "x", "X"), (41, "y", "Y")]


def test_lookup_table_lowest_id_per_truncated_key(spark):
    long_a = "A" * 50 + "tail1"
    long_b = "A" * 50 + "tail2"
    dim = spark.createDataFrame([(1, long_a), (2, long_b), (3, "b"), (4, "b")], "IdX bigint, CODE string")
    got = rows(lookup_table(dim, "IdX", ["CODE"], truncate=50))
    assert got == [("A" * 50, 1), ("b", 3)]


def test_time_dimension_mixed_grain_and_members(spark):
    src = spark.createDataFrame([("2024", "1"), ("2024", "1"), ("2024", None), ("x", "2")], "ANO_DOC string, MES_DOC string")
    t = load_dimension(src, None, time_month_spec("ANO_DOC", "MES_DOC")).dim
    t = ensure_members(t, [time_member(0, 0)], ["IdTiempo"])
    t = ensure_members(t, [time_member(0, 0), time_member(2020, 2020)], ["IdTiempo"])
    got = rows(t.select("IdTiempo", "ANIO", "MES"))
    assert got == [(0, 0, None), (2020, 2020, None), (202401, 2024, 1)]


def test_single_pass_dimension_loads_equal_individual_loads(spark):
    from strata.operators.dims import load_dimensions

    src = spark.createDataFrame(
        [("1", "a", "x", "2024"), ("1", "a2", "y", "bad"), ("2", "b", None, "2025"), (None, "n", "z", "2024")],
        "code string, name string, other string, yr string",
    )
    other = DimensionSpec(
        name="DIM_O",
        id_col="IdO",
        columns=(("O", "CAST(other AS STRING)"), ("Y", "coalesce(try_cast(yr AS INT), 0)")),
        key=("O",),
        source_filter="try_cast(yr AS INT) IS NOT NULL",
    )
    existing = {"DIM_X": spark.createDataFrame([(7, "2", "old")], "IdX bigint, CODE string, NAME string")}
    together = load_dimensions(src, [SPEC, other], existing)
    assert rows(together["DIM_X"].dim) == rows(load_dimension(src, existing["DIM_X"], SPEC).dim)
    assert rows(together["DIM_O"].dim) == rows(load_dimension(src, None, other).dim) == [(1, "x", 2024), (2, "z", 2024)]
    # a chained load after a filtered single-pass load continues densely (the NULL code was filtered)
    more = spark.createDataFrame([("9", "q")], "code string, name string")
    chained = load_dimension(more, load_dimensions(src, [SPEC])["DIM_X"].dim, SPEC).dim
    assert rows(chained) == [(1, "1", "a"), (2, "1", "a2"), (3, "2", "b"), (4, "9", "q")]
