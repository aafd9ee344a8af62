"""Remaining edge cases of FIXTURES.md section 3."""

import os

import pytest

from strata.operators.dims import DimensionSpec, load_dimension_sources
from strata.operators.gold import string_agg
from strata.operators.modules import lower_columns, merge_modules, normalise_module
from strata.operators.profiling import partial_dependencies
from strata.sources.files import read_dataset, read_sample
from tests.conftest import rows

A = DimensionSpec(
    name="DIM_E",
    id_col="IdE",
    columns=(("SEC_EJEC", "CAST(code AS STRING)"), ("NOMBRE", "CAST(name AS STRING)")),
    key=("SEC_EJEC",),
)
B = DimensionSpec(
    name="DIM_E",
    id_col="IdE",
    columns=(("SEC_EJEC", "CAST(code AS STRING)"), ("NOMBRE", "CAST(muni AS STRING)")),
    key=("SEC_EJEC",),
    require=("SEC_EJEC IS NOT NULL", "NOMBRE IS NOT NULL"),
)


def test_first_source_wins_and_null_name(spark):
    budget = spark.createDataFrame([("10", "Budget name")], "code string, name string")
    stats = spark.createDataFrame([("10", "Other name"), ("20", None), ("30", "Muni")], "code string, muni string")
    dim = load_dimension_sources([(budget, A), (stats, B)])
    # code 10 keeps the first source's name; a NULL name is not loaded from the second source
    assert rows(dim) == [(1, "10", "Budget name"), (2, "30", "Muni")]


def test_merge_with_different_key_sets(spark):
    keys = ["ccdd", "idmunici"]
    m1 = normalise_module(spark.createDataFrame([("01", "x")], "CCDD string, a string"), keys)
    m2 = normalise_module(spark.createDataFrame([("1", "007", "y"), ("2", "8", "z")], "ccdd string, IDMUNICI string, b string"), keys)
    m3 = normalise_module(spark.createDataFrame([("7", "w"), (None, "nk")], "idmunici string, c string"), keys)
    res = merge_modules([("m1", m1), ("m2", m2), ("m3", m3)], keys)
    # m2 joins m1 on ccdd only (m1 has no idmunici); m3 joins on idmunici only;
    # m3's NULL-key row was dropped by normalisation (NULL makes the blank test unknown)
    assert res.frame.columns == ["idmunici", "ccdd", "a", "b", "c"]
    assert rows(res.frame) == [("7", "1", "x", "y", "w"), ("8", "2", None, "z", None)]


def test_lower_columns_collision_raises(spark):
    with pytest.raises(ValueError):
        lower_columns(spark.createDataFrame([(1, 2)], "Ubigeo int, UBIGEO int"))


def test_column_determined_by_two_subsets(spark):
    df = spark.createDataFrame(
        [(1, 1, "c", "p1"), (1, 2, "c", "p1"), (2, 1, "c", "p2")],
        "k1 int, k2 int, const string, dep string",
    )
    got = {(r["subset"], r["dependent"]) for r in partial_dependencies(df, ["k1", "k2"]).collect()}
    assert got == {("k1", "const"), ("k2", "const"), ("k1", "dep")}


def test_csv_header_inference_and_sample(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.csv")
    with open(p, "w") as fh:
        fh.write("a,b\n1,x\n2,y\n3,z\n")
    df = read_dataset(spark, p)
    assert dict(df.dtypes) == {"a": "int", "b": "string"}
    assert read_sample(spark, p, 2).count() == 2


def test_string_agg_keeps_duplicates_sorted(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", None), ("h", "c")], "k string, v string")
    assert rows(string_agg(df, ["k"], "v", ",", alias="vs")) == [("g", "a,b,b"), ("h", "c")]


def test_broadcast_is_bounded_in_bytes(spark):
    from strata.operators.joins import anti_join, bounded_broadcast, fits_broadcast

    wide = spark.range(50).selectExpr("id AS k", "repeat('x', 1000) AS t")
    assert fits_broadcast(wide) and not fits_broadcast(wide, max_bytes=10_000)
    assert fits_broadcast(wide.select("k"), max_bytes=10_000) and not fits_broadcast(wide.select("k"), max_bytes=100)
    joined = spark.range(9).withColumnRenamed("id", "k").join(bounded_broadcast(wide, max_bytes=10_000), "k")
    assert "hint" not in joined._jdf.queryExecution().logical().toString().lower() and joined.count() == 9
    assert anti_join(spark.range(60).withColumnRenamed("id", "k"), wide, ["k"]).count() == 10
