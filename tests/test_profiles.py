"""Mergeable column profiles against a profile of all rows."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.profiles import RELATIVE_ERROR, load_profile, merge_profiles, record_profile
from strata.operators.schema import profile
from strata.sources.tables import VersionedTable
from tests.conftest import SF_SMALL, rows


def test_merged_profile_equals_the_profile_of_all_rows(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    table = VersionedTable(spark, os.path.join(tmp_dir, "p"))
    for k in range(3):
        merged = record_profile(table, li.where(F.col("l_orderkey") % 3 == k), f"load-{k}")
    again = record_profile(table, li.where(F.col("l_orderkey") % 3 == 2), "load-2")  # the same load again
    assert rows(again) == rows(merged) and len(table.versions()) == 3
    whole = {r["column_name"]: r for r in profile(li).collect()}
    for r in merged.collect():
        want = whole[r["column_name"]]
        assert [r[c] for c in ("category", "min_value", "max_value", "max_len", "suggested")] == [want[c] for c in ("category", "min_value", "max_value", "max_len", "suggested")]
        exact = li.agg(F.count_distinct(r["column_name"])).first()[0]
        assert r["n_rows"] == li.count() and r["n_nulls"] == li.where(F.col(r["column_name"]).isNull()).count()
        assert r["distinct"] == pytest.approx(exact, rel=4 * RELATIVE_ERROR, abs=1)


def test_nulls_empty_loads_odd_names_and_mixed_types(spark):
    a = spark.createDataFrame([(None, "é"), (-12345, None)], "`it's, a` int, t string")
    b = spark.createDataFrame([("xy", [1])], "`it's, a` string, n array<int>")
    got = {r["column_name"]: r for r in merge_profiles(load_profile(a).unionByName(load_profile(b)).unionByName(load_profile(a.limit(0)))).collect()}
    assert got["it's, a"]["category"] == "string" and got["it's, a"]["max_len"] == 6 and got["it's, a"]["distinct"] == 2
    assert (got["t"]["n_rows"], got["t"]["n_nulls"], got["t"]["max_len"], got["t"]["distinct"]) == (2, 1, 1, 1)
    assert got["n"]["category"] == "nested" and got["n"]["distinct"] == 1
    assert rows(merge_profiles(load_profile(spark.range(1).select()))) == []
