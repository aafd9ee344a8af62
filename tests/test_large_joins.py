"""Joins with sides too large to broadcast, and the merge job over a folder."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from strata.operators.joins import anti_join, key_bitmap, may_exist, split_join
from strata.plans import registry
from strata.plans.module_merge import merge_module_folder
from strata.plans.standins import revenue_bronze
from strata.session import ensure_checkpoint_dir
from tests.conftest import SF_SMALL, rows


def _skewed(spark):
    left = spark.range(3000).select(F.col("id").alias("n"), F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 400) END").alias("k"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k1", 3), ("k7", 4), (None, 5), ("unused", 6)], "rk string, v int")
    return left, right


def test_split_join_equals_the_plain_join(spark):
    left, right = _skewed(spark)
    want = rows(left.join(right, F.col("k") == F.col("rk")))
    for share in (0.05, 1.1, 0.0001):  # one frequent key, none, all
        assert rows(split_join(left, right, [F.col("k")], ["rk"], share=share, sample=1.0)) == want
    # frequent keys whose rows do not fit are left to the shuffle
    assert rows(split_join(left, right, [F.col("k")], ["rk"], share=0.05, sample=1.0, max_rows=0)) == want
    assert rows(split_join(left.limit(0), right, [F.col("k")], ["rk"])) == []


def test_a_hot_key_is_not_shuffled(spark):
    left, right = _skewed(spark)
    plan = split_join(left, right, [F.col("k")], ["rk"], share=0.05, sample=1.0)._jdf.queryExecution().optimizedPlan().toString()
    # both ways: the frequent key's rows by a broadcast, and none of them in the other
    assert plan.count("Join Inner") == 2 and "LeftAnti" in plan and "strategy=broadcast" in plan


def test_anti_join_by_bitmap_equals_not_exists(spark):
    new = spark.createDataFrame([(i, f"t{i % 7}" if i % 11 else None, i) for i in range(2000)], "a int, b string, extra int")
    known = spark.createDataFrame([(i, f"t{i % 7}") for i in range(0, 2000, 3)] + [(None, "t1"), (22, None)], "a int, b string")
    want = rows(new.join(known, (new.a == known.a) & (new.b == known.b), "left_anti"))
    assert rows(anti_join(new, known, ["a", "b"], max_rows=0).select("a", "b", "extra")) == want
    assert rows(anti_join(new, known, ["a", "b"]).select("a", "b", "extra")) == want
    assert rows(anti_join(new, known.limit(0), ["a", "b"], max_rows=0)) == rows(new)
    # keys of other types hash differently, so all rows are joined
    wide = known.select(F.col("a").cast("bigint").alias("a"), "b")
    assert rows(anti_join(new, wide, ["a", "b"], max_rows=0).select("a", "b", "extra")) == want


@pytest.mark.parametrize("bits", [1, 1 << 10, 1 << 20])
def test_bitmap_never_denies_a_key(spark, bits):
    known = spark.range(0, 5000, 5).select(F.col("id").alias("k"))
    bitmaps = key_bitmap(known, ["k"], bits)
    assert bitmaps.count() <= bits // 32768 + 1
    flagged = may_exist(spark.range(5000).select(F.col("id").alias("k")), bitmaps, ["k"], bits, "may").collect()
    assert len(flagged) == 5000 and all(r["may"] for r in flagged if r["k"] % 5 == 0)
    if bits == 1 << 20:
        assert sum(r["may"] for r in flagged) < 1050


def test_merge_job(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "in", "sub")
    os.makedirs(folder)
    files = {
        "../A.csv": 'UBIGEO,Name\n"01","x "q" y"\n2,b\n,gone\n002,later\n',
        "B.CSV": "ubigeo,Name,N\n1,bb,5\n3,cc,6\n",
        "c.csv": "other,w\nq,1\n",
        "readme.txt": "ubigeo\n1\n",
    }
    for name, text in files.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text)
    root = os.path.join(tmp_dir, "in")
    done = merge_module_folder(spark, root, os.path.join(tmp_dir, "out"), "renamu", ["UBIGEO"])
    assert [os.path.basename(p) for p in done.written] == ["RENAMU.parquet"] and done.skipped == ["sub_c"]
    merged = spark.read.parquet(done.written[0])
    assert merged.columns == ["ubigeo", "name", "name_sub_B", "n"]
    assert rows(merged.select("ubigeo", F.col("name").isNull(), "name_sub_B", "n")) == [("1", False, "bb", 5), ("2", False, None, None), ("3", True, "cc", 6)]
    alone = merge_module_folder(spark, root, os.path.join(tmp_dir, "each"), "renamu")
    assert sorted(os.path.basename(p) for p in alone.written) == ["RENAMU_A.parquet", "RENAMU_SUB_B.parquet", "RENAMU_SUB_C.parquet"]
    os.makedirs(os.path.join(tmp_dir, "none"))
    for keys in ((), ("k",)):
        with pytest.raises(ValueError):
            merge_module_folder(spark, os.path.join(tmp_dir, "none"), tmp_dir, "x", keys)


def test_budget_lines_are_shuffled_once_for_each_large_table(spark):
    """Orders meet the customers first, so a line is not shuffled for its customer."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = revenue_bronze(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    depth = {k: next(line.index("Join") for line in joins if k in line) for k in ("l_orderkey", "o_custkey")}
    assert len(joins) == 6 and depth["o_custkey"] > depth["l_orderkey"]  # below the join of the lines


def test_budget_load_leaves_no_bronze_table(spark, tmp_path):
    for t in registry.BUDGET_TABLES:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path)
    tables = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "tables")
    held = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    got = registry.QUERIES["kpi_by_department"](spark, str(tmp_path)).collect()
    names = sorted(n.split("-")[0] for n in set(os.listdir(tables)) - held)
    assert got and names == ["FACT_INGRESO_DIARIO", "INGRESOS_DASHBOARD"]
    assert registry.QUERIES["fact_lookup_star"](spark, str(tmp_path)).count() > 0
