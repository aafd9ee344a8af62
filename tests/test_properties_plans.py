"""Property tests against brute-force rules, and plan checks."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.functions.exprs import is_blank, strip_leading_zeros
from strata.plans.revenue import load_revenue
from strata.plans.standins import revenue_bronze
from strata.session import materialize
from strata.sources.files import repair_quotes
from tests.conftest import SF_SMALL


def _repair_rule(line: str, sep: str) -> str:
    """The repair rule written directly in Python (reference for the property)."""
    structural = '"' + sep + '"'
    s = re.sub("\r+$", "", line).replace(structural, "\x01")
    if len(s) >= 2 and s.startswith('"') and s.endswith('"'):
        s = '"' + s[1:-1].replace('"', "") + '"'
    return s.replace("\x01", structural)


LINES = st.lists(
    st.text(alphabet=st.sampled_from(['"', ",", ";", "a", "b", " ", "\r", "é"]), max_size=12), min_size=1, max_size=60
)


@settings(max_examples=5, deadline=None)
@given(lines=LINES, sep=st.sampled_from([",", ";"]))
def test_repair_quotes_matches_rule(spark, lines, sep):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    got = {r["i"]: r["v"] for r in df.select("i", repair_quotes(F.col("value"), sep).alias("v")).collect()}
    assert got == {i: _repair_rule(s, sep) for i, s in enumerate(lines)}


@settings(max_examples=5, deadline=None)
@given(keys=st.lists(st.one_of(st.none(), st.text(alphabet="0 1a", max_size=5)), min_size=1, max_size=40))
def test_key_normalisation_matches_rule(spark, keys):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")
    out = df.select("i", strip_leading_zeros("k").alias("n"), is_blank(strip_leading_zeros("k")).alias("b")).collect()
    for r in out:
        k = keys[r["i"]]
        expect = None if k is None else k.lstrip("0")
        assert r["n"] == expect
        assert r["b"] == (None if expect is None else expect.strip(" ") == "")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_lookups_are_broadcast_and_no_python(spark):
    qs = E.queries()
    # the star itself, before its rows are stored
    star = _plan(load_revenue(materialize(revenue_bronze(spark, SF_SMALL), "ingreso_raw")).fact)
    assert star.count("BroadcastHashJoin") == 10 and "SortMergeJoin" not in star
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in star
    for name in ("gold_revenue_dashboard", "fd_matrix", "csv_quote_repair", "link_discovery", "module_merge_same_keys"):
        plan = _plan(qs[name](spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)
