"""Driver contract: entry() runs, every query has a SQL twin or is listed as
non-SQL, and a sample of queries equals its DuckDB twin on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if not math.isnan(v) else "nan"
    if hasattr(v, "quantize"):
        return float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "PORC_AVANCE_RECAUDACION" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize(
    "name",
    [
        "dim_incremental_load", "fact_survey", "module_merge_full_join", "fd_matrix", "csv_quote_repair",
        "csv_multiline_report", "link_discovery", "kpi_by_department",
    ],
)
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == sorted(df.columns)
    order = [df.columns.index(c) for c in sorted(df.columns)]
    dorder = [dcols.index(c) for c in sorted(dcols)]
    a = Counter(tuple(_norm(r[i]) for i in order) for r in df.collect())
    b = Counter(tuple(_norm(r[i]) for i in dorder) for r in rel.fetchall())
    assert a == b
