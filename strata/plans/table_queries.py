"""Registered queries of versioned tables, warehouse runs and further dimension
loads, with their DuckDB twins. Each query loads its tables into a new folder on the
checkpoint storage, which is removed when the application ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dims import load_dimension
from strata.operators.facts import Lookup, resolve_lookups
from strata.operators.joins import anti_join
from strata.operators.profiles import RELATIVE_ERROR, record_profile
from strata.operators.schema import shrink
from strata.plans import forms, oracle, revenue
from strata.plans.ingest_oracle import MULTI_VINTAGE_APPEND
from strata.plans.ingest_queries import order_vintages
from strata.plans.standins import esat_statistics, forms_sources, revenue_bronze, survey_wide
from strata.plans.warehouse import Bronze, Warehouse, load_gold_all, load_silver_all
from strata.session import fresh_path
from strata.sources.files import read_table
from strata.sources.tables import VersionedTable


def _staged(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Three vintages of orders, the second one loaded twice under one id."""
    table = VersionedTable(spark, fresh_path(spark, "orders_raw"))
    vintages = order_vintages(spark, sf_dir)
    for load_id, df in (("v1", vintages[0]), ("v2", vintages[1]), ("v2", vintages[1]), ("v3", vintages[2])):
        table.append(df, load_id)
    return table


def q_versioned_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three vintages staged into one table; the log evolves, files are not rewritten."""
    return _staged(spark, sf_dir).read()


def q_versioned_stage_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load of ``versioned_stage`` did."""
    return _staged(spark, sf_dir).journal()


def q_table_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers loaded, refreshed from the table's own rows, and new ones inserted."""
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    table = VersionedTable(spark, fresh_path(spark, "customers"))
    table.replace(customers)
    table.replace(table.read().where("c_acctbal > 0").withColumn("c_mktsegment", F.lower("c_mktsegment")))
    table.append(customers.join(table.read().select("c_custkey"), "c_custkey", "left_anti").select("c_custkey", "c_acctbal"))
    return table.read()


def q_warehouse_run_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver then gold from the forms and survey sources, run twice under one id:
    each table with its commits and rows."""
    wh = Warehouse(spark, fresh_path(spark, "warehouse"))
    src = forms_sources(spark, sf_dir)
    bronze = Bronze(anio=src["anio"], formulario=src["formulario"], preguntas=src["preguntas"], respuestas=src["respuestas"], survey=survey_wide(spark, sf_dir))
    for _ in range(2):
        load_silver_all(wh, bronze, "run-1")
        load_gold_all(wh, "run-1")
    return wh.journal().groupBy("layer", "table").agg(F.count("*").alias("commits"), F.sum("rows").alias("n_rows"))


def q_dim_funding_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The budget rows' sources of funding, incrementally: a second load adds nothing."""
    rows = revenue_bronze(spark, sf_dir).select("FUENTE_FINANCIAMIENTO", "FUENTE_FINANCIAMIENTO_NOMBRE")
    first = load_dimension(rows, None, revenue.DIM_FUENTE_FINANCIAMIENTO).dim
    return load_dimension(rows, first, revenue.DIM_FUENTE_FINANCIAMIENTO).dim


def q_dim_location_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations of the municipal statistics source."""
    return load_dimension(esat_statistics(spark, sf_dir), None, forms.DIM_UBIGEO_ESTADISTICA).dim


def q_shrink_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer columns of parts at their narrowest type, which is told."""
    part = shrink(read_table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    return part.select(*(c for n in part.columns for c in (F.col(n).cast("bigint").alias(n), F.typeof(n).alias(f"{n}_type"))))


def q_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders profiled in three yearly vintages and merged from the stored profiles,
    beside the exact distinct counts of all rows: are they within four standard errors?"""
    table = VersionedTable(spark, fresh_path(spark, "profiles"))
    orders = read_table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    for load_id, part in (("v1", year < 1997), ("v2", year.between(1997, 1998)), ("v3", (year > 1998) | year.isNull())):
        merged = record_profile(table, orders.where(part), load_id)
    exact = orders.agg(*(F.count_distinct(c).alias(c) for c in orders.columns)).unpivot([], orders.columns, "column_name", "exact")
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.col("exact") * (4 * RELATIVE_ERROR), F.lit(1.0))
    return merged.join(exact, "column_name").select("column_name", "category", "n_rows", "n_nulls", "min_value", "max_value", "max_len", near.alias("distinct_near"))


def q_lookup_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events looked up in two dimensions that count as too large to broadcast: rows
    of frequent keys meet a broadcast of those keys, the rest are shuffled."""
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    dims = {"customer": read_table(spark, sf_dir, "customer"), "kind": read_table(spark, sf_dir, "events").select("event_type", "event_id")}
    lookups = [
        Lookup("customer", "c_nationkey", ("c_custkey",), ("user_id",)),
        Lookup("kind", "event_id", ("event_type",), ("event_type",), as_col="first_event"),
    ]
    return resolve_lookups(events, dims, lookups, max_broadcast_rows=0).select("event_id", "user_id", "value", "c_nationkey", "first_event")


def q_anti_join_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that are not in a dimension that counts as too large to
    broadcast: a bitmap of its hashed keys tells which are certainly new."""
    known = read_table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return anti_join(orders, known, ["o_custkey"], max_rows=0)


QUERIES = {
    "lookup_split": q_lookup_split,
    "anti_join_bitmap": q_anti_join_bitmap,
    "profile_merged": q_profile_merged,
    "versioned_stage": q_versioned_stage,
    "versioned_stage_journal": q_versioned_stage_journal,
    "table_full_refresh": q_table_full_refresh,
    "warehouse_run_journal": q_warehouse_run_journal,
    "dim_funding_source": q_dim_funding_source,
    "dim_location_statistics": q_dim_location_statistics,
    "shrink_integers": q_shrink_integers,
}

_YEARS = "count(*) FROM (SELECT 0 UNION SELECT 2020 UNION SELECT 2000 + turn FROM conversations UNION SELECT 2001 + turn FROM conversations)"
_COUNTS = (
    ("silver", "DIM_ANIO_APLICACION", "count(DISTINCT turn) FROM conversations"),
    ("silver", "DIM_EJECUTORA", "count(DISTINCT role) FROM conversations"),
    ("silver", "DIM_FORMULARIO_SISMEPRE", "count(DISTINCT conv_id) FROM conversations"),
    ("silver", "DIM_PREGUNTA_SISMEPRE", "count(*) FROM (SELECT DISTINCT conv_id, turn, role FROM conversations)"),
    ("silver", "DIM_PREGUNTA_RENAMU", f"count(*) FROM (WITH {oracle._SURVEY} SELECT * FROM d_q)"),
    ("silver", "DIM_TIEMPO", _YEARS),
    ("silver", "DIM_UBIGEO", "count(*) FROM (SELECT DISTINCT n_regionkey, c_nationkey, c_custkey % 10 FROM customer JOIN nation ON c_nationkey = n_nationkey)"),
    ("silver", "FACT_FORMULARIO_SISMEPRE", f"count(*) FROM ({oracle.FACT_DEPENDENT_LOOKUP})"),
    ("silver", "FACT_RENAMU", f"count(*) FROM ({oracle.FACT_SURVEY})"),
    ("gold", "SISMEPRE_DASHBOARD", f"count(*) FROM ({oracle.GOLD_FORMS_DASHBOARD})"),
    ("gold", "RENAMU_DASHBOARD", f"count(*) FROM ({oracle.GOLD_SURVEY_DASHBOARD})"),
)

_STATISTICS = """
SELECT DISTINCT n.n_regionkey AS cd, r.r_name AS dn, n.n_nationkey AS cp, n.n_name AS pn, CAST(c.c_custkey % 10 AS INTEGER) AS ci,
       n.n_name || '-' || CAST(c.c_custkey % 10 AS VARCHAR) AS di
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""

_FITTED = """(SELECT CASE WHEN max({0}) <= 32767 AND min({0}) >= -32768 THEN 'smallint'
  WHEN max({0}) <= 2147483647 AND min({0}) >= -2147483648 THEN 'int' ELSE 'bigint' END FROM part)"""

_PROFILED = (
    ("o_orderkey", "integer"), ("o_custkey", "integer"), ("o_orderstatus", "string"), ("o_totalprice", "float"), ("o_orderdate", "datetime"), ("o_orderpriority", "string"),
)


def _profile_row(column: str, kind: str) -> str:
    bound = lambda f: f"CAST({f}({column}) AS BIGINT)" if kind == "integer" else "CAST(NULL AS BIGINT)"
    length = f"CAST(max(length({column})) AS BIGINT)" if kind == "string" else "CAST(NULL AS BIGINT)"
    return (
        f"SELECT '{column}' AS column_name, '{kind}' AS category, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) - count({column}) AS BIGINT) AS n_nulls, "
        f"{bound('min')} AS min_value, {bound('max')} AS max_value, {length} AS max_len, true AS distinct_near FROM orders"
    )


ORACLE_SQL = {
    "lookup_split": """
SELECT e.event_id, e.user_id, e.value, c.c_nationkey, t.first_event FROM events e JOIN customer c ON c.c_custkey = e.user_id
JOIN (SELECT event_type, min(event_id) AS first_event FROM events GROUP BY event_type) t ON t.event_type = e.event_type""",
    "anti_join_bitmap": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal > 5000 AND c_custkey = o_custkey)""",
    "profile_merged": " UNION ALL ".join(_profile_row(c, k) for c, k in _PROFILED),
    "versioned_stage": MULTI_VINTAGE_APPEND,
    "versioned_stage_journal": """
SELECT CAST(0 AS BIGINT) AS version, 'append' AS operation, 'v1' AS load_id, count(*) FILTER (o_orderdate < DATE '1997-01-01') AS rows,
       CAST(1 AS INTEGER) AS parts, '' AS changes FROM orders
UNION ALL
SELECT 1, 'append', 'v2', count(*) FILTER (o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1999-01-01'), 2,
       'widen o_custkey string; widen amount decimal(18,4); widen approximate double; add o_orderpriority string' FROM orders
UNION ALL
SELECT 2, 'append', 'v3', count(*) FILTER (o_orderdate >= DATE '1999-01-01' OR o_orderdate IS NULL), 3, 'add o_orderdate timestamp_ntz' FROM orders""",
    "table_full_refresh": """
SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal > 0 THEN lower(c_mktsegment) END AS c_mktsegment FROM customer""",
    "warehouse_run_journal": " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS \"table\", CAST(1 AS BIGINT) AS commits, CAST((SELECT {count}) AS BIGINT) AS n_rows" for layer, name, count in _COUNTS
    ),
    "dim_funding_source": """
SELECT CAST(row_number() OVER (ORDER BY k, nm) AS BIGINT) AS IdFuenteFinanciamiento, k AS FUENTE_FINANCIAMIENTO, nm AS FUENTE_FINANCIAMIENTO_NOMBRE
FROM (SELECT DISTINCT o_orderstatus AS k, 'FUENTE ' || o_orderstatus AS nm
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE o_orderstatus IS NOT NULL)""",
    "dim_location_statistics": f"""
SELECT CAST(row_number() OVER (ORDER BY cd, cp, ci, dn, pn, di) AS BIGINT) AS IdUbigeo,
       cd AS CODIGODEPARTAMENTO, dn AS DEPARTAMENTO, cp AS CODIGOPROVINCIA, pn AS PROVINCIA, ci AS CODIGODISTRITO, di AS DISTRITO FROM ({_STATISTICS})""",
    "shrink_integers": f"""
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, {_FITTED.format("p_partkey")} AS p_partkey_type, CAST(p_size AS BIGINT) AS p_size, {_FITTED.format("p_size")} AS p_size_type FROM part""",
}
