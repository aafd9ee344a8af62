"""Registered dependency-profiling queries and their DuckDB twins."""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.profiling import (
    NULLS_IGNORED,
    candidate_keys_frame,
    declared_fd_check,
    declared_fd_violations,
    fd_matrix,
    functional_dependencies,
    normalize_2nf,
    partial_dependencies,
)
from strata.sources.files import read_table

# ---------------------------------------------------------------------------
# Spark


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")


def q_fd_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return functional_dependencies(_order_lines(spark, sf_dir), "l_orderkey")


def q_fd_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fd_matrix(read_table(spark, sf_dir, "part"))


def q_fd_matrix_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fd_matrix(read_table(spark, sf_dir, "lineitem"))


DECLARED = [("p_brand", ["p_type", "p_size"]), ("p_partkey", ["p_name", "p_brand"]), ("p_type", ["p_brand"])]


def q_fd_declared_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return declared_fd_check(read_table(spark, sf_dir, "part"), DECLARED)


SHOWN = ["p_partkey", "p_brand", "p_type", "p_size"]


def q_fd_declared_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first violating groups of each violated dependency, with the two rows of
    each that are furthest apart."""
    declared = [(det, [y for y in deps if y in SHOWN]) for det, deps in DECLARED]
    shown = declared_fd_violations(read_table(spark, sf_dir, "part").select(*SHOWN), declared)
    return shown.select("determinant", "dependent", "key", "n_rows", F.col("samples")[0].alias("lowest"), F.col("samples")[1].alias("highest"))


ROWS_PER_TASK = 1_000_000


def _part_supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_partkey, l_suppkey) with sum(l_quantity), joined to part and supplier. The
    rows are dealt by key to tasks of about ROWS_PER_TASK, as most keys occur once."""
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    tasks = max(spark.sparkContext.defaultParallelism, -(-li.count() // ROWS_PER_TASK))
    li = li.repartition(tasks, "l_partkey", "l_suppkey")
    pairs = li.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("sum_qty"))
    part = read_table(spark, sf_dir, "part")
    supp = read_table(spark, sf_dir, "supplier")
    return pairs.join(part, pairs.l_partkey == part.p_partkey).drop("p_partkey").join(
        supp, F.col("l_suppkey") == supp.s_suppkey
    ).drop("s_suppkey")


PK = ["l_partkey", "l_suppkey"]


def q_partial_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partial_dependencies(_part_supplier_lines(spark, sf_dir), PK, NULLS_IGNORED)


def q_normalize_2nf_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_2nf(_part_supplier_lines(spark, sf_dir), PK)["l_partkey"]


def q_normalize_2nf_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_2nf(_part_supplier_lines(spark, sf_dir), PK)["l_suppkey"]


def q_normalize_2nf_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_2nf(_part_supplier_lines(spark, sf_dir), PK)["main"]


def q_candidate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = candidate_keys_frame(read_table(spark, sf_dir, "nation"), "nation")
    b = candidate_keys_frame(read_table(spark, sf_dir, "conversations"), "conversations")
    return a.unionByName(b)


def q_candidate_keys_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of orders of any size, and of lineitem of at most two columns."""
    orders = candidate_keys_frame(read_table(spark, sf_dir, "orders"), "orders")
    return orders.unionByName(candidate_keys_frame(read_table(spark, sf_dir, "lineitem"), "lineitem", 2))


QUERIES = {
    "fd_matrix_lineitem": q_fd_matrix_lineitem,
    "candidate_keys_orders": q_candidate_keys_orders,
    "fd_single": q_fd_single,
    "fd_matrix": q_fd_matrix,
    "fd_declared_check": q_fd_declared_check,
    "fd_declared_violations": q_fd_declared_violations,
    "partial_dependencies": q_partial_dependencies,
    "normalize_2nf_part": q_normalize_2nf_part,
    "normalize_2nf_supplier": q_normalize_2nf_supplier,
    "normalize_2nf_main": q_normalize_2nf_main,
    "candidate_keys": q_candidate_keys,
}

# ---------------------------------------------------------------------------
# DuckDB


def _holds(table: str, x: str, y: str, nulls_ignored: bool = False) -> str:
    """SQL boolean: in every group of ``x``, ``y`` has at most one value."""
    if nulls_ignored:
        const = f"(count({y}) = 0 OR min({y}) = max({y}))"
        where = " WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in x.split(","))
    else:
        const = f"(count({y}) = 0 OR (count({y}) = count(*) AND min({y}) = max({y})))"
        where = ""
    return f"coalesce((SELECT bool_and(ok) FROM (SELECT {const} AS ok FROM {table}{where} GROUP BY {x}) g), true)"


ORDER_LINES = """
ol AS (SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_returnflag,
              o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate
       FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""
ORDER_LINE_COLS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
                   "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]

FD_SINGLE = f"WITH {ORDER_LINES}\n" + "\nUNION ALL ".join(
    f"SELECT 'l_orderkey' AS determinant, '{y}' AS dependent WHERE {_holds('ol', 'l_orderkey', y)}" for y in ORDER_LINE_COLS
)

PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
FD_MATRIX = "\nUNION ALL ".join(
    f"SELECT '{x}' AS determinant, '{y}' AS dependent WHERE {_holds('part', x, y)}" for x, y in permutations(PART_COLS, 2)
)


def _declared_sql() -> str:
    parts = []
    for det, deps in DECLARED:
        for y in deps:
            parts.append(
                f"SELECT '{det}' AS determinant, '{y}' AS dependent, CAST(count(*) AS BIGINT) AS n_groups, "
                f"CAST(sum(CASE WHEN count_y = 0 OR (count_y = n AND mn = mx) THEN 0 ELSE 1 END) AS BIGINT) AS n_violations "
                f"FROM (SELECT count({y}) AS count_y, count(*) AS n, min({y}) AS mn, max({y}) AS mx FROM part GROUP BY {det}) g"
            )
    return "\nUNION ALL ".join(parts)


FD_DECLARED_CHECK = _declared_sql()


def _json_sql(columns: list[str]) -> str:
    quoted = lambda c: f"coalesce('\"' || {c} || '\"', 'null')" if c in ("p_brand", "p_type") else f"coalesce(CAST({c} AS VARCHAR), 'null')"
    return "'{' || " + " || ',' || ".join(f"'\"{c}\":' || {quoted(c)}" for c in columns) + " || '}'"


def _violations_sql() -> str:
    parts = []
    for det, deps in DECLARED:
        for y in deps:
            if y not in SHOWN:
                continue
            ordered = f"list({_json_sql(SHOWN)} ORDER BY {y} NULLS FIRST, {_json_sql(SHOWN)})"
            parts.append(
                f"SELECT * FROM (SELECT '{det}' AS determinant, '{y}' AS dependent, {_json_sql([det])} AS key, CAST(count(*) AS BIGINT) AS n_rows, "
                f"{ordered}[1] AS lowest, {ordered}[-1] AS highest FROM part GROUP BY {det} "
                f"HAVING min({y}) <> max({y}) OR (count({y}) > 0 AND count({y}) < count(*)) ORDER BY {det} NULLS FIRST LIMIT 3)"
            )
    return "\nUNION ALL ".join(parts)

PART_SUPPLIER = """
ps AS (
  SELECT x.l_partkey, x.l_suppkey, x.sum_qty, p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice,
         s.s_name, s.s_nationkey, s.s_acctbal
  FROM (SELECT l_partkey, l_suppkey, sum(l_quantity) AS sum_qty FROM lineitem GROUP BY l_partkey, l_suppkey) x
  JOIN part p ON p.p_partkey = x.l_partkey
  JOIN supplier s ON s.s_suppkey = x.l_suppkey
)"""
PS_OTHERS = ["sum_qty", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", "s_name", "s_nationkey", "s_acctbal"]

PARTIAL_DEPENDENCIES = f"WITH {PART_SUPPLIER}\n" + "\nUNION ALL ".join(
    f"SELECT '{k}' AS subset, '{y}' AS dependent WHERE {_holds('ps', k, y, nulls_ignored=True)}"
    for k in PK
    for y in PS_OTHERS
)

NORMALIZE_2NF_PART = f"""WITH {PART_SUPPLIER}
SELECT DISTINCT l_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM ps"""

NORMALIZE_2NF_SUPPLIER = f"""WITH {PART_SUPPLIER}
SELECT DISTINCT l_suppkey, s_name, s_nationkey, s_acctbal FROM ps"""

NORMALIZE_2NF_MAIN = f"""WITH {PART_SUPPLIER}
SELECT l_partkey, l_suppkey, sum_qty FROM ps"""


def _unique(table: str, combo: tuple[str, ...]) -> str:
    cols = ", ".join(combo)
    return f"(SELECT count(*) FROM (SELECT {cols} FROM {table} GROUP BY {cols} HAVING count(*) > 1) d) = 0"


def _candidate_keys_sql(table: str, cols: list[str], max_size: int | None = None) -> list[str]:
    parts = []
    for r in range(1, (max_size or len(cols)) + 1):
        for combo in combinations(sorted(cols), r):
            proper = [s for k in range(1, r) for s in combinations(combo, k)]
            cond = " AND ".join([_unique(table, combo)] + [f"NOT ({_unique(table, s)})" for s in proper])
            parts.append(
                f"SELECT '{table}' AS table_name, {r} AS key_size, '{','.join(combo)}' AS key_columns WHERE {cond}"
            )
    return parts


CANDIDATE_KEYS = "\nUNION ALL ".join(
    _candidate_keys_sql("nation", ["n_nationkey", "n_name", "n_regionkey"])
    + _candidate_keys_sql("conversations", ["conv_id", "turn", "role", "text"])
)

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
FD_MATRIX_LINEITEM = "\nUNION ALL ".join(
    f"SELECT '{x}' AS determinant, '{y}' AS dependent WHERE {_holds('lineitem', x, y)}" for x, y in permutations(LINEITEM_COLS, 2)
)
CANDIDATE_KEYS_ORDERS = "\nUNION ALL ".join(
    _candidate_keys_sql("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    + _candidate_keys_sql("lineitem", LINEITEM_COLS, 2)
)

ORACLE_SQL = {
    "fd_matrix_lineitem": FD_MATRIX_LINEITEM,
    "candidate_keys_orders": CANDIDATE_KEYS_ORDERS,
    "fd_single": FD_SINGLE,
    "fd_matrix": FD_MATRIX,
    "fd_declared_check": FD_DECLARED_CHECK,
    "fd_declared_violations": _violations_sql(),
    "partial_dependencies": PARTIAL_DEPENDENCIES,
    "normalize_2nf_part": NORMALIZE_2NF_PART,
    "normalize_2nf_supplier": NORMALIZE_2NF_SUPPLIER,
    "normalize_2nf_main": NORMALIZE_2NF_MAIN,
    "candidate_keys": CANDIDATE_KEYS,
}
