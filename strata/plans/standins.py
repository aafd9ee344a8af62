"""Bronze-shaped frames derived from the driver's TPC-H-like tables.

Each builder maps real driver columns onto the column names the surveyed
workload reads (budget rows, forms/answers, a wide municipal survey), so the
warehouse operators run on data whose size grows with the driver tables.
The SQL twins used by the oracle live in ``strata.plans.oracle``.

Join strategies are left to the planner: its file-size statistics broadcast
the small sides (nation, region, and at small scale factors part, supplier,
orders) and AQE re-plans at run time; at large scale the same joins are
shuffled. The widest input (lineitem) is spread over the cores when its scan
has fewer splits than cores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import read_table


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


# Amounts: factors cast to DECIMAL first, multiplied exactly, rounded once per row.
PIA_EXPR = _money("CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))")
PIM_EXPR = _money("CAST(l_extendedprice AS DECIMAL(18,2))")
REC_EXPR = _money(
    "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"
    " * (1 + CAST(l_tax AS DECIMAL(18,2)))"
)


def revenue_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One budget row per lineitem with the ``ingreso_raw`` columns."""
    li = _t(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "year(l_shipdate) AS ANO_DOC", "month(l_shipdate) AS MES_DOC",
    )
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customer = _t(spark, sf_dir, "customer").selectExpr("c_custkey", "c_custkey % 10 AS c_district", "c_nationkey", "c_mktsegment")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")

    # join strategies are left to the planner: file-size statistics and AQE
    # broadcast the small sides at small scale factors and shuffle them at large.
    # Customers meet the orders, not the lines, which are several times as many: a
    # line is shuffled once for its order and at most once for each large table of
    # its own keys. nation/region are joined last: without cost-based statistics a
    # pre-joined side is estimated at the product of its inputs.
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = (
        li.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return rows.selectExpr(
        "ANO_DOC",
        "MES_DOC",
        "r_regionkey AS NIVEL_GOBIERNO",
        "r_name AS NIVEL_GOBIERNO_NOMBRE",
        "c_mktsegment AS SECTOR",
        "lower(c_mktsegment) AS SECTOR_NOMBRE",
        "n_nationkey AS PLIEGO",
        "n_name AS PLIEGO_NOMBRE",
        "s_suppkey AS SEC_EJEC",
        "s_suppkey AS EJECUTORA",
        "s_name AS EJECUTORA_NOMBRE",
        "r_regionkey AS DEPARTAMENTO_EJECUTORA",
        "r_name AS DEPARTAMENTO_EJECUTORA_NOMBRE",
        "n_nationkey AS PROVINCIA_EJECUTORA",
        "n_name AS PROVINCIA_EJECUTORA_NOMBRE",
        "c_district AS DISTRITO_EJECUTORA",
        "concat(n_name, '-', CAST(c_district AS STRING)) AS DISTRITO_EJECUTORA_NOMBRE",
        "l_returnflag AS RUBRO",
        "concat('RUBRO ', l_returnflag) AS RUBRO_NOMBRE",
        "l_linestatus AS TIPO_RECURSO",
        "concat('TIPO ', l_linestatus) AS TIPO_RECURSO_NOMBRE",
        "o_orderstatus AS FUENTE_FINANCIAMIENTO",
        "concat('FUENTE ', o_orderstatus) AS FUENTE_FINANCIAMIENTO_NOMBRE",
        "p_brand AS GENERICA",
        "p_brand AS GENERICA_NOMBRE",
        "p_type AS SUBGENERICA",
        "lower(p_type) AS SUBGENERICA_NOMBRE",
        "p_size AS SUBGENERICA_DET",
        "concat('SIZE ', CAST(p_size AS STRING)) AS SUBGENERICA_DET_NOMBRE",
        "o_orderpriority AS ESPECIFICA",
        "o_orderpriority AS ESPECIFICA_NOMBRE",
        "o_orderstatus AS ESPECIFICA_DET",
        "concat('STATUS ', o_orderstatus) AS ESPECIFICA_DET_NOMBRE",
        f"{PIA_EXPR} AS MONTO_PIA",
        f"{PIM_EXPR} AS MONTO_PIM",
        f"{REC_EXPR} AS MONTO_RECAUDADO",
    )


# ---------------------------------------------------------------------------
# Forms source (from conversations: conversation = form, turn = question)


def forms_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``anio``, ``formulario``, ``preguntas``, ``respuestas`` bronze frames."""
    conv = _t(spark, sf_dir, "conversations")
    return {
        "anio": conv.selectExpr(
            "CAST(2000 + turn AS STRING) AS ANO_APLICACION",
            "CAST(2000 + turn AS STRING) AS ANO_APLICACION_INICIO",
            "CAST(2001 + turn AS STRING) AS ANO_APLICACION_FIN",
        ),
        "formulario": conv.selectExpr(
            "conv_id AS FORMULARIO_ID",
            "concat('Form ', CAST(conv_id AS STRING)) AS TITULO",
            "concat('Sub ', CAST(conv_id % 7 AS STRING)) AS SUB_TITULO",
            "concat('F', CAST(conv_id AS STRING)) AS ABREVIATURA",
            "CASE WHEN conv_id % 2 = 0 THEN 'PAR' ELSE 'IMPAR' END AS CLASIFICACION",
            "'CONV' AS TIPO_FORMULARIO",
        ),
        "preguntas": conv.selectExpr(
            "turn AS PREGUNTA_ID",
            "conv_id AS FORMULARIO_ID",
            "CASE WHEN turn = 0 THEN NULL ELSE turn - 1 END AS PREGUNTA_PADRE_ID",
            "role AS DESCRIPCION",
            "role AS TIPO_CUESTIONARIO_ID",
        ),
        "respuestas": conv.selectExpr(
            "role AS SEC_EJEC",
            "CAST(2000 + turn AS STRING) AS ANO_APLICACION",
            "concat('P', CAST(turn AS STRING)) AS PERIODO",
            "conv_id AS FORMULARIO_ID",
            "turn AS PREGUNTA_ID",
            "conv_id * 1000 + turn AS RESPUESTA_ID",
            "text AS RESPUESTA_TEXTO",
            "CAST(length(text) AS STRING) AS RESPUESTA_DECIMAL",
            "CAST(turn AS STRING) AS RESPUESTA_ENTERO",
            "CAST(NULL AS STRING) AS RESPUESTA_FECHA",
        ),
    }


def esat_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipal statistics rows (executing unit + location) from customers."""
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.selectExpr(
        "c_custkey AS SEC_EJEC",
        "c_name AS MUNICIPALIDAD_NOMBRE",
        "CAST(n_regionkey AS STRING) AS DEPARTAMENTO",
        "r_name AS DEPARTAMENTO_NOMBRE",
        "CAST(c_nationkey AS STRING) AS PROVINCIA",
        "n_name AS PROVINCIA_NOMBRE",
        "CAST(c_custkey % 10 AS STRING) AS DISTRITO",
        "concat(n_name, '-', CAST(c_custkey % 10 AS STRING)) AS DISTRITO_NOMBRE",
    )


# ---------------------------------------------------------------------------
# Wide municipal survey (one row per customer)


def survey_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.selectExpr(
        "c_custkey AS idmunici",
        "lpad(CAST(n_regionkey AS STRING), 2, '0') AS ccdd",
        "lpad(CAST(c_nationkey AS STRING), 2, '0') AS ccpp",
        "lpad(CAST(c_custkey % 10 AS STRING), 2, '0') AS ccdi",
        "r_name AS Departamento",
        "n_name AS Provincia",
        "concat(n_name, '-', CAST(c_custkey % 10 AS STRING)) AS Distrito",
        "CAST(c_custkey % 3 AS STRING) AS Tipomuni",
        "'1' AS VFI",
        "c_mktsegment AS P01_SEGMENTO",
        "CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS STRING) AS P02_SALDO",
        "nullif(c_mktsegment, 'BUILDING') AS P03_OTRO",
    )
