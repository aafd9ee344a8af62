"""DuckDB SQL twins of the registered queries (independent formulations used
as the correctness oracle; tables are the driver's pre-registered views).

Conventions shared with the Spark side: surrogate ids are BIGINT and equal the
rank of the row in (key, attributes) order, ascending with NULLs first; money
is summed exactly in DECIMAL and reported as DOUBLE; ratios are DECIMAL(18,6)
reported as DOUBLE.
"""

from __future__ import annotations

REV_RAW = """
SELECT
  CAST(year(l.l_shipdate) AS INTEGER) AS ANO_DOC,
  CAST(month(l.l_shipdate) AS INTEGER) AS MES_DOC,
  r.r_regionkey AS NIVEL_GOBIERNO, r.r_name AS NIVEL_GOBIERNO_NOMBRE,
  c.c_mktsegment AS SECTOR, lower(c.c_mktsegment) AS SECTOR_NOMBRE,
  n.n_nationkey AS PLIEGO, n.n_name AS PLIEGO_NOMBRE,
  s.s_suppkey AS SEC_EJEC, s.s_suppkey AS EJECUTORA, s.s_name AS EJECUTORA_NOMBRE,
  r.r_regionkey AS DEPARTAMENTO_EJECUTORA, r.r_name AS DEPARTAMENTO_EJECUTORA_NOMBRE,
  n.n_nationkey AS PROVINCIA_EJECUTORA, n.n_name AS PROVINCIA_EJECUTORA_NOMBRE,
  c.c_custkey % 10 AS DISTRITO_EJECUTORA,
  n.n_name || '-' || CAST(c.c_custkey % 10 AS VARCHAR) AS DISTRITO_EJECUTORA_NOMBRE,
  l.l_returnflag AS RUBRO, 'RUBRO ' || l.l_returnflag AS RUBRO_NOMBRE,
  l.l_linestatus AS TIPO_RECURSO, 'TIPO ' || l.l_linestatus AS TIPO_RECURSO_NOMBRE,
  o.o_orderstatus AS FUENTE_FINANCIAMIENTO, 'FUENTE ' || o.o_orderstatus AS FUENTE_FINANCIAMIENTO_NOMBRE,
  p.p_brand AS GENERICA, p.p_brand AS GENERICA_NOMBRE,
  p.p_type AS SUBGENERICA, lower(p.p_type) AS SUBGENERICA_NOMBRE,
  p.p_size AS SUBGENERICA_DET, 'SIZE ' || CAST(p.p_size AS VARCHAR) AS SUBGENERICA_DET_NOMBRE,
  o.o_orderpriority AS ESPECIFICA, o.o_orderpriority AS ESPECIFICA_NOMBRE,
  o.o_orderstatus AS ESPECIFICA_DET, 'STATUS ' || o.o_orderstatus AS ESPECIFICA_DET_NOMBRE,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS MONTO_PIA,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS MONTO_PIM,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2)))
       * (1 + CAST(l.l_tax AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS MONTO_RECAUDADO
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN part p ON p.p_partkey = l.l_partkey
"""


def _code_dim(code: str, id_col: str) -> str:
    """Code/name dimension ranked by (code, name); lookup = lowest id per 50-char code."""
    return f"""
d_{code} AS (
  SELECT CAST(row_number() OVER (ORDER BY k NULLS FIRST, nm NULLS FIRST) AS BIGINT) AS {id_col}, k, nm
  FROM (SELECT DISTINCT CAST({code} AS VARCHAR) AS k, CAST({code}_NOMBRE AS VARCHAR) AS nm
        FROM rev WHERE {code} IS NOT NULL) x
),
l_{code} AS (SELECT left(k, 50) AS k, min({id_col}) AS {id_col} FROM d_{code} GROUP BY left(k, 50))"""


_REV_DIMS = f"""
rev AS ({REV_RAW}),
d_tiempo AS (
  SELECT DISTINCT ANO_DOC * 100 + MES_DOC AS IdTiempo, ANO_DOC AS ANIO, MES_DOC AS MES
  FROM rev WHERE ANO_DOC IS NOT NULL AND MES_DOC IS NOT NULL
),
{_code_dim("NIVEL_GOBIERNO", "IdNivelGobierno")},
{_code_dim("SECTOR", "IdSector")},
{_code_dim("PLIEGO", "IdPliego")},
{_code_dim("RUBRO", "IdRubro")},
{_code_dim("TIPO_RECURSO", "IdTipoRecurso")},
d_EJECUTORA AS (
  SELECT CAST(row_number() OVER (ORDER BY k NULLS FIRST, e NULLS FIRST, nm NULLS FIRST) AS BIGINT) AS IdEjecutora, k, e, nm
  FROM (SELECT DISTINCT CAST(SEC_EJEC AS VARCHAR) AS k, CAST(EJECUTORA AS VARCHAR) AS e,
               CAST(EJECUTORA_NOMBRE AS VARCHAR) AS nm
        FROM rev WHERE SEC_EJEC IS NOT NULL) x
),
l_EJECUTORA AS (SELECT left(k, 50) AS k, min(IdEjecutora) AS IdEjecutora FROM d_EJECUTORA GROUP BY left(k, 50)),
d_UBIGEO AS (
  SELECT CAST(row_number() OVER (ORDER BY cd NULLS FIRST, cp NULLS FIRST, ci NULLS FIRST,
                                          dn NULLS FIRST, pn NULLS FIRST, di NULLS FIRST) AS BIGINT) AS IdUbigeo,
         cd, dn, cp, pn, ci, di
  FROM (SELECT DISTINCT TRY_CAST(DEPARTAMENTO_EJECUTORA AS INTEGER) AS cd, CAST(DEPARTAMENTO_EJECUTORA_NOMBRE AS VARCHAR) AS dn,
               TRY_CAST(PROVINCIA_EJECUTORA AS INTEGER) AS cp, CAST(PROVINCIA_EJECUTORA_NOMBRE AS VARCHAR) AS pn,
               TRY_CAST(DISTRITO_EJECUTORA AS INTEGER) AS ci, CAST(DISTRITO_EJECUTORA_NOMBRE AS VARCHAR) AS di
        FROM rev
        WHERE TRY_CAST(DEPARTAMENTO_EJECUTORA AS INTEGER) IS NOT NULL
          AND TRY_CAST(PROVINCIA_EJECUTORA AS INTEGER) IS NOT NULL
          AND TRY_CAST(DISTRITO_EJECUTORA AS INTEGER) IS NOT NULL) x
),
l_UBIGEO AS (SELECT cd, cp, ci, min(IdUbigeo) AS IdUbigeo FROM d_UBIGEO GROUP BY cd, cp, ci),
d_GENERICA AS (
  SELECT CAST(row_number() OVER (ORDER BY g NULLS FIRST, sg NULLS FIRST, sd NULLS FIRST,
                                          gn NULLS FIRST, sgn NULLS FIRST, sdn NULLS FIRST) AS BIGINT) AS IdGenerica,
         g, gn, sg, sgn, sd, sdn
  FROM (SELECT DISTINCT CAST(GENERICA AS VARCHAR) AS g, CAST(GENERICA_NOMBRE AS VARCHAR) AS gn,
               CAST(SUBGENERICA AS VARCHAR) AS sg, CAST(SUBGENERICA_NOMBRE AS VARCHAR) AS sgn,
               CAST(SUBGENERICA_DET AS VARCHAR) AS sd, CAST(SUBGENERICA_DET_NOMBRE AS VARCHAR) AS sdn
        FROM rev WHERE GENERICA IS NOT NULL) x
),
l_GENERICA AS (SELECT left(g, 50) AS g, left(sg, 50) AS sg, left(sd, 50) AS sd, min(IdGenerica) AS IdGenerica
               FROM d_GENERICA GROUP BY left(g, 50), left(sg, 50), left(sd, 50)),
d_ESPECIFICA AS (
  SELECT CAST(row_number() OVER (ORDER BY e NULLS FIRST, ed NULLS FIRST, en NULLS FIRST, edn NULLS FIRST) AS BIGINT) AS IdEspecifica,
         e, en, ed, edn
  FROM (SELECT DISTINCT CAST(ESPECIFICA AS VARCHAR) AS e, CAST(ESPECIFICA_NOMBRE AS VARCHAR) AS en,
               CAST(ESPECIFICA_DET AS VARCHAR) AS ed, CAST(ESPECIFICA_DET_NOMBRE AS VARCHAR) AS edn
        FROM rev WHERE ESPECIFICA IS NOT NULL) x
),
l_ESPECIFICA AS (SELECT left(e, 50) AS e, left(ed, 50) AS ed, min(IdEspecifica) AS IdEspecifica
                 FROM d_ESPECIFICA GROUP BY left(e, 50), left(ed, 50)),
fact AS (
  SELECT t.IdTiempo, ng.IdNivelGobierno, s.IdSector, p.IdPliego, e.IdEjecutora, u.IdUbigeo,
         r.IdRubro, tr.IdTipoRecurso, g.IdGenerica, esp.IdEspecifica,
         coalesce(TRY_CAST(b.MONTO_PIA AS DECIMAL(18,2)), 0) AS MONTO_PIA,
         coalesce(TRY_CAST(b.MONTO_PIM AS DECIMAL(18,2)), 0) AS MONTO_PIM,
         coalesce(TRY_CAST(b.MONTO_RECAUDADO AS DECIMAL(18,2)), 0) AS MONTO_RECAUDADO
  FROM rev b
  JOIN d_tiempo t ON t.IdTiempo = TRY_CAST(b.ANO_DOC AS INTEGER) * 100 + TRY_CAST(b.MES_DOC AS INTEGER)
  JOIN l_NIVEL_GOBIERNO ng ON ng.k = left(CAST(b.NIVEL_GOBIERNO AS VARCHAR), 50)
  JOIN l_SECTOR s ON s.k = left(CAST(b.SECTOR AS VARCHAR), 50)
  JOIN l_PLIEGO p ON p.k = left(CAST(b.PLIEGO AS VARCHAR), 50)
  JOIN l_EJECUTORA e ON e.k = left(CAST(b.SEC_EJEC AS VARCHAR), 50)
  JOIN l_UBIGEO u ON u.cd = TRY_CAST(b.DEPARTAMENTO_EJECUTORA AS INTEGER)
                 AND u.cp = TRY_CAST(b.PROVINCIA_EJECUTORA AS INTEGER)
                 AND u.ci = TRY_CAST(b.DISTRITO_EJECUTORA AS INTEGER)
  JOIN l_RUBRO r ON r.k = left(CAST(b.RUBRO AS VARCHAR), 50)
  JOIN l_TIPO_RECURSO tr ON tr.k = left(CAST(b.TIPO_RECURSO AS VARCHAR), 50)
  JOIN l_GENERICA g ON g.g = left(CAST(b.GENERICA AS VARCHAR), 50) AND g.sg = left(CAST(b.SUBGENERICA AS VARCHAR), 50)
                   AND g.sd = left(CAST(b.SUBGENERICA_DET AS VARCHAR), 50)
  JOIN l_ESPECIFICA esp ON esp.e = left(CAST(b.ESPECIFICA AS VARCHAR), 50) AND esp.ed = left(CAST(b.ESPECIFICA_DET AS VARCHAR), 50)
),
dash AS (
  SELECT t.ANIO, t.MES, ng.nm AS NIVEL_GOBIERNO, s.nm AS SECTOR, p.nm AS PLIEGO, e.nm AS EJECUTORA,
         u.dn AS DEPARTAMENTO, u.pn AS PROVINCIA, u.di AS DISTRITO, r.nm AS RUBRO, tr.nm AS TIPO_RECURSO,
         g.gn AS GENERICA, esp.en AS ESPECIFICA,
         sum(f.MONTO_PIA) AS MONTO_PIA, sum(f.MONTO_PIM) AS MONTO_PIM, sum(f.MONTO_RECAUDADO) AS MONTO_RECAUDADO
  FROM fact f
  JOIN d_tiempo t ON t.IdTiempo = f.IdTiempo
  JOIN d_NIVEL_GOBIERNO ng ON ng.IdNivelGobierno = f.IdNivelGobierno
  JOIN d_SECTOR s ON s.IdSector = f.IdSector
  JOIN d_PLIEGO p ON p.IdPliego = f.IdPliego
  JOIN d_EJECUTORA e ON e.IdEjecutora = f.IdEjecutora
  JOIN d_UBIGEO u ON u.IdUbigeo = f.IdUbigeo
  JOIN d_RUBRO r ON r.IdRubro = f.IdRubro
  JOIN d_TIPO_RECURSO tr ON tr.IdTipoRecurso = f.IdTipoRecurso
  JOIN d_GENERICA g ON g.IdGenerica = f.IdGenerica
  JOIN d_ESPECIFICA esp ON esp.IdEspecifica = f.IdEspecifica
  GROUP BY ALL
)"""


def _ratio(num: str, den: str) -> str:
    return (
        f"CAST(CASE WHEN {den} = 0 THEN 0 ELSE CAST(CAST({num} AS DECIMAL(38,6)) / "
        f"NULLIF(CAST({den} AS DECIMAL(38,6)), 0) AS DECIMAL(18,6)) END AS DOUBLE)"
    )


FACT_LOOKUP_STAR = f"""
WITH {_REV_DIMS}
SELECT IdTiempo, IdNivelGobierno, IdSector, IdPliego, IdEjecutora, IdUbigeo, IdRubro, IdTipoRecurso,
       IdGenerica, IdEspecifica,
       CAST(MONTO_PIA AS DOUBLE) AS MONTO_PIA, CAST(MONTO_PIM AS DOUBLE) AS MONTO_PIM,
       CAST(MONTO_RECAUDADO AS DOUBLE) AS MONTO_RECAUDADO
FROM fact
"""

GOLD_REVENUE_DASHBOARD = f"""
WITH {_REV_DIMS}
SELECT ANIO, MES, NIVEL_GOBIERNO, SECTOR, PLIEGO, EJECUTORA, DEPARTAMENTO, PROVINCIA, DISTRITO, RUBRO,
       TIPO_RECURSO, GENERICA, ESPECIFICA,
       CAST(MONTO_PIA AS DOUBLE) AS MONTO_PIA, CAST(MONTO_PIM AS DOUBLE) AS MONTO_PIM,
       CAST(MONTO_RECAUDADO AS DOUBLE) AS MONTO_RECAUDADO,
       CAST(MONTO_PIM - MONTO_PIA AS DOUBLE) AS VARIACION_PIM_PIA,
       CAST(MONTO_PIM - MONTO_RECAUDADO AS DOUBLE) AS SALDO_POR_RECAUDAR,
       {_ratio("MONTO_RECAUDADO", "MONTO_PIM")} AS PORC_AVANCE_RECAUDACION
FROM dash
"""

KPI_YEARLY = f"""
WITH {_REV_DIMS},
d2 AS (SELECT *, MONTO_PIM - MONTO_PIA AS VARIACION_PIM_PIA, MONTO_PIM - MONTO_RECAUDADO AS SALDO_POR_RECAUDAR FROM dash)
SELECT ANIO,
       CAST(sum(MONTO_PIA) AS DOUBLE) AS MONTO_PIA, CAST(sum(MONTO_PIM) AS DOUBLE) AS MONTO_PIM,
       CAST(sum(MONTO_RECAUDADO) AS DOUBLE) AS MONTO_RECAUDADO,
       CAST(sum(VARIACION_PIM_PIA) AS DOUBLE) AS VARIACION_PIM_PIA,
       CAST(sum(SALDO_POR_RECAUDAR) AS DOUBLE) AS SALDO_POR_RECAUDAR,
       {_ratio("sum(MONTO_RECAUDADO)", "sum(MONTO_PIM)")} AS PORC_AVANCE_RECAUDACION
FROM d2 GROUP BY ANIO
"""

KPI_BY_DEPARTMENT = f"""
WITH {_REV_DIMS}
SELECT ANIO, DEPARTAMENTO,
       CAST(sum(MONTO_RECAUDADO) AS DOUBLE) AS MONTO_RECAUDADO,
       CAST(sum(MONTO_PIM) AS DOUBLE) AS MONTO_PIM,
       CAST(sum(MONTO_PIM - MONTO_RECAUDADO) AS DOUBLE) AS SALDO_POR_RECAUDAR
FROM dash GROUP BY ANIO, DEPARTAMENTO
"""


# ---------------------------------------------------------------------------
# Dimensions

DIM_INCREMENTAL_LOAD = """
WITH src AS (
  SELECT o.o_orderdate, CAST(o.o_custkey AS VARCHAR) AS CLIENTE, CAST(c.c_name AS VARCHAR) AS CLIENTE_NOMBRE,
         CAST(c.c_mktsegment AS VARCHAR) AS SEGMENTO
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
),
b1 AS (SELECT DISTINCT CLIENTE, CLIENTE_NOMBRE, SEGMENTO FROM src
       WHERE o_orderdate < TIMESTAMP '1998-01-01' AND CLIENTE IS NOT NULL),
d1 AS (SELECT CAST(row_number() OVER (ORDER BY CLIENTE, CLIENTE_NOMBRE, SEGMENTO) AS BIGINT) AS IdCliente, * FROM b1),
b2 AS (SELECT DISTINCT CLIENTE, CLIENTE_NOMBRE, SEGMENTO FROM src s
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND CLIENTE IS NOT NULL
         AND NOT EXISTS (SELECT 1 FROM d1 WHERE d1.CLIENTE = s.CLIENTE)),
d2 AS (SELECT CAST((SELECT coalesce(max(IdCliente), 0) FROM d1)
                   + row_number() OVER (ORDER BY CLIENTE, CLIENTE_NOMBRE, SEGMENTO) AS BIGINT) AS IdCliente, * FROM b2)
SELECT IdCliente, CLIENTE, CLIENTE_NOMBRE, SEGMENTO FROM d1
UNION ALL
SELECT IdCliente, CLIENTE, CLIENTE_NOMBRE, SEGMENTO FROM d2
"""

DIM_MULTI_SOURCE_FIRST_WINS = """
WITH a AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS SEC_EJEC, CAST(s_suppkey AS VARCHAR) AS EJECUTORA,
                           CAST(s_name AS VARCHAR) AS EJECUTORA_NOMBRE
           FROM supplier WHERE s_suppkey IS NOT NULL),
da AS (SELECT CAST(row_number() OVER (ORDER BY SEC_EJEC, EJECUTORA, EJECUTORA_NOMBRE) AS BIGINT) AS IdEjecutora, * FROM a),
b AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS SEC_EJEC, CAST(c_custkey AS VARCHAR) AS EJECUTORA,
                      CAST(c_name AS VARCHAR) AS EJECUTORA_NOMBRE
      FROM customer c
      WHERE c_custkey IS NOT NULL AND c_name IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM da WHERE da.SEC_EJEC = CAST(c.c_custkey AS VARCHAR))),
db AS (SELECT CAST((SELECT max(IdEjecutora) FROM da)
                   + row_number() OVER (ORDER BY SEC_EJEC, EJECUTORA, EJECUTORA_NOMBRE) AS BIGINT) AS IdEjecutora, * FROM b),
dab AS (SELECT * FROM da UNION ALL SELECT * FROM db),
c AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS SEC_EJEC, CAST(o_orderkey AS VARCHAR) AS EJECUTORA,
                      CAST(o_orderkey AS VARCHAR) AS EJECUTORA_NOMBRE
      FROM orders o
      WHERE o_orderkey IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM dab WHERE dab.SEC_EJEC = CAST(o.o_orderkey AS VARCHAR))),
dc AS (SELECT CAST((SELECT max(IdEjecutora) FROM dab)
                   + row_number() OVER (ORDER BY SEC_EJEC, EJECUTORA, EJECUTORA_NOMBRE) AS BIGINT) AS IdEjecutora, * FROM c)
SELECT IdEjecutora, SEC_EJEC, EJECUTORA, EJECUTORA_NOMBRE FROM dab
UNION ALL
SELECT IdEjecutora, SEC_EJEC, EJECUTORA, EJECUTORA_NOMBRE FROM dc
"""

_YEAR_MEMBERS = """
SELECT DISTINCT y AS IdTiempo, y AS ANIO, CAST(NULL AS INTEGER) AS MES, CAST(NULL AS INTEGER) AS DIA,
       CAST(NULL AS INTEGER) AS HORA, CAST(NULL AS INTEGER) AS MINUTO, CAST(NULL AS INTEGER) AS SEGUNDO
FROM (SELECT unnest([CAST(year(o_orderdate) AS INTEGER), CAST(year(o_orderdate) AS INTEGER) - 1,
                     CAST(year(o_orderdate) AS INTEGER) + 1]) AS y FROM orders) v
WHERE y IS NOT NULL
"""

DIM_UNKNOWN_MEMBER = f"""
WITH years AS ({_YEAR_MEMBERS})
SELECT * FROM years
UNION ALL
SELECT * FROM (VALUES (0, 0, NULL, NULL, NULL, NULL, NULL), (2020, 2020, NULL, NULL, NULL, NULL, NULL))
         m(IdTiempo, ANIO, MES, DIA, HORA, MINUTO, SEGUNDO)
WHERE m.IdTiempo NOT IN (SELECT IdTiempo FROM years)
"""

DIM_DATE_MIXED_GRAIN = f"""
WITH months AS (
  SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) * 100 + CAST(month(l_shipdate) AS INTEGER) AS IdTiempo,
         CAST(year(l_shipdate) AS INTEGER) AS ANIO, CAST(month(l_shipdate) AS INTEGER) AS MES,
         CAST(NULL AS INTEGER) AS DIA, CAST(NULL AS INTEGER) AS HORA, CAST(NULL AS INTEGER) AS MINUTO,
         CAST(NULL AS INTEGER) AS SEGUNDO
  FROM lineitem WHERE l_shipdate IS NOT NULL
),
m0 AS (SELECT * FROM months
       UNION ALL SELECT 0, 0, NULL, NULL, NULL, NULL, NULL WHERE 0 NOT IN (SELECT IdTiempo FROM months)),
y AS (SELECT * FROM ({_YEAR_MEMBERS}) x WHERE IdTiempo NOT IN (SELECT IdTiempo FROM m0)),
my AS (SELECT * FROM m0 UNION ALL SELECT * FROM y)
SELECT * FROM my
UNION ALL SELECT 2020, 2020, NULL, NULL, NULL, NULL, NULL WHERE 2020 NOT IN (SELECT IdTiempo FROM my)
"""

DIM_LOOKUP_DEDUPE = """
WITH d AS (
  SELECT CAST(row_number() OVER (ORDER BY GENERICA, SUBGENERICA, GENERICA_NOMBRE) AS BIGINT) AS IdGenerica, *
  FROM (SELECT DISTINCT CAST(p_brand AS VARCHAR) AS GENERICA, CAST(p_type AS VARCHAR) AS SUBGENERICA,
                        CAST(p_name AS VARCHAR) AS GENERICA_NOMBRE
        FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL) x
)
SELECT IdGenerica, GENERICA, SUBGENERICA FROM (
  SELECT IdGenerica, left(GENERICA, 50) AS GENERICA, left(SUBGENERICA, 50) AS SUBGENERICA,
         row_number() OVER (PARTITION BY left(GENERICA, 50), left(SUBGENERICA, 50) ORDER BY IdGenerica) AS rn
  FROM d) z
WHERE rn = 1
"""

# ---------------------------------------------------------------------------
# Forms

_FORMS = """
anio AS (SELECT CAST(2000 + turn AS VARCHAR) AS ANO_APLICACION, CAST(2000 + turn AS VARCHAR) AS INICIO,
                CAST(2001 + turn AS VARCHAR) AS FIN FROM conversations),
d_anio AS (
  SELECT CAST(row_number() OVER (ORDER BY a, i, f) AS BIGINT) AS IdAnioAplicacion, a AS ANO_APLICACION
  FROM (SELECT DISTINCT coalesce(TRY_CAST(ANO_APLICACION AS INTEGER), 0) AS a, coalesce(TRY_CAST(INICIO AS INTEGER), 0) AS i,
                        coalesce(TRY_CAST(FIN AS INTEGER), 0) AS f
        FROM anio WHERE TRY_CAST(ANO_APLICACION AS INTEGER) IS NOT NULL) x
),
d_form AS (
  SELECT CAST(row_number() OVER (ORDER BY FORMULARIO_ID, TITULO, SUBTITULO, ABREVIATURA, CLASIFICACION, TIPO_FORMULARIO) AS BIGINT)
           AS IdFormSismepre, *
  FROM (SELECT DISTINCT CAST(conv_id AS VARCHAR) AS FORMULARIO_ID, 'Form ' || CAST(conv_id AS VARCHAR) AS TITULO,
                        'Sub ' || CAST(conv_id % 7 AS VARCHAR) AS SUBTITULO, 'F' || CAST(conv_id AS VARCHAR) AS ABREVIATURA,
                        CASE WHEN conv_id % 2 = 0 THEN 'PAR' ELSE 'IMPAR' END AS CLASIFICACION, 'CONV' AS TIPO_FORMULARIO
        FROM conversations WHERE conv_id IS NOT NULL) x
),
d_preg AS (
  SELECT CAST(row_number() OVER (ORDER BY PREGUNTA_ID, IdFormSismepre, PREGUNTA_PADRE_ID, DESCRIPCION, TIPO_CUESTIONARIO_ID) AS BIGINT)
           AS IdPreguntaSismepre, *
  FROM (SELECT DISTINCT f.IdFormSismepre, CAST(c.turn AS VARCHAR) AS PREGUNTA_ID,
                        CAST(coalesce(CASE WHEN c.turn = 0 THEN NULL ELSE c.turn - 1 END, 0) AS VARCHAR) AS PREGUNTA_PADRE_ID,
                        CAST(c.role AS VARCHAR) AS DESCRIPCION, CAST(c.role AS VARCHAR) AS TIPO_CUESTIONARIO_ID
        FROM conversations c JOIN d_form f ON f.FORMULARIO_ID = CAST(c.conv_id AS VARCHAR)
        WHERE c.turn IS NOT NULL) x
),
d_ejec AS (
  SELECT CAST(row_number() OVER (ORDER BY SEC_EJEC) AS BIGINT) AS IdEjecutora, SEC_EJEC, SEC_EJEC AS EJECUTORA, SEC_EJEC AS EJECUTORA_NOMBRE
  FROM (SELECT DISTINCT CAST(role AS VARCHAR) AS SEC_EJEC FROM conversations WHERE role IS NOT NULL) x
),
fact AS (
  SELECT e.IdEjecutora, aa.IdAnioAplicacion, 'P' || CAST(r.turn AS VARCHAR) AS PERIODO, f.IdFormulario, p.IdPregunta,
         CAST(r.conv_id * 1000 + r.turn AS VARCHAR) AS RESPUESTA_ID, CAST(r.text AS VARCHAR) AS RESPUESTA_TEXTO,
         CAST(length(r.text) AS VARCHAR) AS RESPUESTA_DECIMAL, CAST(r.turn AS VARCHAR) AS RESPUESTA_ENTERO,
         CAST(NULL AS VARCHAR) AS RESPUESTA_FECHA
  FROM conversations r
  JOIN (SELECT left(SEC_EJEC, 50) AS k, min(IdEjecutora) AS IdEjecutora FROM d_ejec GROUP BY 1) e
    ON e.k = left(CAST(r.role AS VARCHAR), 50)
  JOIN (SELECT ANO_APLICACION, min(IdAnioAplicacion) AS IdAnioAplicacion FROM d_anio GROUP BY 1) aa
    ON aa.ANO_APLICACION = TRY_CAST(CAST(2000 + r.turn AS VARCHAR) AS INTEGER)
  JOIN (SELECT left(FORMULARIO_ID, 50) AS k, min(IdFormSismepre) AS IdFormulario FROM d_form GROUP BY 1) f
    ON f.k = left(CAST(r.conv_id AS VARCHAR), 50)
  JOIN (SELECT IdFormSismepre, left(PREGUNTA_ID, 50) AS k, min(IdPreguntaSismepre) AS IdPregunta FROM d_preg GROUP BY 1, 2) p
    ON p.IdFormSismepre = f.IdFormulario AND p.k = left(CAST(r.turn AS VARCHAR), 50)
)"""

FACT_DEPENDENT_LOOKUP = f"""
WITH {_FORMS}
SELECT * FROM fact
"""

GOLD_FORMS_DASHBOARD = f"""
WITH {_FORMS}
SELECT aa.ANO_APLICACION, f.PERIODO, e.SEC_EJEC, e.EJECUTORA_NOMBRE, fm.FORMULARIO_ID, fm.TITULO AS TITULO_FORMULARIO,
       fm.CLASIFICACION, fm.TIPO_FORMULARIO, p.PREGUNTA_ID, p.DESCRIPCION, f.RESPUESTA_ID, f.RESPUESTA_TEXTO,
       f.RESPUESTA_DECIMAL, f.RESPUESTA_ENTERO, f.RESPUESTA_FECHA
FROM fact f
JOIN d_ejec e ON e.IdEjecutora = f.IdEjecutora
JOIN d_anio aa ON aa.IdAnioAplicacion = f.IdAnioAplicacion
JOIN d_form fm ON fm.IdFormSismepre = f.IdFormulario
JOIN d_preg p ON p.IdPreguntaSismepre = f.IdPregunta
"""

# ---------------------------------------------------------------------------
# Survey

_SURVEY = """
sv AS (
  SELECT c.c_custkey AS idmunici, lpad(CAST(n.n_regionkey AS VARCHAR), 2, '0') AS ccdd,
         lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS ccpp, lpad(CAST(c.c_custkey % 10 AS VARCHAR), 2, '0') AS ccdi,
         r.r_name AS Departamento, n.n_name AS Provincia, n.n_name || '-' || CAST(c.c_custkey % 10 AS VARCHAR) AS Distrito,
         CAST(c.c_custkey % 3 AS VARCHAR) AS Tipomuni, '1' AS VFI, c.c_mktsegment AS P01_SEGMENTO,
         CAST(CAST(floor(c.c_acctbal / 1000) AS BIGINT) AS VARCHAR) AS P02_SALDO,
         nullif(c.c_mktsegment, 'BUILDING') AS P03_OTRO
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
),
d_ub AS (
  SELECT CAST(row_number() OVER (ORDER BY cd, cp, ci, dn, pn, di) AS BIGINT) AS IdUbigeo, *
  FROM (SELECT DISTINCT TRY_CAST(ccdd AS INTEGER) AS cd, CAST(Departamento AS VARCHAR) AS dn,
                        TRY_CAST(ccpp AS INTEGER) AS cp, CAST(Provincia AS VARCHAR) AS pn,
                        TRY_CAST(ccdi AS INTEGER) AS ci, CAST(Distrito AS VARCHAR) AS di
        FROM sv WHERE TRY_CAST(ccdd AS INTEGER) IS NOT NULL AND TRY_CAST(ccpp AS INTEGER) IS NOT NULL
                  AND TRY_CAST(ccdi AS INTEGER) IS NOT NULL) x
),
lng AS (
  SELECT ccdd, ccpp, ccdi, Tipomuni, 'Provincia' AS NOMBRE_CAMPO, CAST(Provincia AS VARCHAR) AS VALOR FROM sv
  UNION ALL SELECT ccdd, ccpp, ccdi, Tipomuni, 'VFI', CAST(VFI AS VARCHAR) FROM sv
  UNION ALL SELECT ccdd, ccpp, ccdi, Tipomuni, 'P01_SEGMENTO', CAST(P01_SEGMENTO AS VARCHAR) FROM sv
  UNION ALL SELECT ccdd, ccpp, ccdi, Tipomuni, 'P02_SALDO', CAST(P02_SALDO AS VARCHAR) FROM sv
  UNION ALL SELECT ccdd, ccpp, ccdi, Tipomuni, 'P03_OTRO', CAST(P03_OTRO AS VARCHAR) FROM sv
),
d_q AS (
  SELECT CAST(row_number() OVER (ORDER BY NOMBRE_CAMPO, VALOR, METADATA) AS BIGINT) AS IdPregunta, *
  FROM (SELECT DISTINCT CAST(NULL AS INTEGER) AS IdPadre, NOMBRE_CAMPO, NOMBRE_CAMPO AS DESCRIPCION,
                        coalesce(VALOR, '') AS VALOR, 'RENAMU_2020' AS METADATA
        FROM lng WHERE NOMBRE_CAMPO IS NOT NULL) x
),
fact AS (
  SELECT 2020 AS IdTiempo, u.IdUbigeo, coalesce(TRY_CAST(l.Tipomuni AS INTEGER), 0) AS TIPOMUNI, q.IdPregunta
  FROM lng l
  JOIN d_ub u ON u.cd = TRY_CAST(l.ccdd AS INTEGER) AND u.cp = TRY_CAST(l.ccpp AS INTEGER) AND u.ci = TRY_CAST(l.ccdi AS INTEGER)
  JOIN d_q q ON q.NOMBRE_CAMPO = l.NOMBRE_CAMPO AND q.VALOR = coalesce(l.VALOR, '') AND q.METADATA = 'RENAMU_2020'
)"""

FACT_SURVEY = f"""
WITH {_SURVEY}
SELECT * FROM fact
"""

GOLD_SURVEY_DASHBOARD = f"""
WITH {_SURVEY}
SELECT 2020 AS ANIO, u.dn AS DEPARTAMENTO, u.pn AS PROVINCIA, u.di AS DISTRITO, f.TIPOMUNI,
       q.NOMBRE_CAMPO, q.DESCRIPCION, q.VALOR, q.METADATA
FROM fact f JOIN d_ub u ON u.IdUbigeo = f.IdUbigeo JOIN d_q q ON q.IdPregunta = f.IdPregunta
"""

UNPIVOT_WIDE_TO_LONG = """
SELECT p_partkey, 'p_name' AS NOMBRE_CAMPO, CAST(p_name AS VARCHAR) AS VALOR FROM part
UNION ALL SELECT p_partkey, 'p_brand', CAST(p_brand AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'p_type', CAST(p_type AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part
"""

# ---------------------------------------------------------------------------
# Integrity

INTEGRITY_VIOLATIONS = """
SELECT 'not_null' AS check_type, 'l_orderkey' AS check_name,
       CAST(count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS n_violations FROM lineitem
UNION ALL SELECT 'not_null', 'l_partkey', CAST(count(*) FILTER (WHERE l_partkey IS NULL) AS BIGINT) FROM lineitem
UNION ALL SELECT 'not_null', 'l_suppkey', CAST(count(*) FILTER (WHERE l_suppkey IS NULL) AS BIGINT) FROM lineitem
UNION ALL SELECT 'not_null', 'l_shipdate', CAST(count(*) FILTER (WHERE l_shipdate IS NULL) AS BIGINT) FROM lineitem
UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber', CAST(count(*) AS BIGINT)
          FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) d
UNION ALL SELECT 'foreign_key', 'l_orderkey->orders', CAST(count(*) AS BIGINT)
          FROM lineitem l WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'foreign_key', 'l_orderkey->customer', CAST(count(*) AS BIGINT)
          FROM lineitem l WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = l.l_orderkey)
UNION ALL SELECT 'foreign_key', 'l_partkey->part', CAST(count(*) AS BIGINT)
          FROM lineitem l WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'foreign_key', 'l_suppkey->supplier', CAST(count(*) AS BIGINT)
          FROM lineitem l WHERE l.l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
"""
