"""DuckDB twins of ``strata.plans.ingest_queries``."""

from __future__ import annotations

from strata.plans.ingest_queries import DRIVER_TABLES


def _profile_sql(table: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for name, cat in columns:
        if cat == "integer":
            stats = f"CAST(min({name}) AS BIGINT) AS mn, CAST(max({name}) AS BIGINT) AS mx, CAST(NULL AS BIGINT) AS ml"
        elif cat == "string":
            stats = f"CAST(NULL AS BIGINT) AS mn, CAST(NULL AS BIGINT) AS mx, CAST(max(length({name})) AS BIGINT) AS ml"
        else:
            stats = "CAST(NULL AS BIGINT) AS mn, CAST(NULL AS BIGINT) AS mx, CAST(NULL AS BIGINT) AS ml"
            parts.append(f"SELECT '{name}' AS column_name, '{cat}' AS category, {stats}")
            continue
        parts.append(f"SELECT '{name}' AS column_name, '{cat}' AS category, {stats} FROM {table}")
    union = "\nUNION ALL ".join(parts)
    return f"""
WITH p AS ({union})
SELECT column_name, category, mn AS min_value, mx AS max_value, ml AS max_len,
  CASE category
    WHEN 'integer' THEN CASE WHEN (mn IS NULL OR mn >= -32768) AND (mx IS NULL OR mx < 32767) THEN 'SMALLINT'
                             WHEN mn >= -2147483648 AND mx < 2147483647 THEN 'INT' ELSE 'BIGINT' END
    WHEN 'float' THEN 'NUMERIC'
    WHEN 'date' THEN 'DATE'
    WHEN 'datetime' THEN 'DATETIME'
    WHEN 'string' THEN 'NVARCHAR(' || CAST(CASE WHEN ml IS NULL OR ml = 0 THEN 100
                                                ELSE CAST(ceil(ml / 100) * 100 AS BIGINT) END AS VARCHAR) || ')'
    ELSE 'NVARCHAR(MAX)' END AS suggested
FROM p
"""


SCHEMA_PROFILE = _profile_sql(
    "lineitem",
    [
        ("l_orderkey", "integer"), ("l_partkey", "integer"), ("l_suppkey", "integer"), ("l_linenumber", "integer"),
        ("l_quantity", "float"), ("l_extendedprice", "float"), ("l_discount", "float"), ("l_tax", "float"),
        ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "datetime"),
    ],
)

SCHEMA_PROFILE_PART = _profile_sql(
    "part",
    [
        ("p_partkey", "integer"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
        ("p_size", "integer"), ("p_retailprice", "float"),
    ],
)

SCHEMA_RECONCILE_ALIGN = """
SELECT c_custkey AS id, c_name AS name, CAST(CAST(c_nationkey AS SMALLINT) AS VARCHAR) AS nation,
       c_acctbal AS acctbal, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS source
FROM customer
UNION ALL
SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR), s_acctbal, CAST(NULL AS VARCHAR), 'supplier'
FROM supplier
"""

MULTI_VINTAGE_APPEND = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DECIMAL(18,4)) AS amount, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS approximate,
       CAST(NULL AS VARCHAR) AS o_orderpriority, CAST(NULL AS TIMESTAMP) AS o_orderdate
FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(NULL AS DOUBLE), CAST(o_totalprice AS DECIMAL(18,4)), o_totalprice / 3,
       o_orderpriority, CAST(NULL AS TIMESTAMP)
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
UNION ALL
SELECT o_orderkey, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE), NULL, NULL,
       o_orderpriority, o_orderdate
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01' OR o_orderdate IS NULL
"""

TIMESTAMP_SANITISE = r"""
SELECT event_id,
       CASE WHEN event_type = 'error' THEN CAST(NULL AS TIMESTAMP)
            ELSE try_strptime(regexp_replace(CAST(ts AS VARCHAR), '\.\d+$', ''), '%Y-%m-%d %H:%M:%S') END AS FECHA_EVENTO,
       value AS fecha_valor
FROM events
"""

TRY_CONVERT_DEFAULTS = r"""
SELECT event_id,
       TRY_CAST(regexp_extract(props, '"k":\s*(-?[0-9]+)', 1) AS INTEGER) AS k_value,
       coalesce(TRY_CAST(event_type AS INTEGER), 0) AS event_type_code,
       CAST(coalesce(TRY_CAST(value AS DECIMAL(18,2)), 0) AS DOUBLE) AS amount,
       CAST(coalesce(TRY_CAST(event_type AS DECIMAL(18,2)), 0) AS DOUBLE) AS type_amount
FROM events
"""

MODULE_MERGE_FULL_JOIN = """
WITH m1 AS (
  SELECT ltrim(lpad(CAST(n_nationkey AS VARCHAR), 3, '0'), '0') AS ccdd, n_name FROM nation
),
m1f AS (SELECT * FROM m1 WHERE NOT (trim(ccdd) = '')),
m2 AS (
  SELECT ltrim(lpad(CAST(s_nationkey AS VARCHAR), 2, '0'), '0') AS ccdd,
         ltrim(lpad(CAST(s_suppkey AS VARCHAR), 4, '0'), '0') AS idmunici, s_name AS name, s_acctbal
  FROM supplier
),
m2f AS (SELECT * FROM m2 WHERE NOT (trim(ccdd) = '' AND trim(idmunici) = '')),
m3 AS (
  SELECT ltrim(CAST(c_nationkey AS VARCHAR), '0') AS ccdd, c_custkey, c_name AS name_m3, c_mktsegment FROM customer
),
m3f AS (
  SELECT ccdd, c_custkey, name_m3, c_mktsegment FROM (
    SELECT *, row_number() OVER (PARTITION BY ccdd ORDER BY c_custkey, name_m3, c_mktsegment) AS rn
    FROM m3 WHERE NOT (trim(ccdd) = '')) x
  WHERE rn = 1
),
j1 AS (
  SELECT coalesce(m1f.ccdd, m2f.ccdd) AS ccdd, m1f.n_name, m2f.idmunici, m2f.name, m2f.s_acctbal
  FROM m1f FULL JOIN m2f ON m1f.ccdd = m2f.ccdd
)
SELECT coalesce(j1.ccdd, m3f.ccdd) AS ccdd, j1.n_name, j1.idmunici, j1.name, j1.s_acctbal,
       m3f.c_custkey, m3f.name_m3, m3f.c_mktsegment
FROM j1 FULL JOIN m3f ON j1.ccdd = m3f.ccdd
"""

MODULE_MERGE_SAME_KEYS = """
WITH c AS (
  SELECT ltrim(lpad(CAST(c_custkey AS VARCHAR), 6, '0'), '0') AS idmunici, c_name, c_mktsegment FROM customer
),
cf AS (SELECT * FROM c WHERE NOT (trim(idmunici) = '')),
o AS (
  SELECT idmunici, o_orderkey, o_totalprice FROM (
    SELECT ltrim(CAST(o_custkey AS VARCHAR), '0') AS idmunici, o_orderkey, o_totalprice,
           row_number() OVER (PARTITION BY ltrim(CAST(o_custkey AS VARCHAR), '0') ORDER BY o_orderkey, o_totalprice) AS rn
    FROM orders WHERE NOT (trim(ltrim(CAST(o_custkey AS VARCHAR), '0')) = '')) x
  WHERE rn = 1
),
s AS (
  SELECT ltrim(CAST(s_suppkey AS VARCHAR), '0') AS idmunici, s_name FROM supplier
  WHERE NOT (trim(ltrim(CAST(s_suppkey AS VARCHAR), '0')) = '')
),
j1 AS (
  SELECT coalesce(cf.idmunici, o.idmunici) AS idmunici, cf.c_name, cf.c_mktsegment, o.o_orderkey, o.o_totalprice
  FROM cf FULL JOIN o ON cf.idmunici = o.idmunici
)
SELECT coalesce(j1.idmunici, s.idmunici) AS idmunici, j1.c_name, j1.c_mktsegment, j1.o_orderkey, j1.o_totalprice, s.s_name
FROM j1 FULL JOIN s ON j1.idmunici = s.idmunici
"""

MODULE_SPLIT_PRICE = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
"""

MODULE_SPLIT_FLAGS = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate FROM lineitem
"""

CSV_QUOTE_REPAIR = """
SELECT doc_id, source,
       replace(regexp_replace(text, '[\r\n]+', ' ', 'g') || ' "quoted"', '"', '') AS body
FROM documents
"""

CSV_MULTILINE_REPORT = """
WITH rec AS (
  SELECT doc_id, '"' || CAST(doc_id AS VARCHAR) || '","' || replace(text, '"', '') || '"' AS r FROM documents
),
ln AS (
  SELECT doc_id, unnest(string_split(r, chr(10))) AS line,
         unnest(range(0, len(string_split(r, chr(10))))) AS line_no
  FROM rec
)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
       CAST(length(line) - length(replace(line, '"', '')) AS INTEGER) AS n_quotes
FROM ln
WHERE (length(line) - length(replace(line, '"', ''))) % 2 = 1
"""

NAME_SANITISE = r"""
SELECT page_id,
       upper(regexp_replace(replace(replace(replace(lower(url || ' File.CSV'), '.csv', ''), '.zip', ''), ' ', '_'),
                            '[\\/*?:"<>|]', '', 'g')) AS name
FROM pages
"""

CATALOG_YEAR_FILTER = r"""
WITH r AS (
  SELECT 'Ingreso ' || o_orderpriority || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS resource_title,
         'https://files.example/' || CAST(o_orderkey AS VARCHAR) ||
         CASE WHEN o_orderstatus = 'F' THEN '.csv' ELSE '.json' END AS resource_url
  FROM orders
),
y AS (
  SELECT *, TRY_CAST(NULLIF(regexp_extract(resource_title, '\b(20\d{2})\b', 1), '') AS INTEGER) AS year FROM r
)
SELECT resource_title, resource_url, year FROM y WHERE ends_with(resource_url, '.csv') AND year IN (2001)
"""

_ANCHOR = """'<a\\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>'"""
_ROOT = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)"

LINK_DISCOVERY = f"""
WITH a AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, {_ANCHOR}, 1)) AS href,
         unnest(regexp_extract_all(html, {_ANCHOR}, 2)) AS txt
  FROM pages
)
SELECT page_id, href, CASE WHEN starts_with(href, '/') THEN {_ROOT} || href ELSE href END AS resolved_url,
       trim(txt) AS anchor_text
FROM a WHERE contains(upper(trim(txt)), 'THE')
"""

LINK_FIRST_MATCH = f"""
WITH f AS (
  SELECT page_id, url, list_filter(regexp_extract_all(html, {_ANCHOR}, 1), lambda x: regexp_matches(x, '^/[A-Z]'))[1] AS href
  FROM pages
)
SELECT page_id, href, CASE WHEN starts_with(href, '/') THEN {_ROOT} || href ELSE href END AS resolved_url
FROM f WHERE href IS NOT NULL
"""

CSV_ROUND_TRIP = r"""
WITH d AS (SELECT doc_id, source, regexp_replace(text, '["\r]', '', 'g') AS plain FROM documents)
SELECT doc_id, source, md5('a quoted C:\ ' || regexp_replace(plain, '\n', ' ', 'g')) AS text_md5 FROM d WHERE doc_id % 2 = 0
UNION ALL SELECT doc_id, source, md5(plain) FROM d WHERE doc_id % 2 <> 0
UNION ALL SELECT NULL, 'source', md5('note, text')
"""

STRING_AGG = """
SELECT p_brand, string_agg(p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY p_brand
"""


def _manifest_sql() -> str:
    parts = [
        f"SELECT '{t}_raw' AS tablename, '{t}.parquet' AS filename, 'loaded' AS status, "
        f"CAST(count(*) AS BIGINT) AS n_rows, CAST({n} AS INTEGER) AS n_cols FROM {t}"
        for t, n in DRIVER_TABLES.items()
    ]
    parts.append("SELECT 'absent_raw', 'absent_table.parquet', 'missing', CAST(NULL AS BIGINT), CAST(NULL AS INTEGER)")
    parts.append("SELECT 'lineitem_yearly_raw', 'lineitem_2023.parquet', 'missing', CAST(NULL AS BIGINT), CAST(NULL AS INTEGER)")
    return "\nUNION ALL ".join(parts)


MANIFEST_INGEST_REPORT = _manifest_sql()

ORACLE_SQL = {
    "schema_profile": SCHEMA_PROFILE,
    "schema_profile_part": SCHEMA_PROFILE_PART,
    "schema_reconcile_align": SCHEMA_RECONCILE_ALIGN,
    "multi_vintage_append": MULTI_VINTAGE_APPEND,
    "timestamp_sanitise": TIMESTAMP_SANITISE,
    "try_convert_defaults": TRY_CONVERT_DEFAULTS,
    "module_merge_full_join": MODULE_MERGE_FULL_JOIN,
    "module_merge_same_keys": MODULE_MERGE_SAME_KEYS,
    "module_split_price": MODULE_SPLIT_PRICE,
    "module_split_flags": MODULE_SPLIT_FLAGS,
    "csv_quote_repair": CSV_QUOTE_REPAIR,
    "csv_multiline_report": CSV_MULTILINE_REPORT,
    "name_sanitise": NAME_SANITISE,
    "catalog_year_filter": CATALOG_YEAR_FILTER,
    "link_discovery": LINK_DISCOVERY,
    "link_first_match": LINK_FIRST_MATCH,
    "string_agg": STRING_AGG,
    "csv_round_trip": CSV_ROUND_TRIP,
    "manifest_ingest_report": MANIFEST_INGEST_REPORT,
}
