"""Inputs of the registered queries: SQL over the whole given tables, for Spark and DuckDB.

The same text serves both engines; only a few expressions differ by dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

MONTH_NAME = "CASE month(d) " + " ".join(
    f"WHEN {i} THEN '{m}'"
    for i, m in enumerate("ene feb mar abr may jun jul ago sep oct nov dic".split(), 1)
) + " END"

DAYS = {"spark": "datediff(d, DATE'1899-12-30')", "duck": "date_diff('day', DATE '1899-12-30', d)"}


def _dirty(base: str, key: str, date: str, number: str) -> str:
    """Text as it comes in sheets: dates, numbers and flags in many spellings, some wrong."""
    return f"""
WITH b AS (SELECT {key} AS k, CAST({date} AS DATE) AS d, CAST({number} AS DECIMAL(18,2)) AS t FROM {base}),
f AS (SELECT k, CAST(year(d) AS STRING) AS y, lpad(CAST(month(d) AS STRING),2,'0') AS m,
  lpad(CAST(day(d) AS STRING),2,'0') AS dd, month(d) AS mi, day(d) AS di, {MONTH_NAME} AS mes,
  CAST(<DAYS> AS STRING) AS ser, CAST(t AS STRING) AS ts FROM b)
SELECT k,
  CASE k % 11 WHEN 0 THEN dd||'/'||m||'/'||y WHEN 1 THEN y||'-'||m||'-'||dd WHEN 2 THEN ser
    WHEN 3 THEN mes||'-'||substr(y,3,2) WHEN 4 THEN CAST(di AS STRING)||'-'||CAST(mi AS STRING)||'-'||y
    WHEN 5 THEN '99/99/2024' WHEN 6 THEN ' - ' WHEN 7 THEN y||'-'||m||'-'||dd||' 00:00:00'
    WHEN 8 THEN '31/02/'||y WHEN 9 THEN '0123-'||m||'-'||dd ELSE upper(mes)||'/'||y END AS raw_date,
  CASE k % 7 WHEN 0 THEN ts WHEN 1 THEN replace(ts,'.',',') WHEN 2 THEN '1.'||replace(ts,'.',',')
    WHEN 3 THEN 'np.float64('||ts||')' WHEN 4 THEN 'N/A' WHEN 5 THEN 'x'||ts ELSE ' '||ts||' ' END AS raw_total,
  CASE k % 6 WHEN 0 THEN 'Sí' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN 'FALSE' WHEN 4 THEN 'talvez'
    ELSE '--' END AS raw_flag
FROM f"""


SQL = {
    "dirty_orders": _dirty("orders", "o_orderkey", "o_orderdate", "o_totalprice"),
    "dirty_lineitem": _dirty("lineitem", "l_orderkey * 8 + l_linenumber", "l_shipdate", "l_extendedprice"),
    # Serial numbers: whole, fractional, signed, out of range, with text around them.
    "serials": """
SELECT o_orderkey AS k, CASE o_orderkey % 10
  WHEN 0 THEN CAST(<DAYS> AS STRING) WHEN 1 THEN CAST(<DAYS> AS STRING)||'.25' WHEN 2 THEN '73050'
  WHEN 3 THEN '73051' WHEN 4 THEN '0' WHEN 5 THEN CAST(<DAYS> AS STRING)||'.999999' WHEN 6 THEN '4.5e4'
  WHEN 7 THEN '-'||CAST(<DAYS> AS STRING) WHEN 8 THEN CAST(<DAYS> AS STRING)||'d'
  ELSE ' '||CAST(1 + o_orderkey % 73050 AS STRING)||' ' END AS raw
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) q""",
    # Dates of the unbounded mode: serials to year 9999, decimal comma, grouping, calendar text.
    "far_dates": """
SELECT o_orderkey AS k, CASE o_orderkey % 12
  WHEN 0 THEN CAST(1 + (o_orderkey * 7919) % 2958465 AS STRING) WHEN 1 THEN CAST(<DAYS> AS STRING)||',75'
  WHEN 2 THEN '2958466' WHEN 3 THEN '1_000' WHEN 4 THEN '2024'
  WHEN 5 THEN CAST(day(d) AS STRING)||'-'||CAST(month(d) AS STRING)||'-9'||substr(CAST(year(d) AS STRING),2,3)
  WHEN 6 THEN CAST(year(d) AS STRING)||'-'||CAST(month(d) AS STRING)||'-'||CAST(day(d) AS STRING)||'  23:59:59'
  WHEN 7 THEN CAST(day(d) AS STRING)||'/'||CAST(month(d) AS STRING)||'/'||CAST(year(d) AS STRING)||' 10:00:00'
  WHEN 8 THEN '31/04/'||CAST(year(d) AS STRING) WHEN 9 THEN 'ene-24' WHEN 10 THEN '0.5'
  ELSE '0'||CAST(100 + month(d) AS STRING)||'-1-'||CAST(day(d) AS STRING) END AS raw
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) q""",
    # Dates with a time of day, from the event stream.
    "stamps": """
SELECT event_id AS k, CASE event_id % 7
  WHEN 0 THEN y||'-'||m||'-'||dd||' '||hms WHEN 1 THEN dd||'/'||m||'/'||y||' '||hms
  WHEN 2 THEN CAST(<DAYS> AS STRING)||'.5' WHEN 3 THEN y||'-'||m||'-'||dd WHEN 4 THEN dd||'-'||m||'-'||y||' 25:00:00'
  WHEN 5 THEN '73050.0000001' ELSE event_type END AS raw
FROM (SELECT *, CAST(ts AS DATE) AS d, CAST(year(ts) AS STRING) AS y, lpad(CAST(month(ts) AS STRING),2,'0') AS m,
  lpad(CAST(day(ts) AS STRING),2,'0') AS dd, lpad(CAST(hour(ts) AS STRING),2,'0')||':'||
  lpad(CAST(minute(ts) AS STRING),2,'0')||':'||lpad(CAST(CAST(floor(second(ts)) AS INT) AS STRING),2,'0') AS hms
  FROM events) q""",
    # Number spellings: European, plain, wrapped, infinite and plain wrong.
    "numbers": """
SELECT k, CASE k % 16 WHEN 0 THEN t WHEN 1 THEN replace(t,'.',',') WHEN 2 THEN '1.'||replace(t,'.',',')
  WHEN 3 THEN 'np.float64('||t||')' WHEN 4 THEN 'np.int64('||CAST(k AS STRING)||')' WHEN 5 THEN '1,234,567'
  WHEN 6 THEN '1,234.56' WHEN 7 THEN 'inf' WHEN 8 THEN '-Infinity' WHEN 9 THEN '5f' WHEN 10 THEN '1_000'
  WHEN 11 THEN '0x10' WHEN 12 THEN '.5' WHEN 13 THEN '1.5e3' WHEN 14 THEN 'np.float64(12,5)'
  ELSE ' +'||t||' ' END AS raw
FROM (SELECT l_orderkey * 8 + l_linenumber AS k, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS t
  FROM lineitem) q""",
    # Whole numbers as text: exact beyond doubles, at and past the limits, fractions, grouped, wrapped.
    "integers": """
SELECT k, CASE k % 12 WHEN 0 THEN CAST(9007199254740993 + k AS STRING) WHEN 1 THEN '-9223372036854775808' WHEN 2 THEN '9223372036854775807'
  WHEN 3 THEN '9223372036854775808' WHEN 4 THEN '2147483648' WHEN 5 THEN 'np.int64('||CAST(k AS STRING)||')'
  WHEN 6 THEN CAST(k % 30000 AS STRING)||',5' WHEN 7 THEN '1.234.567.'||lpad(CAST(k % 1000 AS STRING),3,'0')||',0' WHEN 8 THEN 'inf' WHEN 9 THEN 'x1'
  WHEN 10 THEN CAST(k AS STRING)||'e3' ELSE '-'||CAST(k % 20000 AS STRING)||'.5' END AS raw
FROM (SELECT l_orderkey * 8 + l_linenumber AS k FROM lineitem) q""",
    # Two dates per line, for the rule that the first may not come after the second.
    "order_ship": """
SELECT l_orderkey * 8 + l_linenumber AS k,
  CASE WHEN l_linenumber % 5 = 0 THEN '99/99/2024' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS raw_start,
  CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS raw_end
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    # Rows with a trailing summary now and then.
    "summaries": """
SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN ' Columna' WHEN 1 THEN 'col' WHEN 2 THEN NULL
    ELSE o_orderpriority END AS periodo,
  CASE o_orderkey % 3 WHEN 0 THEN 'Cantidad de datos' WHEN 1 THEN NULL ELSE o_orderstatus END AS operacion_cdg,
  CASE o_orderkey % 4 WHEN 0 THEN 'Nulos' WHEN 1 THEN 'VACÍO' WHEN 2 THEN 'lleno' END AS id_externo
FROM orders""",
    # Target catalogue: one described column per part, forty columns per table.
    "catalogue": """
SELECT CASE t % 6 WHEN 0 THEN 'pg_temp_'||CAST(t AS STRING) WHEN 1 THEN 'information_schema'
    ELSE 's'||CAST(t % 4 AS STRING) END AS table_schema,
  't'||CAST(t AS STRING) AS table_name, CASE WHEN t % 7 = 3 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
  CAST(p_partkey % 40 + 1 AS INT) AS ordinal_position,
  replace(p_name,' ','_')||'_'||CAST(p_partkey % 40 AS STRING) AS column_name,
  CASE p_partkey % 5 WHEN 0 THEN 'date' WHEN 1 THEN 'integer' WHEN 2 THEN 'text' WHEN 3 THEN 'boolean'
    ELSE 'double precision' END AS data_type,
  CASE WHEN p_size % 2 = 0 THEN 'YES' ELSE 'NO' END AS is_nullable,
  CASE p_partkey % 13 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE::boolean' WHEN 2 THEN CAST(p_size AS STRING)
    WHEN 3 THEN '-'||CAST(p_size AS STRING)||'.5::numeric(10,2)' WHEN 4 THEN '-'||CAST(p_size AS STRING)||'.5::numeric'
    WHEN 5 THEN '''it''''s '||p_name||'''::character varying' WHEN 6 THEN 'nextval(''seq''::regclass)'
    WHEN 7 THEN 'now()' WHEN 8 THEN '' WHEN 9 THEN '.5' WHEN 10 THEN '''open' WHEN 11 THEN ' +7 ' END AS column_default,
  CASE WHEN p_partkey % 17 = 0 THEN 'YES' ELSE 'NO' END AS is_identity,
  CASE WHEN p_partkey % 19 = 0 THEN 'ALWAYS' WHEN p_partkey % 19 = 1 THEN NULL ELSE 'NEVER' END AS is_generated
FROM (SELECT *, CAST(floor(p_partkey / 40) AS BIGINT) AS t FROM part) q""",
    # Headers: one per part, forty per feed.
    "feeds": """
SELECT 'F'||CAST(CAST(floor(p_partkey / 40) AS BIGINT) AS STRING) AS feed_id, 'parts' AS target_table,
  CAST(ordinal AS INT) AS ordinal,
  CASE ordinal % 8 WHEN 1 THEN p_name WHEN 2 THEN upper(p_name)||' (EUR)' WHEN 3 THEN replace(p_name,'i','í')||'.1'
    WHEN 4 THEN substr(p_name,1,length(p_name)-1) WHEN 5 THEN 'Unnamed: '||CAST(ordinal AS STRING)
    WHEN 6 THEN p_name||' 2' WHEN 7 THEN p_type ELSE p_type||' 2' END AS raw_header
FROM (SELECT *, p_partkey % 40 + 1 AS ordinal FROM part) q""",
    "targets": """
SELECT 'parts' AS target_table, CAST(min(p_partkey) AS INT) AS ordinal, replace(p_name,' ','_') AS target
FROM part GROUP BY p_name""",
    # Column defaults of the targets: literals and an expression.
    "target_defaults": """
SELECT 'parts' AS target_table, replace(p_name,' ','_') AS target, CASE min(p_partkey) % 6 WHEN 0 THEN 'FALSE' WHEN 1 THEN '42'
  WHEN 2 THEN '''x''::text' WHEN 3 THEN 'now()' WHEN 4 THEN '-1.5' END AS column_default
FROM part GROUP BY p_name""",
    # Remembered pairs in several versions.
    "rule_history": """
SELECT 'parts' AS target_table, CASE p_partkey % 4 WHEN 0 THEN p_type||' 2' WHEN 1 THEN 'Unnamed: '||CAST(p_size AS STRING)
    WHEN 2 THEN p_type||'.1' ELSE p_brand END AS raw_header,
  CASE WHEN p_size % 9 = 0 THEN '__IGNORAR__' ELSE replace(p_name,' ','_') END AS target, p_partkey AS version
FROM part""",
    # Pinned pairs: the newest spelling of each type.
    "rules": """
SELECT 'parts' AS target_table, p_type||' 2' AS raw_header,
  CASE p_type WHEN 'STANDARD' THEN '__IGNORAR__' ELSE replace(max(p_name),' ','_') END AS target
FROM part GROUP BY p_type""",
    "config_rules": """
SELECT 'parts' AS target_table, p_type AS raw_header, replace(min(p_name),' ','_') AS target
FROM part WHERE p_type IN ('PROMO','SMALL') GROUP BY p_type""",
    # Row grids: one cell per part, five cells per row, twenty rows per file.
    "grids": """
SELECT 'G'||CAST(g AS STRING) AS file, r AS row_no, CAST(p_partkey % 5 AS INT) AS col_no,
  CASE WHEN r < g % 4 THEN CASE WHEN p_partkey % 5 = 0 THEN 'Informe '||p_type END
    WHEN r = g % 4 THEN CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN initcap_name WHEN 2 THEN substr(p_name,2)
      WHEN 3 THEN 'Unnamed: 3' ELSE p_name||' (kg)' END
    WHEN p_partkey % 5 = 4 THEN ' ' ELSE CAST(p_size AS STRING) END AS value
FROM (SELECT *, CAST(floor(p_partkey / 100) AS BIGINT) AS g, CAST(floor((p_partkey % 100) / 5) AS BIGINT) AS r,
  upper(substr(p_name,1,1))||substr(p_name,2) AS initcap_name FROM part) q""",
    # Loads: one per customer of an order; some are retries of another one, or of a retry.
    "loads": """
SELECT 'L'||CAST(o_custkey AS STRING) AS load_id,
  CASE WHEN o_custkey % 3 > 0 THEN 'L'||CAST(o_custkey - 1 AS STRING) END AS parent_load_id,
  CAST(count(*) AS BIGINT) AS rows_read,
  CAST(sum(CASE WHEN o_orderstatus = 'F' OR o_custkey % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_valid,
  CAST(sum(CASE WHEN o_orderstatus = 'F' OR o_custkey % 2 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS rows_invalid
FROM orders GROUP BY o_custkey""",
    # Ledger events: registrations and completions of retries.
    "ledger": """
SELECT 'L'||CAST(o_custkey AS STRING) AS load_id, CAST(NULL AS STRING) AS parent_load_id,
  'file'||CAST(o_orderkey AS STRING) AS source, CAST(1 AS BIGINT) AS rows_read, CAST(1 AS BIGINT) AS rows_valid,
  CAST(0 AS BIGINT) AS rows_invalid,
  CASE o_orderstatus WHEN 'F' THEN 'retry_done' WHEN 'O' THEN 'retry_open' ELSE 'loaded' END AS event,
  o_orderkey AS version
FROM orders""",
}

NEEDS = {
    "dirty_orders": ["orders"],
    "dirty_lineitem": ["lineitem"],
    "serials": ["orders"],
    "far_dates": ["orders"],
    "stamps": ["events"],
    "numbers": ["lineitem"],
    "integers": ["lineitem"],
    "order_ship": ["orders", "lineitem"],
    "summaries": ["orders"],
    "loads": ["orders"],
    "ledger": ["orders"],
}


def duck(name: str) -> str:
    return SQL[name].replace("<DAYS>", DAYS["duck"])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Fixture as a Spark frame."""
    for base in NEEDS.get(name, ["part"]):
        table(spark, sf_dir, base).createOrReplaceTempView(base)
    return spark.sql(SQL[name].replace("<DAYS>", DAYS["spark"]))
