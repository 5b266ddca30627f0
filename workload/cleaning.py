"""Cleaning, conforming, defaults, fixed values and the target catalogue."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from loadsieve.functions import parsers as P
from loadsieve.functions.text import NULL_TOKENS_V1, canonical_key, canonical_key_v1, snake_name
from loadsieve.operators import cleaning as C
from loadsieve.sources import catalog
from workload import ducksql as D
from workload.fixtures import duck, frame, table

RAW = ["raw_date", "raw_total", "raw_flag"]
LOAD_TIME = datetime(2024, 5, 6, 7, 8, 9)


def text_clean(spark, d):
    return C.clean_columns(frame(spark, d, "dirty_orders"), RAW)


def text_clean_v1(spark, d):
    return C.clean_columns(frame(spark, d, "dirty_orders"), RAW, NULL_TOKENS_V1)


def drop_control(spark, d):
    df = frame(spark, d, "dirty_orders").withColumn(" Errores ", F.lit("x")).withColumn("errores_previos", F.lit("y"))
    return C.drop_control_columns(df)


def drop_empty_rows(spark, d):
    return C.drop_empty_rows(C.clean_columns(frame(spark, d, "dirty_orders"), RAW), ["raw_date", "raw_total"])


def drop_summary_rows(spark, d):
    return C.drop_summary_rows(frame(spark, d, "summaries"), "periodo", "operacion_cdg", "id_externo")


CONFORM = {"raw_flag": "string", "nota": "string", "importe": "double", "raw_date": "string"}


def schema_conform(spark, d):
    return C.conform(frame(spark, d, "dirty_orders"), CONFORM, keep=["k"])


def default_fill(spark, d):
    literal = lambda text: P.parse_default_literal(F.lit(text))["value"]
    defaults = {"nota": literal("'sin ''nota'''::text"), "importe": literal("-3.5::numeric"), "alta": literal("now()")}
    return C.conform(frame(spark, d, "dirty_orders"), {**CONFORM, "alta": "date"}, ["k"], defaults)


def fixed_values(spark, d):
    tokens = {
        "creador": "Massive Import",
        "borrado": "__FALSE__",
        "activo": "__true__",
        "vacio": "__null__",
        "raw_flag": "fijo",
        "fuera": "x",
        "fecha_carga": "__now_ts__",
        "fecha_creacion": "__today__",
    }
    types = {"vacio": "string"}
    names = [n for n in tokens if n != "fuera"]
    return C.apply_fixed_values(frame(spark, d, "dirty_orders"), tokens, names, LOAD_TIME, types)


def storage_value(spark, d):
    df = frame(spark, d, "numbers").select(
        "k", F.col("raw").alias("texto"), P.parse_number(F.col("raw")).alias("numero")
    )
    nan = F.when(F.col("k") % 50 == 1, F.lit(float("nan"))).otherwise(F.col("numero"))
    return C.to_storage(df.withColumn("numero", nan), ["texto", "numero"])


def default_literal_parse(spark, d):
    parsed = P.parse_default_literal(F.col("column_default"))
    df = frame(spark, d, "catalogue").select("table_name", "ordinal_position", "column_default", parsed.alias("p"))
    return df.select("table_name", "ordinal_position", "column_default", "p.kind", "p.value")


def table_metadata(spark, d):
    return catalog.read_column_meta(frame(spark, d, "catalogue"))


def insertable_columns(spark, d):
    return catalog.insertable_columns(table_metadata(spark, d)).select("table_name", "ordinal", "name")


def catalog_list(spark, d):
    tables = frame(spark, d, "catalogue").select("table_schema", "table_name", "table_type").distinct()
    return catalog.base_tables(tables)


def canonical_keys(spark, d):
    return table(spark, d, "documents").select("doc_id", canonical_key(F.col("text")).alias("clave"))


def canonical_keys_v1(spark, d):
    return table(spark, d, "documents").select("doc_id", canonical_key_v1(F.col("text")).alias("clave"))


def snake_names(spark, d):
    return table(spark, d, "documents").select("doc_id", snake_name(F.col("text")).alias("nombre"))


QUERIES = {
    "text_clean": text_clean,
    "text_clean_v1": text_clean_v1,
    "drop_control": drop_control,
    "drop_empty_rows": drop_empty_rows,
    "drop_summary_rows": drop_summary_rows,
    "schema_conform": schema_conform,
    "default_fill": default_fill,
    "fixed_values": fixed_values,
    "storage_value": storage_value,
    "default_literal_parse": default_literal_parse,
    "table_metadata": table_metadata,
    "insertable_columns": insertable_columns,
    "catalog_list": catalog_list,
    "canonical_key": canonical_keys,
    "canonical_key_v1": canonical_keys_v1,
    "snake_name": snake_names,
}


def _metadata() -> str:
    return f"""SELECT table_schema, table_name, ordinal_position AS ordinal, column_name AS name, data_type,
  is_nullable = 'YES' AS is_nullable, column_default, coalesce(is_identity, 'NO') = 'YES' AS is_identity,
  coalesce(is_generated, 'NEVER') <> 'NEVER' AS is_generated FROM ({duck("catalogue")}) c"""


def oracles() -> dict[str, str]:
    dirty = duck("dirty_orders")
    flat = D.strip("column_default")
    bare = D.strip(f"""regexp_replace({flat}, '::[a-zA-Z0-9_\\s\\[\\].\\"]+$', '')""")
    number = D.number("trim(raw)")
    cat = duck("catalogue")
    return {
        "text_clean": D.cleaned(dirty),
        "text_clean_v1": f"SELECT k, {D.clean('raw_date', NULL_TOKENS_V1)} AS raw_date, "
        f"{D.clean('raw_total', NULL_TOKENS_V1)} AS raw_total, {D.clean('raw_flag', NULL_TOKENS_V1)} AS raw_flag "
        f"FROM ({dirty}) q",
        "drop_control": f"SELECT k, raw_date, raw_total, raw_flag, 'y' AS errores_previos FROM ({dirty}) q",
        "drop_empty_rows": f"SELECT * FROM ({D.cleaned(dirty)}) q WHERE raw_date IS NOT NULL OR raw_total IS NOT NULL",
        "drop_summary_rows": f"""SELECT * FROM ({duck("summaries")}) q WHERE NOT coalesce(
  lower(trim(periodo)) IN ('col','columna','column')
  AND (contains(lower(trim(operacion_cdg)),'dato') OR contains(lower(trim(operacion_cdg)),'cantidad'))
  AND (contains(lower(trim(id_externo)),'nulo') OR contains(lower(trim(id_externo)),'vacio')
       OR contains(lower(trim(id_externo)),'vacío')), false)""",
        "schema_conform": f"""SELECT k, raw_flag, CAST(NULL AS VARCHAR) AS nota, CAST(NULL AS DOUBLE) AS importe, raw_date
FROM ({dirty}) q""",
        "default_fill": f"""SELECT k, raw_flag, 'sin ''nota''' AS nota, CAST(-3.5 AS DOUBLE) AS importe, raw_date,
  CAST(NULL AS DATE) AS alta FROM ({dirty}) q""",
        "fixed_values": f"""SELECT k, raw_date, raw_total, 'fijo' AS raw_flag, 'Massive Import' AS creador, false AS borrado,
  true AS activo, CAST(NULL AS VARCHAR) AS vacio, TIMESTAMP '2024-05-06 07:08:09' AS fecha_carga,
  DATE '2024-05-06' AS fecha_creacion FROM ({dirty}) q""",
        "storage_value": f"""SELECT k,
  CASE WHEN regexp_full_match(trim(raw), '^np[.]float64[(]([-+]?[0-9]+([.][0-9]+)?([eE][-+]?[0-9]+)?)[)]$')
      THEN substr(trim(raw), 12, length(trim(raw)) - 12)
    WHEN regexp_full_match(trim(raw), '^np[.]int64[(][-+]?[0-9]+[)]$') THEN substr(trim(raw), 10, length(trim(raw)) - 10)
    ELSE trim(raw) END AS texto,
  CASE WHEN k % 50 = 1 OR isinf({number}) THEN NULL ELSE {number} END AS numero
FROM ({duck("numbers")}) q""",
        "default_literal_parse": f"""SELECT table_name, ordinal_position, column_default,
  CASE WHEN lower(b) IN ('true','false') THEN 'boolean' WHEN {D.full("b", "^[-+]?[0-9]+$")} THEN 'integer'
    WHEN {D.full("b", "^[-+]?[0-9]*[.][0-9]+$")} THEN 'decimal'
    WHEN regexp_full_match(b, '''((?:''''|[^''])*)''') THEN 'text' END AS kind,
  CASE WHEN lower(b) IN ('true','false') THEN lower(b)
    WHEN {D.full("b", "^[-+]?[0-9]+$")} OR {D.full("b", "^[-+]?[0-9]*[.][0-9]+$")} THEN b
    WHEN regexp_full_match(b, '''((?:''''|[^''])*)''') THEN replace(substr(b, 2, length(b) - 2), '''''', '''') END AS value
FROM (SELECT *, {bare} AS b FROM ({cat}) c) q""",
        "table_metadata": _metadata(),
        "insertable_columns": f"""SELECT table_name, ordinal, name FROM ({_metadata()}) m
WHERE NOT is_identity AND NOT is_generated AND NOT coalesce(contains(column_default, 'nextval('), false)""",
        "catalog_list": f"""SELECT DISTINCT table_schema, table_name FROM ({cat}) c
WHERE table_type = 'BASE TABLE' AND table_schema NOT IN ('information_schema','pg_catalog','pg_toast')
  AND table_schema NOT LIKE 'pg_temp_%' AND table_schema NOT LIKE 'pg_toast_temp_%'""",
        "canonical_key": f"SELECT doc_id, {D.key('text')} AS clave FROM documents",
        "canonical_key_v1": f"SELECT doc_id, {D.key('text', False)} AS clave FROM documents",
        "snake_name": f"SELECT doc_id, {D.snake('text')} AS nombre FROM documents",
    }
