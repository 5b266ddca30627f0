"""Typed parsers, validation flags and row routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadsieve.functions import parsers as P
from loadsieve.functions.text import clean_text
from loadsieve.operators import report as R
from loadsieve.operators import validate as V
from loadsieve.plans.load import prepare, stage
from loadsieve.plans.spec import ColumnMeta, LoadSpec
from workload import ducksql as D
from workload.fixtures import duck, frame

SPEC = LoadSpec(
    target="orders_in",
    columns=(ColumnMeta("fecha", "date"), ColumnMeta("total", "double precision"), ColumnMeta("activo", "boolean")),
    period_columns=("fecha",),
)
RENAMED = {"raw_date": "fecha", "raw_total": "total", "raw_flag": "activo"}


def dirty(spark, d, name="dirty_orders"):
    return frame(spark, d, name).withColumnsRenamed(RENAMED)


def staged(spark, d, name="dirty_orders"):
    return stage(dirty(spark, d, name), SPEC, keep=["k"])


def _parser(fixture, column, parse):
    def run(spark, d):
        return frame(spark, d, fixture).select("k", parse(clean_text(F.col(column))).alias("valor"))

    return run


def _flag(column, parse, flag):
    def run(spark, d):
        raw = clean_text(F.col(column))
        df = frame(spark, d, "dirty_orders").select("k", raw.alias("r"), parse(raw).alias("p"))
        return df.select("k", flag(F.col("r"), F.col("p")).alias("mal"))

    return run


def typed_projection(spark, d):
    return staged(spark, d).select("k", "fecha", "total", "activo")


INTEGERS = LoadSpec(
    target="integers", columns=(ColumnMeta("s", "smallint"), ColumnMeta("i", "integer"), ColumnMeta("b", "bigint"))
)


def typed_integers(spark, d):
    """Whole-number targets: beyond 2^53, fractions, out of range, grouped and wrapped."""
    raw = frame(spark, d, "integers").select("k", *[F.col("raw").alias(c) for c in "sib"])
    return stage(raw, INTEGERS, keep=["k"]).select("k", "s", "i", "b", "errores")


def flag_date_order(spark, d):
    rows = frame(spark, d, "order_ship").select(
        "k", P.parse_date(F.col("raw_start")).alias("inicio"), P.parse_date(F.col("raw_end")).alias("fin")
    )
    return rows.select("k", V.bad_order(F.col("inicio"), F.col("fin")).alias("mal"))


def error_matrix(spark, d):
    return R.error_matrix(staged(spark, d), V.reasons(SPEC), ["k"])


def error_message(spark, d):
    return staged(spark, d).select("k", "errores")


def valid_split(spark, d):
    return V.valid_rows(staged(spark, d))


def reject_split(spark, d):
    return V.reject_rows(staged(spark, d), SPEC, ["k"])


def annotate_all(spark, d):
    return V.annotate(staged(spark, d), SPEC, ["k"])


def annotate_join(spark, d):
    """Messages kept apart from their rows are written back by row key."""
    source = dirty(spark, d).withColumn("Errores", F.lit("old message"))
    return V.annotate_source(source, reject_split(spark, d).select("k", "errores"), ["k"])


def flag_default(spark, d):
    flag = V.null_to_false(P.parse_bool(clean_text(F.col("raw_flag"))))
    return frame(spark, d, "dirty_orders").select("k", flag.alias("valor"))


def top_errors(spark, d):
    return R.top_errors(staged(spark, d))


def load_summary(spark, d):
    return R.load_summary(staged(spark, d))


def prepared(spark, d):
    """Row preparation before typing: cleaned inputs without empty rows."""
    return prepare(dirty(spark, d), SPEC, ["k"])


QUERIES = {
    "parse_date_dayfirst": _parser("dirty_orders", "raw_date", P.parse_date_dayfirst),
    "parse_serial_date": _parser("serials", "raw", P.parse_serial_date),
    "parse_period": _parser("dirty_orders", "raw_date", P.parse_period),
    "parse_date_unbounded": _parser("far_dates", "raw", P.parse_date_unbounded),
    "parse_timestamp": _parser("stamps", "raw", P.parse_timestamp),
    "parse_number": _parser("numbers", "raw", P.parse_number),
    "parse_number_v1": _parser("numbers", "raw", P.parse_number_v1),
    "parse_bool": _parser("dirty_orders", "raw_flag", P.parse_bool),
    "typed_projection": typed_projection,
    "typed_integers": typed_integers,
    "flag_bad_parse": _flag("raw_total", P.parse_number, V.bad_parse),
    "flag_year_range": _flag("raw_date", P.parse_period, lambda r, p: V.bad_year(p, 1900, 2100)),
    "flag_bad_bool": _flag("raw_flag", P.parse_bool, V.bad_bool),
    "flag_date_order": flag_date_order,
    "error_matrix": error_matrix,
    "error_message": error_message,
    "valid_split": valid_split,
    "reject_split": reject_split,
    "annotate_all": annotate_all,
    "annotate_join": annotate_join,
    "flag_default": flag_default,
    "top_errors": top_errors,
    "load_summary": load_summary,
    "prepared_rows": prepared,
}


def oracles() -> dict[str, str]:
    base = duck("dirty_orders")
    stage_sql = D.staged(base)
    date, total, flag = (D.strip(c) for c in ("raw_date", "raw_total", "raw_flag"))
    raw = D.strip("raw")
    # a row whose three inputs are all empty is no row at all
    kept = "(raw_date IS NOT NULL OR raw_total IS NOT NULL OR raw_flag IS NOT NULL)"
    rows = f"SELECT * FROM ({stage_sql}) s WHERE {kept}"

    def over(fixture: str, expr: str) -> str:
        return f"SELECT k, {expr} AS valor FROM ({duck(fixture)}) q"

    n = D.serial_number(raw)
    serial_stamp = (
        f"CASE WHEN {n} BETWEEN 1 AND 73050 THEN CAST(DATE '1899-12-30' + CAST(floor({n}) AS INTEGER) AS TIMESTAMP) "
        f"+ to_seconds(CAST(round(({n} - floor({n})) * 86400) AS BIGINT)) END"
    )
    digits = "[0-9](_?[0-9])*"
    plain = f"replace({raw},',','.')"
    grouped = f"^[+-]?({digits}[.]?({digits})?|[.]{digits})([eE][+-]?{digits})?$"
    far = f"CASE WHEN {D.full(plain, grouped)} THEN TRY_CAST(replace({plain},'_','') AS DOUBLE) END"
    day_text = f"CASE WHEN {D.full(raw, '^[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{4}$')} THEN try_strptime(replace({raw},'-','/'),'%d/%m/%Y') "
    iso_shape = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ ]+[0-9]{2}:[0-9]{2}:[0-9]{2})?$"
    iso_text = f"WHEN {D.full(raw, iso_shape)} THEN try_strptime(split_part({raw},' ',1),'%Y-%m-%d') END"
    unbounded = (
        f"coalesce(CASE WHEN {far} BETWEEN 1 AND 2958465 THEN DATE '1899-12-30' + CAST(floor({far}) AS INTEGER) END, "
        f"CAST({day_text}{iso_text} AS DATE))"
    )
    shown = "k, raw_date AS fecha, raw_total AS total, raw_flag AS activo, errores"
    return {
        "parse_date_dayfirst": over("dirty_orders", D.calendar_date(date)),
        "parse_serial_date": over("serials", D.serial_date(raw)),
        "parse_period": over("dirty_orders", D.period(date)),
        "parse_date_unbounded": over("far_dates", unbounded),
        "parse_timestamp": over("stamps", f"coalesce({D.calendar_stamp(raw)}, {serial_stamp})"),
        "parse_number": over("numbers", D.number(raw)),
        "parse_number_v1": over("numbers", D.checked_number(raw)),
        "parse_bool": over("dirty_orders", D.boolean(flag)),
        "typed_integers": f"""SELECT k, CASE WHEN v BETWEEN -32768 AND 32767 THEN v::SMALLINT END AS s,
  CASE WHEN v BETWEEN -2147483648 AND 2147483647 THEN v::INTEGER END AS i,
  CASE WHEN v BETWEEN -9223372036854775808 AND 9223372036854775807 THEN v::BIGINT END AS b,
  CASE WHEN kind = 'null' THEN '' ELSE concat_ws(', ', CASE WHEN NOT coalesce(v BETWEEN -32768 AND 32767, false) THEN 's' END,
    CASE WHEN NOT coalesce(v BETWEEN -2147483648 AND 2147483647, false) THEN 'i' END,
    CASE WHEN NOT coalesce(v BETWEEN -9223372036854775808 AND 9223372036854775807, false) THEN 'b' END) END AS errores
FROM (SELECT k, CASE k % 12 WHEN 8 THEN 'null' ELSE 'value' END AS kind, CASE k % 12 WHEN 0 THEN 9007199254740993::HUGEINT + k
  WHEN 1 THEN -9223372036854775808::HUGEINT WHEN 2 THEN 9223372036854775807::HUGEINT WHEN 3 THEN 9223372036854775808::HUGEINT
  WHEN 4 THEN 2147483648::HUGEINT WHEN 5 THEN k::HUGEINT WHEN 6 THEN (k % 30000 + 1)::HUGEINT WHEN 7 THEN (1234567 * 1000 + k % 1000)::HUGEINT
  WHEN 9 THEN NULL WHEN 10 THEN (k * 1000)::HUGEINT WHEN 11 THEN (-(k % 20000) - 1)::HUGEINT END AS v FROM ({duck("integers")}) q) n""",
        "typed_projection": f"SELECT k, fecha, total, activo FROM ({rows}) q",
        "flag_bad_parse": f"""SELECT k, {D.number('raw_total')} IS NULL AND raw_total IS NOT NULL AS mal
FROM ({D.cleaned(base)}) q""",
        "flag_year_range": f"""SELECT k, coalesce(year({D.period(date)}) NOT BETWEEN 1900 AND 2100, false) AS mal
FROM ({base}) q""",
        "flag_bad_bool": f"SELECT k, raw_flag IS NOT NULL AND {D.boolean('raw_flag')} IS NULL AS mal FROM ({D.cleaned(base)}) q",
        "flag_date_order": f"""SELECT k, coalesce({D.date('raw_start')} > {D.date('raw_end')}, false) AS mal
FROM ({duck("order_ship")}) q""",
        "error_matrix": f"""SELECT k, list_contains(string_split(errores, ', '), 'fecha') AS fecha,
  list_contains(string_split(errores, ', '), 'total') AS total,
  list_contains(string_split(errores, ', '), 'activo') AS activo, errores <> '' AS any_error FROM ({rows}) q""",
        "error_message": f"SELECT k, errores FROM ({rows}) q",
        "valid_split": f"SELECT k, fecha, total, activo FROM ({rows}) q WHERE errores = ''",
        "reject_split": f"SELECT {shown} FROM ({rows}) q WHERE errores <> ''",
        "annotate_all": f"SELECT {shown} FROM ({rows}) q",
        "annotate_join": f"""SELECT d.k, d.raw_date AS fecha, d.raw_total AS total, d.raw_flag AS activo,
  coalesce(e.errores, '') AS errores FROM ({base}) d LEFT JOIN (SELECT k, errores FROM ({rows}) q) e ON d.k = e.k""",
        "flag_default": f"SELECT k, coalesce({D.boolean(flag)}, false) AS valor FROM ({base}) q",
        "top_errors": f"""SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT unnest(string_split(errores, ', ')) AS reason FROM ({rows}) q WHERE errores <> '') u
GROUP BY reason ORDER BY rows DESC, reason LIMIT 10""",
        "load_summary": f"""SELECT CAST(count(*) AS BIGINT) AS rows_read,
  CAST(count(*) FILTER (WHERE errores = '') AS BIGINT) AS rows_valid,
  CAST(count(*) FILTER (WHERE errores <> '') AS BIGINT) AS rows_invalid FROM ({rows}) q""",
        "prepared_rows": f"""SELECT k, raw_date AS fecha, raw_total AS total, raw_flag AS activo
FROM ({D.cleaned(base)}) q WHERE {kept}""",
    }
