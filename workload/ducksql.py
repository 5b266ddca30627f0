"""Building blocks of the reference SQL: the operators once more, as DuckDB expressions."""

from __future__ import annotations

from loadsieve.functions.text import NULL_TOKENS, whitespace

DAY_FIRST = "^[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{4}( ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9])?$"
YEAR_FIRST = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}( ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9])?$"
NUM = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
MONTH = "^(ene|feb|mar|abr|may|jun|jul|ago|sep|oct|nov|dic)[/-]?([0-9]{2}|[0-9]{4})$"


def full(t: str, pattern: str) -> str:
    return f"regexp_full_match({t}, '{pattern}')"


def strip(c: str) -> str:
    return f"trim({c}, '{whitespace()}')"


def clean(c: str, tokens=NULL_TOKENS) -> str:
    words = ", ".join(f"'{t}'" for t in tokens)
    return f"CASE WHEN {strip(c)} NOT IN ({words}) THEN {strip(c)} END"


def calendar_stamp(t: str) -> str:
    day = f"replace({t},'-','/')"
    return (
        f"CASE WHEN {full(t, DAY_FIRST)} AND contains({t},':') THEN try_strptime({day},'%d/%m/%Y %H:%M:%S') "
        f"WHEN {full(t, DAY_FIRST)} THEN try_strptime({day},'%d/%m/%Y') "
        f"WHEN {full(t, YEAR_FIRST)} AND contains({t},':') THEN try_strptime({t},'%Y-%m-%d %H:%M:%S') "
        f"WHEN {full(t, YEAR_FIRST)} THEN try_strptime({t},'%Y-%m-%d') END"
    )


def calendar_date(t: str) -> str:
    return f"CAST({calendar_stamp(t)} AS DATE)"


def serial_number(t: str) -> str:
    return f"CASE WHEN {full(t, NUM)} THEN TRY_CAST({t} AS DOUBLE) END"


def serial_date(t: str, last: int = 73050) -> str:
    n = serial_number(t)
    return f"CASE WHEN {n} BETWEEN 1 AND {last} THEN DATE '1899-12-30' + CAST(floor({n}) AS INTEGER) END"


def month_date(t: str) -> str:
    low = f"lower({t})"
    mon = f"regexp_extract({low}, '{MONTH}', 1)"
    year = f"TRY_CAST(regexp_extract({low}, '{MONTH}', 2) AS INTEGER)"
    names = "['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic']"
    full_year = f"CASE WHEN {year} < 100 THEN {year} + 2000 ELSE {year} END"
    return f"CASE WHEN {full(low, MONTH)} THEN make_date({full_year}, CAST(list_position({names}, {mon}) AS INTEGER), 1) END"


def period(t: str) -> str:
    return f"coalesce({calendar_date(t)}, {month_date(t)}, {serial_date(t)})"


def date(t: str) -> str:
    return f"coalesce({calendar_date(t)}, {serial_date(t)})"


def number_text(t: str) -> str:
    dotted = f"CASE WHEN contains({t},',') THEN replace(replace({t},'.',''),',','.') ELSE {t} END"
    first = f"regexp_replace({dotted}, '^np[.]float64[(](.+)[)]$', '\\1')"
    return f"regexp_replace({first}, '^np[.]int64[(](.+)[)]$', '\\1')"


def checked_number(t: str) -> str:
    return (
        f"CASE WHEN {full(t, NUM)} THEN TRY_CAST({t} AS DOUBLE) "
        f"WHEN {full(f'lower({t})', '^-(inf|infinity)$')} THEN CAST('-inf' AS DOUBLE) "
        f"WHEN {full(f'lower({t})', '^[+]?(inf|infinity)$')} THEN CAST('inf' AS DOUBLE) END"
    )


def number(t: str) -> str:
    return checked_number(f"({number_text(t)})")


def boolean(t: str) -> str:
    return (
        f"CASE WHEN lower({t}) IN ('true','1','si','sí') THEN true WHEN lower({t}) IN ('false','0','no') THEN false END"
    )


def key(c: str, parentheses: bool = True) -> str:
    t = f"lower({strip(c)})"
    if parentheses:
        t = f"regexp_replace({t}, '[(][^)]*[)]', ' ', 'g')"
    return f"regexp_replace(strip_accents({t}), '[^a-z0-9]+', '', 'g')"


def snake(c: str) -> str:
    t = f"regexp_replace(lower({strip(c)}), '[(][^)]*[)]', ' ', 'g')"
    return f"trim(regexp_replace(strip_accents({t}), '[^a-z0-9]+', '_', 'g'), '_')"


def similarity(pairs: str) -> str:
    """SELECT id, r for a relation pairs(id, a, b): recursive longest common blocks."""
    return f"""
WITH RECURSIVE seg AS (
 SELECT id, a, b, 1 AS alo, length(a)+1 AS ahi, 1 AS blo, length(b)+1 AS bhi, 0 AS k FROM {pairs}
 UNION ALL
 SELECT t.id, t.a, t.b, s.alo, s.ahi, s.blo, s.bhi, CASE WHEN s.side=1 THEN t.m.k ELSE 0 END
 FROM (SELECT p.*, (SELECT max(struct_pack(k:=z, i:=-i, j:=-j))
        FROM (SELECT i, j, z FROM range(p.alo, p.ahi) r1(i), range(p.blo, p.bhi) r2(j),
                range(1, least(p.ahi-p.alo, p.bhi-p.blo)+1) r3(z)
              WHERE i+z<=p.ahi AND j+z<=p.bhi AND substr(p.a,i,z)=substr(p.b,j,z)) q) AS m
       FROM (SELECT * FROM seg WHERE alo<ahi AND blo<bhi) p) t,
  LATERAL (SELECT 1 AS side, t.alo, -t.m.i AS ahi, t.blo, -t.m.j AS bhi
           UNION ALL SELECT 2, -t.m.i+t.m.k, t.ahi, -t.m.j+t.m.k, t.bhi) s
 WHERE t.m.k IS NOT NULL)
SELECT id, 2.0*sum(k)/(length(any_value(a))+length(any_value(b))) AS r FROM seg GROUP BY id"""


def cleaned(source: str) -> str:
    """Dirty fixture with its three text columns cleaned."""
    return (
        f"SELECT k, {clean('raw_date')} AS raw_date, {clean('raw_total')} AS raw_total, "
        f"{clean('raw_flag')} AS raw_flag FROM ({source}) dirty"
    )


def staged(source: str) -> str:
    """Dirty fixture typed and validated: period, number, flag and the error text."""
    return f"""
SELECT k, raw_date, raw_total, raw_flag,
  CASE WHEN year(d) BETWEEN 1900 AND 2100 THEN d END AS fecha, n AS total, b AS activo,
  concat_ws(', ', CASE WHEN (raw_date IS NOT NULL AND d IS NULL) OR year(d) < 1900 OR year(d) > 2100 THEN 'fecha' END,
    CASE WHEN raw_total IS NOT NULL AND n IS NULL THEN 'total' END,
    CASE WHEN raw_flag IS NOT NULL AND b IS NULL THEN 'activo' END) AS errores
FROM (SELECT *, {period('raw_date')} AS d, {number('raw_total')} AS n, {boolean('raw_flag')} AS b
      FROM ({cleaned(source)}) c) p"""
