"""Typing and validation of conformed rows.

Work happens in two projections: the first parses each input column once, the second derives
flags, the error text and the stored values from the parsed columns. Both are narrow, so a
whole load needs no shuffle up to the write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsieve.functions import parsers as P
from loadsieve.functions.text import strip
from loadsieve.operators.cleaning import ERRORS_COLUMN, keep_rows
from loadsieve.plans.spec import ColumnMeta, LoadSpec

PARSED = "__parsed_"
TOLD = "__told"

# Whole-number ranges of the integer targets.
_INTEGER_BITS = {"smallint": 16, "int": 32, "bigint": 64}


def bad_parse(original: Column, parsed: Column) -> Column:
    """There was text, and it could not be read."""
    return F.coalesce(strip(original) != "", F.lit(False)) & parsed.isNull()


def bad_year(parsed: Column, min_year: int, max_year: int) -> Column:
    return F.coalesce(~F.year(parsed).between(min_year, max_year), F.lit(False))


def bad_bool(original: Column, parsed: Column) -> Column:
    return P.bool_text_of(strip(original)) & parsed.isNull()


def bad_order(start: Column, end: Column) -> Column:
    """Start after end; a missing side is no error."""
    return F.coalesce(start > end, F.lit(False))


def null_to_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def error_text(checks: Sequence[tuple[str, Column]]) -> Column:
    """Names of the failing checks in check order, joined with a comma and a space."""
    if not checks:
        return F.lit("")
    named = [F.when(flag, F.lit(name.replace("error_", ""))) for name, flag in checks]
    return F.concat_ws(", ", *named)


@dataclass(frozen=True)
class Rule:
    """How one input column is parsed, checked and stored."""

    meta: ColumnMeta
    parsed: Column | None
    flag: Column | None
    value: Column


def compile_rule(meta: ColumnMeta, spec: LoadSpec) -> Rule:
    raw = F.col(meta.name)
    got = F.col(PARSED + meta.name)
    family = meta.family
    # cleaned text is trimmed, and null when blank
    unread = raw.isNotNull() & got.isNull()
    if family == "text":
        return Rule(meta, None, None, P.storage_text_of(raw))
    if family in ("date", "timestamp"):
        return _date_rule(meta, spec, raw, got)
    if family == "boolean":
        return Rule(meta, P.bool_of(raw), P.bool_text_of(raw) & got.isNull(), got)
    if family == "decimal":
        return Rule(meta, P.decimal_of(raw, *meta.precision), unread, got)
    number = P.plain_number_of(raw) if spec.plain_numbers_only else P.number_of(raw)
    if family == "integer":
        # exact to the last digit; the database rounds a fraction and refuses a number out of range
        exact = P.whole_of(raw, plain=spec.plain_numbers_only)
        limit = 2 ** (_INTEGER_BITS[meta.spark_type] - 1)
        whole = got["whole"]
        fits = (whole >= F.lit(-limit).cast(P.WHOLE)) & (whole <= F.lit(limit - 1).cast(P.WHOLE))
        unread = raw.isNotNull() & got["number"].isNull()
        # infinity is read and stored as null; any other number without a whole is out of range
        beyond = P.storage_number(got["number"]).isNotNull() & ~F.coalesce(fits, F.lit(False))
        return Rule(meta, F.struct(number.alias("number"), exact.alias("whole")), unread | beyond, F.when(fits, whole.cast(meta.spark_type)))
    return Rule(meta, number, unread, P.storage_number(got).cast(meta.spark_type))


def _date_rule(meta: ColumnMeta, spec: LoadSpec, raw: Column, got: Column) -> Rule:
    source = raw
    if spec.reject_bare_year:
        source = F.when(~strip(raw).rlike("^(19[0-9]{2}|20[0-9]{2}|2100)$"), raw)
    if spec.unbounded_dates and meta.family == "date":
        return Rule(meta, P.unbounded_date_of(source), raw.isNotNull() & got.isNull(), got)
    if meta.family == "timestamp":
        parsed = P.timestamp_of(source)
    elif meta.name in spec.period_columns:
        parsed = P.period_of(source)
    else:
        parsed = P.date_of(source)
    in_range = F.year(got).between(spec.min_year, spec.max_year)
    bad = (raw.isNotNull() & got.isNull()) | bad_year(got, spec.min_year, spec.max_year)
    return Rule(meta, parsed, bad, F.when(in_range, got).cast(meta.spark_type))


def default_value(meta: ColumnMeta) -> Column:
    """Literal default of a column in its type; null when there is none or it is an expression."""
    literal = P.parse_default_literal(F.lit(meta.column_default))
    return literal["value"].try_cast(meta.spark_type)


def validate(
    df: DataFrame,
    spec: LoadSpec,
    keep: Sequence[str] = (),
    raw_as: str = "raw",
    absent: Mapping[str, Column] | None = None,
    carry: Sequence[str] = (),
    plain: Mapping[str, Column] | None = None,
    all_raw: bool = True,
) -> DataFrame:
    """Rows with typed inputs, the raw inputs as a struct, and the error text.

    `df` holds the cleaned input columns of the spec as text plus the columns named in `keep`.
    `absent` tells, per input, whether the source lacks that column (and its literal default
    applies); columns in `carry` are there for such conditions only. `plain` holds, per input, values
    that are known already, null where the text is still to be parsed. Without `all_raw`, rows
    without errors come with a null struct.
    """
    rules = [compile_rule(m, spec) for m in spec.inputs]
    names = [m.name for m in spec.inputs]
    known = plain or {}
    values = {r.meta.name: r.parsed if r.meta.name not in known else F.coalesce(known[r.meta.name], r.parsed) for r in rules if r.parsed is not None}
    parsed = df.select(*keep, *carry, *names, *[v.alias(PARSED + n) for n, v in values.items()])
    checks = [(r.meta.name, r.flag) for r in rules if r.flag is not None]
    values = {r.meta.name: r.value for r in rules}
    for start, end, name in spec.date_order_rules:
        if start in values and end in values:
            checks.append((name, bad_order(values[start], values[end])))
    for meta in spec.inputs:
        gone = (absent or {}).get(meta.name)
        if gone is not None and meta.column_default:
            values[meta.name] = F.when(gone, default_value(meta)).otherwise(values[meta.name])
    typed = [
        (null_to_false(v) if n in spec.false_when_null else v).alias(n) for n, v in values.items()
    ]
    raw = F.struct(*[F.col(n) for n in names])
    if all_raw:
        return parsed.select(*keep, raw.alias(raw_as), *typed, error_text(checks).alias(ERRORS_COLUMN))
    # the text comes first, so that good rows need no struct at all
    told = parsed.select("*", error_text(checks).alias(TOLD))
    bad = F.col(TOLD) != ""
    return told.select(*keep, F.when(bad, raw).alias(raw_as), *typed, F.col(TOLD).alias(ERRORS_COLUMN))


def reasons(spec: LoadSpec) -> list[str]:
    """Every reason a load by this spec can give, in check order."""
    names = [m.name for m in spec.inputs if m.family != "text"]
    have = {m.name for m in spec.inputs}
    names += [n for s, e, n in spec.date_order_rules if s in have and e in have]
    return [n.replace("error_", "") for n in names]


def valid_rows(staged: DataFrame, raw_as: str = "raw") -> DataFrame:
    names = [c for c in staged.columns if c not in (raw_as, ERRORS_COLUMN)]
    return keep_rows(staged, F.col(ERRORS_COLUMN) == "", [F.col(c) for c in names])


def reject_rows(staged: DataFrame, spec: LoadSpec, keep: Sequence[str] = (), raw_as: str = "raw") -> DataFrame:
    """Rejected rows as they came, cleaned but not typed, with their reasons."""
    raw = [F.col(f"{raw_as}.{m.name}").alias(m.name) for m in spec.inputs]
    columns = [*[F.col(c) for c in keep], *raw, F.col(ERRORS_COLUMN)]
    return keep_rows(staged, F.col(ERRORS_COLUMN) != "", columns)


def annotate(staged: DataFrame, spec: LoadSpec, keep: Sequence[str] = (), raw_as: str = "raw") -> DataFrame:
    """All rows as they came, with their reasons or an empty text."""
    raw = [F.col(f"{raw_as}.{m.name}").alias(m.name) for m in spec.inputs]
    return staged.select(*keep, *raw, ERRORS_COLUMN)


def annotate_source(source: DataFrame, messages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Write messages held elsewhere back to their source rows; old messages are replaced.

    The keys name one row each, so the join has no hot key.
    """
    kept = source.drop(*[c for c in source.columns if c.strip().lower() == ERRORS_COLUMN])
    found = messages.select(*keys, strip(F.col(ERRORS_COLUMN)).alias(ERRORS_COLUMN))
    return kept.join(found, list(keys), "left").withColumn(
        ERRORS_COLUMN, F.coalesce(F.col(ERRORS_COLUMN), F.lit(""))
    )
