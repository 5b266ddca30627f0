"""Cleaning, conforming and filling of mapped rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsieve.functions.parsers import storage_number, storage_text
from loadsieve.functions.text import NULL_TOKENS, clean_text, strip

ERRORS_COLUMN = "errores"

# Words that give a trailing summary row away.
SUMMARY_FIRST = ("col", "columna", "column")
SUMMARY_SECOND = ("dato", "cantidad")
SUMMARY_THIRD = ("nulo", "vacio", "vacío")


def clean_columns(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    wanted = set(columns)
    return df.select(*[clean_text(F.col(c), tokens).alias(c) if c in wanted else F.col(c) for c in df.columns])


def drop_control_columns(df: DataFrame, names: Sequence[str] = (ERRORS_COLUMN,)) -> DataFrame:
    """Drop bookkeeping columns, whatever their case or padding."""
    return df.drop(*[c for c in df.columns if c.strip().lower() in names])


def keep_rows(df: DataFrame, condition: Column, columns: Sequence[Column]) -> DataFrame:
    """Columns of the rows that meet the condition, evaluated after the projections of `df`.

    A filter would be pushed below those projections, and every parser the condition depends on
    would be planned and evaluated a second time. Emitting one row or none is not pushed.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))


def drop_empty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.dropna(how="all", subset=present) if present else df


def is_summary_row(first: Column, second: Column, third: Column) -> Column:
    def words(c: Column, any_of: Sequence[str]) -> Column:
        t = F.lower(strip(c))
        hit = F.lit(False)
        for word in any_of:
            hit = hit | F.coalesce(t.contains(word), F.lit(False))
        return hit

    leading = F.coalesce(F.lower(strip(first)).isin(*SUMMARY_FIRST), F.lit(False))
    return leading & words(second, SUMMARY_SECOND) & words(third, SUMMARY_THIRD)


def drop_summary_rows(df: DataFrame, first: str, second: str, third: str) -> DataFrame:
    if not {first, second, third} <= set(df.columns):
        return df
    return df.filter(~is_summary_row(F.col(first), F.col(second), F.col(third)))


def conform(
    df: DataFrame,
    columns: Mapping[str, str],
    keep: Sequence[str] = (),
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One select that keeps, adds and orders the target columns.

    `columns` maps each target column to its Spark type. Absent ones take their literal default,
    else null; columns outside the target are dropped, except those in `keep`.
    """
    defaults = defaults or {}
    have = set(df.columns)
    out = [F.col(c) for c in keep]
    for name, spark_type in columns.items():
        absent = defaults.get(name, F.lit(None)).cast(spark_type).alias(name)
        out.append(F.col(name) if name in have else absent)
    return df.select(*out)


def fixed_value(token: object, load_time: datetime) -> Column:
    """Column for a fixed-value token; every clock token of a load shows the same instant."""
    low = str(token).strip().lower()
    clock = F.lit(load_time.isoformat(sep=" ")).cast("timestamp_ntz")
    special = {
        "__now_ts__": clock,
        "__today__": clock.cast("date"),
        "__true__": F.lit(True),
        "__false__": F.lit(False),
        "__null__": F.lit(None),
    }
    return special.get(low, F.lit(str(token).strip()))


def apply_fixed_values(
    df: DataFrame,
    tokens: Mapping[str, object],
    insertable: Sequence[str],
    load_time: datetime,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Set fixed columns; they win over sheet data and only insertable columns take part."""
    types = types or {}
    values = {}
    for name, token in tokens.items():
        if name in insertable:
            value = fixed_value(token, load_time)
            values[name] = value.cast(types[name]) if name in types else value
    return df.withColumns(values) if values else df


def to_storage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values as they are stored: no NaN or infinity, trimmed text, wrapped numbers unwrapped."""
    kinds = dict(df.dtypes)
    wanted = set(columns)

    def stored(name: str) -> Column:
        c = F.col(name)
        if name in wanted and kinds[name] in ("double", "float"):
            return storage_number(c).alias(name)
        if name in wanted and kinds[name] == "string":
            return storage_text(c).alias(name)
        return c

    return df.select(*[stored(c) for c in df.columns])
