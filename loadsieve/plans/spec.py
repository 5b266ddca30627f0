"""Description of a target table and of one kind of load into it."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loadsieve.functions.similarity import DEFAULT_THRESHOLD
from loadsieve.functions.text import NULL_TOKENS

# Database type names, by the parser that serves them.
DATE_TYPES = ("date",)
TIMESTAMP_TYPES = ("timestamp without time zone", "timestamp with time zone")
INTEGER_TYPES = {"smallint": "smallint", "integer": "int", "bigint": "bigint"}
EXACT_TYPES = ("numeric", "decimal")
FLOAT_TYPES = {"real": "float", "double precision": "double"}
BOOL_TYPES = ("boolean",)

_PRECISE = re.compile(r"^(numeric|decimal)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)$")

_FROM_SPARK = {
    T.DateType: "date",
    T.TimestampNTZType: "timestamp without time zone",
    T.TimestampType: "timestamp with time zone",
    T.ShortType: "smallint",
    T.IntegerType: "integer",
    T.LongType: "bigint",
    T.FloatType: "real",
    T.DoubleType: "double precision",
    T.BooleanType: "boolean",
}


@dataclass(frozen=True)
class ColumnMeta:
    """One column of the target table, as its catalogue describes it."""

    name: str
    data_type: str = "text"
    is_nullable: bool = True
    column_default: str | None = None
    is_identity: bool = False
    is_generated: bool = False

    @property
    def insertable(self) -> bool:
        return not (self.is_identity or self.is_generated or "nextval(" in (self.column_default or ""))

    @property
    def family(self) -> str:
        kind = self.data_type.strip().lower()
        if kind in DATE_TYPES:
            return "date"
        if kind in TIMESTAMP_TYPES:
            return "timestamp"
        if kind in BOOL_TYPES:
            return "boolean"
        if kind in INTEGER_TYPES:
            return "integer"
        if _PRECISE.match(kind):
            return "decimal"
        if kind in EXACT_TYPES or kind in FLOAT_TYPES:
            return "number"
        return "text"

    @property
    def precision(self) -> tuple[int, int]:
        found = _PRECISE.match(self.data_type.strip().lower())
        return int(found.group(2)), int(found.group(3) or 0)

    @property
    def spark_type(self) -> str:
        kind = self.data_type.strip().lower()
        family = self.family
        if family == "integer":
            return INTEGER_TYPES[kind]
        if family == "decimal":
            return "decimal({},{})".format(*self.precision)
        if family == "number":
            return FLOAT_TYPES.get(kind, "double")
        if family == "timestamp":
            return "timestamp" if kind == "timestamp with time zone" else "timestamp_ntz"
        return {"date": "date", "boolean": "boolean"}.get(family, "string")


@dataclass(frozen=True)
class LoadSpec:
    """A target table and the rules of the loads into it."""

    target: str
    columns: tuple[ColumnMeta, ...]
    fixed_values: Mapping[str, object] = field(default_factory=dict)
    column_map: Mapping[str, str] = field(default_factory=dict)
    min_year: int = 1900
    max_year: int = 2100
    unbounded_dates: bool = False
    reject_bare_year: bool = False
    period_columns: tuple[str, ...] = ("periodo",)
    date_order_rules: tuple[tuple[str, str, str], ...] = (
        ("fecha_inicio_proyecto", "fecha_fin_proyecto", "rango_fechas_proyecto"),
    )
    null_tokens: tuple[str, ...] = NULL_TOKENS
    plain_numbers_only: bool = False
    summary_columns: tuple[str, str, str] | None = None
    false_when_null: tuple[str, ...] = ()
    threshold: float = DEFAULT_THRESHOLD
    header_row: int | None = None

    def __post_init__(self) -> None:
        names = [c.name for c in self.columns]
        if not names:
            raise ValueError(f"{self.target}: no columns found")
        if len(set(names)) != len(names):
            raise ValueError(f"{self.target}: repeated column names")
        if "" not in self.null_tokens:
            raise ValueError("the empty text is always a null token")

    @property
    def insertable(self) -> list[ColumnMeta]:
        return [c for c in self.columns if c.insertable]

    @property
    def inputs(self) -> list[ColumnMeta]:
        """Columns expected from the source: insertable and not fixed."""
        return [c for c in self.insertable if c.name not in self.fixed_values]

    @property
    def types(self) -> dict[str, str]:
        return {c.name: c.spark_type for c in self.columns}

    @classmethod
    def from_table(cls, df: DataFrame, target: str, **rules) -> LoadSpec:
        """Spec from a Spark table's schema; defaults come from the field metadata."""
        return cls(target=target, columns=tuple(column_meta(f) for f in df.schema.fields), **rules)


def column_meta(f: T.StructField) -> ColumnMeta:
    meta = f.metadata or {}
    if isinstance(f.dataType, T.DecimalType):
        kind = f"numeric({f.dataType.precision},{f.dataType.scale})"
    else:
        kind = _FROM_SPARK.get(type(f.dataType), "text")
    return ColumnMeta(
        name=f.name,
        data_type=kind,
        is_nullable=f.nullable,
        column_default=meta.get("CURRENT_DEFAULT"),
        is_identity="identity.start" in meta,
        is_generated="GENERATION_EXPRESSION" in meta,
    )
