"""Target catalogue: as Spark sees it, and as plain description tables.

Description tables follow the information-schema columns of the target database.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.plans.spec import ColumnMeta, LoadSpec

# Schemas the target database keeps for itself (names, and LIKE patterns).
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog", "pg_toast")
TEMP_SCHEMA_PATTERNS = ("pg_temp_%", "pg_toast_temp_%")


def read_column_meta(columns: DataFrame) -> DataFrame:
    """information-schema columns as column descriptions."""
    return columns.select(
        "table_schema",
        "table_name",
        F.col("ordinal_position").alias("ordinal"),
        F.col("column_name").alias("name"),
        "data_type",
        (F.col("is_nullable") == "YES").alias("is_nullable"),
        "column_default",
        (F.coalesce("is_identity", F.lit("NO")) == "YES").alias("is_identity"),
        (F.coalesce("is_generated", F.lit("NEVER")) != "NEVER").alias("is_generated"),
    )


def is_insertable() -> Column:
    """Neither identity nor generated, and not fed by a sequence."""
    fed = F.coalesce(F.col("column_default").contains("nextval("), F.lit(False))
    return ~(F.col("is_identity") | F.col("is_generated") | fed)


def insertable_columns(meta: DataFrame) -> DataFrame:
    return meta.filter(is_insertable())


def user_schemas(schemas: DataFrame) -> DataFrame:
    """Schemas people use, without the system's own and temporary ones."""
    name = F.col("table_schema")
    keep = ~name.isin(*SYSTEM_SCHEMAS)
    for pattern in TEMP_SCHEMA_PATTERNS:
        keep = keep & ~name.like(pattern)
    return schemas.filter(keep)


def base_tables(tables: DataFrame) -> DataFrame:
    """Base tables of user schemas; one row per table."""
    return user_schemas(tables).filter(F.col("table_type") == "BASE TABLE").select("table_schema", "table_name")


def spec_from_meta(meta: DataFrame, schema: str, table: str, **rules) -> LoadSpec:
    """Spec of one target table from a description table; at most a table's width of rows."""
    one = meta.filter((F.col("table_schema") == schema) & (F.col("table_name") == table)).orderBy("ordinal")
    columns = tuple(
        ColumnMeta(r["name"], r["data_type"], r["is_nullable"], r["column_default"], r["is_identity"], r["is_generated"])
        for r in one.collect()
    )
    if not columns:
        raise ValueError(f"{schema}.{table}: no columns found")
    return LoadSpec(target=f"{schema}.{table}", columns=columns, **rules)


def spec_from_catalog(spark: SparkSession, table: str, **rules) -> LoadSpec:
    """Spec of a table in Spark's own catalogue."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"{table}: table not found")
    return LoadSpec.from_table(spark.table(table), table, **rules)


def list_schemas(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases())


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    if not spark.catalog.databaseExists(schema):
        raise ValueError(f"{schema}: schema not found")
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary and t.tableType != "VIEW")


def schema_exists(spark: SparkSession, schema: str) -> bool:
    return spark.catalog.databaseExists(schema)


def table_exists(spark: SparkSession, schema: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{schema}.{table}")
