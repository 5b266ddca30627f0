"""Counts, reasons and load status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsieve.operators.cleaning import ERRORS_COLUMN
from loadsieve.session import saved

# Status marks of a load and the number of reasons shown.
STATUS_OK = "_OK"
STATUS_PARTIAL = "_PARTIAL_ERROR"
TOP_REASONS = 10


def reason_counts(rejects: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per reason, from the error texts; counted per task before the shuffle.

    Rows without errors drop out because exploding null gives no row. A filter would be pushed
    below the projections and make every parser run twice.
    """
    texts = F.when(F.col(ERRORS_COLUMN) != "", F.split(ERRORS_COLUMN, ", "))
    split = rejects.select(*by, F.explode(texts).alias("reason"))
    return split.groupBy(*by, "reason").agg(F.count("*").alias("rows"))


def top_errors(rejects: DataFrame, limit: int = TOP_REASONS) -> DataFrame:
    """Most frequent reasons, by name where counts are equal."""
    return reason_counts(rejects).orderBy(F.col("rows").desc(), "reason").limit(limit)


def error_matrix(staged: DataFrame, reasons: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One flag per reason and whether any is set, read off the error text."""
    hits = F.split(ERRORS_COLUMN, ", ")
    flags = [F.array_contains(hits, r).alias(r) for r in reasons]
    return staged.select(*keep, *flags, (F.col(ERRORS_COLUMN) != "").alias("any_error"))


def summary_columns() -> list[Column]:
    """Rows read, loadable and rejected; usable in agg() and in an Observation."""
    bad = F.col(ERRORS_COLUMN) != ""
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~bad).alias("rows_valid"),
        F.count_if(bad).alias("rows_invalid"),
    ]


def load_summary(staged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return staged.groupBy(*by).agg(*summary_columns())


def status(rows_valid: Column, rows_invalid: Column, first_load: Column) -> Column:
    """Mark of a first load; null when nothing was inserted or the load is a retry."""
    return F.when(
        (rows_valid > 0) & first_load, F.when(rows_invalid > 0, STATUS_PARTIAL).otherwise(STATUS_OK)
    )


def load_status(loads: DataFrame) -> DataFrame:
    """Status per load from its counts; a load with a parent is a retry."""
    first = F.col("parent_load_id").isNull()
    return loads.withColumn("status", status(F.col("rows_valid"), F.col("rows_invalid"), first))


def first_loads(loads: DataFrame, max_rounds: int = 64) -> DataFrame:
    """load_id, first_load_id of every retry: the load at the start of its chain of parents.

    Every round doubles the distance each retry looks up its chain, and is a saved table.
    """
    at = saved(loads.filter(F.col("parent_load_id").isNotNull()).select("load_id", F.col("parent_load_id").alias("up")), "retry-parents")
    for turn in range(max_rounds):
        above = at.select(F.col("load_id").alias("up"), F.col("up").alias("further"))
        if at.join(above, "up", "left_semi").isEmpty():
            return at.withColumnRenamed("up", "first_load_id")
        at = saved(at.join(above, "up", "left").select("load_id", F.coalesce("further", "up").alias("up")), f"retry-parents-{turn}")
    raise ValueError("a load is its own retry")


def retry_status(loads: DataFrame) -> DataFrame:
    """First loads with the status they have after their retries and the retries of those.

    A load is complete when its retries brought in as many rows as it had rejected (a reject is
    brought in once); that turns its partial mark into OK.
    """
    rows_of = first_loads(loads).join(loads.select("load_id", "rows_valid"), "load_id")
    chains = rows_of.groupBy(F.col("first_load_id").alias("load_id")).agg(
        F.count("*").alias("retries"), F.sum("rows_valid").alias("loaded")
    )
    parents = load_status(loads).filter(F.col("parent_load_id").isNull())
    rows = parents.join(chains, "load_id", "left")
    completed = F.coalesce(F.col("loaded") >= F.col("rows_invalid"), F.lit(False))
    final = F.when(completed & (F.col("status") == STATUS_PARTIAL), STATUS_OK).otherwise(F.col("status"))
    return rows.select(
        "load_id",
        F.col("status").alias("first_status"),
        F.coalesce("retries", F.lit(0)).alias("retries"),
        completed.alias("completed"),
        final.alias("status"),
    )
