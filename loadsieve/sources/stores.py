"""Append-only stores: mapping rules, header positions and the load ledger.

Each is a Parquet folder of versioned rows; the current state is the latest version per key,
found with max_by so that a key with many versions is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.sources.sinks import read_or_empty

RULES = "target_table STRING, raw_header STRING, target STRING, version BIGINT"
HEADER_ROWS = "target_table STRING, file STRING, header_row INT, version BIGINT"
LEDGER = (
    "load_id STRING, parent_load_id STRING, source STRING, rows_read BIGINT, rows_valid BIGINT, "
    "rows_invalid BIGINT, event STRING, version BIGINT"
)

# Approved near repeats; a row without a header stands for each saved set, so that an empty one is known.
APPROVALS = "target_table STRING, raw_header STRING, target STRING, version BIGINT"

# Event names of the ledger.
LOADED, RETRY_OPEN, RETRY_DONE = "loaded", "retry_open", "retry_done"


def read_store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_or_empty(spark, path, schema)


def append_store(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def latest_header_rows(store: DataFrame) -> DataFrame:
    """Current header row per target table and file."""
    return store.groupBy("target_table", "file").agg(F.max_by("header_row", "version").alias("header_row"))


def latest_approvals(store: DataFrame) -> DataFrame:
    """The near repeats that were approved last for each target table."""
    last = store.groupBy("target_table").agg(F.max("version").alias("version"))
    return store.join(last, ["target_table", "version"], "left_semi").where(F.col("raw_header") != "").select("target_table", "raw_header", "target")


def latest_events(ledger: DataFrame) -> DataFrame:
    """Last event per load with the fields it carried."""
    fields = [f for f in ledger.columns if f not in ("load_id", "version")]
    last = F.max_by(F.struct(*fields, "version"), "version").alias("last")
    return ledger.groupBy("load_id").agg(last).select("load_id", "last.*")


def open_retries(ledger: DataFrame) -> DataFrame:
    """Retries that were registered and not completed."""
    return latest_events(ledger).filter(F.col("event") == RETRY_OPEN)
