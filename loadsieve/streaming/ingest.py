"""Incremental folder intake: each new file is loaded once.

The checkpoint remembers which files were processed, so nothing is moved or renamed. A batch
that runs again after a failure has the same load_id and the same files, and replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loadsieve.plans.load import LoadPaths, load_files, load_rows
from loadsieve.plans.spec import LoadSpec
from loadsieve.sources.grid import number_lines, scan_lines, scan_table


# Fixed value: the schema of Spark's file listing source.
FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def new_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of the paths of new files; their contents are left to the load."""
    reader = spark.readStream.format("binaryFile").schema(FILES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select("path")


def ingest(
    spark: SparkSession,
    folder: str,
    headers: list[str] | None,
    spec: LoadSpec,
    paths: LoadPaths,
    checkpoint: str,
    name: str = "intake",
    delimiter: str = "|",
    max_files: int | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc).replace(tzinfo=None),
    quoted: bool = False,
) -> StreamingQuery:
    """Validated load of every new file in a folder, then stop.

    Each batch is a load from files like any other: header rows are found and headers mapped file
    by file. `headers`, the target names of the cells in order, is for files without a header.
    A row's key is its file and its line there, so it is the same when a batch runs again.
    """

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = sorted(r["path"] for r in batch.collect())  # the names that the batch's plan holds anyway
        if not files:
            return
        load_id = f"{name}-{batch_id}"
        if headers is None:
            load_files(session, files, spec, paths, load_id, clock(), delimiter=delimiter, quoted=quoted)
        else:
            rows = scan_table(number_lines(scan_lines(session, files)), headers, delimiter, quoted)
            load_rows(session, rows, spec, paths, load_id, clock(), source=folder)

    return (
        new_files(spark, folder, max_files)
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(load_batch)
        .start()
    )
