"""Session settings and the shared folder used for staged data."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings that matter for wide, text-heavy loads. A fused stage over dozens of text columns grows
# into methods the JVM never compiles to machine code (over 8,000 bytes); such stages run faster as
# separate projections, whose expressions are split into small methods. Measured on 74 text columns:
# 40 fields / 8,000 bytes ran twice as fast as 400 / 65,535.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.maxFields": "40",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a staged load writes two partitions per task; open writers for both spare the sort
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # folders are listed by so many tasks at most, where Spark's own setting starts one for each of up to 10,000
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


# Fixed when the session starts: call-site capture doubles the time to build wide plans.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(master: str | None = None, app_name: str = "loadsieve", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **STATIC_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names in spark.checkpoint.dir.

    Only a local session (a test) may go without that setting; it gets a temporary folder that is removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _local_dir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@functools.cache
def _local_dir() -> str:
    made = tempfile.mkdtemp(prefix="loadsieve-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return made


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there.

    For small tables that several later steps read (previews, header rows, mappings); without it
    every step would scan the source files again.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a frame whose size the planner knows, so that joins with it need
    no shuffle of the other side."""
    kinds = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    arrow = to_arrow_schema(kinds)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), kinds)
