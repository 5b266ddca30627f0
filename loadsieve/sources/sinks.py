"""Sinks: append, overwrite and delete-where loads into Parquet targets.

A load owns one partition folder (load_id=...) of a target and always writes it whole, empty or
not: a job that is repeated, with the same rows or others, leaves exactly its last outcome, and
a target without rows still has a file that tells its schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.session import small_frame


def load_folder(spark: SparkSession, path: str, load_id: str) -> str:
    """The partition folder of a load, named as Spark names it."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(load_id)
    return f"{path.rstrip('/')}/load_id={escaped}"


def write_load(df: DataFrame, path: str, load_id: str, columns: Sequence[str] | None = None) -> None:
    """Write one load as its own partition, in place of what the same load wrote before."""
    chosen = df.select(*columns) if columns else df
    chosen.write.mode("overwrite").parquet(load_folder(df.sparkSession, path, load_id))


def drop_other_loads(spark: SparkSession, path: str, load_id: str) -> None:
    """Take the other loads' partitions away. A repeat after a failure in between gives the same target."""
    own = load_folder(spark, path, load_id).rsplit("/", 1)[1]
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        if entry.getPath().getName() != own:
            files.delete(entry.getPath(), True)


def write_overwrite(df: DataFrame, path: str, load_id: str, columns: Sequence[str] | None = None) -> None:
    """Truncate and load: the new partition first, then the others go."""
    write_load(df, path, load_id, columns)
    drop_other_loads(df.sparkSession, path, load_id)


def write_replace_where(
    df: DataFrame, spark: SparkSession, current: str, new_path: str, condition: Column, load_id: str
) -> None:
    """Delete-where and load into a new path: the current table, if there is one, without the matching
    rows plus the new rows. A null condition keeps the row, as a delete would."""
    fresh = df.withColumn("load_id", F.lit(load_id))
    try:
        old = spark.read.parquet(current)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = fresh.limit(0)
    old = old.filter(~F.coalesce(condition, F.lit(False)) & (F.col("load_id") != load_id))
    old.unionByName(fresh, allowMissingColumns=True).write.mode("overwrite").partitionBy("load_id").parquet(new_path)


class InPlace:
    """The outputs of a load that is no transaction: each is its own folder, in place of what the same load wrote before."""

    def __init__(self, spark: SparkSession, load_id: str) -> None:
        self.spark, self.load_id = spark, load_id

    def write(self, df: DataFrame, base: str, tbl: str, partition_by: Sequence[str] = ()) -> str:
        folder = load_folder(self.spark, base, self.load_id)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
        return folder

    def truncate(self, base: str, tbl: str) -> None:
        drop_other_loads(self.spark, base, self.load_id)


def append_jdbc(df: DataFrame, url: str, table: str, columns: Sequence[str], batch_size: int = 1000, **options: str) -> None:
    """Append over JDBC. Each task commits on its own, so hand over staged, finished rows only."""
    writer = df.select(*columns).write.mode("append").format("jdbc")
    writer.option("url", url).option("dbtable", table).option("batchsize", batch_size).options(**options).save()


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stored table, or an empty one when nothing was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return small_frame(spark, [], schema)
