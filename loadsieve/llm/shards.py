"""Jump consistent hashing: a row's shard follows from its key and the number of shards alone.

No ring table is kept. Each key draws an increasing chain of jump points from a 64-bit linear congruential generator; the last point below the
number of shards is its shard. Adding a shard can only add a point at the end, so 1 / (n + 1) of the rows move, all into the new shard.

Null keys share one chain. Repeated rows keep a slot each. Null texts count as empty, very long ones are measured whole. An empty table gives an empty result.
Columns may have any name, but `shard` and `grown_shard` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import table, unused
from loadsieve.session import saved

#: Fixed values of the published method: multiplier of the generator, the modulus 2^64, and 2^33 and 2^31 of the jump.
MULTIPLIER = "2862933555777941757"
MODULUS = "18446744073709551616"


def jump_points(key: Column, limit: int) -> Column:
    """The chain's points below limit, in increasing order, from 0.

    Points strictly increase, so limit steps always reach the end; a finished chain is carried on unchanged.
    The product of two 64-bit numbers is taken in decimals of 38 digits, which hold it whole.
    """
    unsigned = key.cast("decimal(20,0)") + F.when(key < 0, F.expr(f"{MODULUS}BD")).otherwise(F.expr("0BD"))
    start = F.struct(
        unsigned.cast("decimal(20,0)").alias("state"),
        F.lit(0).cast("long").alias("next"),
        F.array().cast("array<int>").alias("points"),
    )

    def step(chain: Column, _: Column) -> Column:
        drawn = F.pmod(chain["state"] * F.expr(f"{MULTIPLIER}BD") + F.expr("1BD"), F.expr(f"{MODULUS}BD")).cast("decimal(20,0)")
        share = F.lit(2147483648.0) / (F.floor(drawn / F.expr("8589934592BD")).cast("double") + 1.0)
        moved = F.struct(
            drawn.alias("state"),
            F.floor((chain["next"] + 1).cast("double") * share).cast("long").alias("next"),
            F.concat(chain["points"], F.array(chain["next"].cast("int"))).alias("points"),
        )
        return F.when(chain["next"] < limit, moved).otherwise(chain)

    return F.aggregate(F.sequence(F.lit(1), F.lit(limit)), start, step)["points"]


def with_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Adds shard, and grown_shard: where the row would be with one shard more; columns of these names are replaced, all others pass."""
    at = unused(df.columns, "points")
    points = F.filter(F.col(at), lambda p: p < shards)
    placed = df.withColumn(at, jump_points(F.xxhash64(key), shards + 1))
    return placed.withColumn("shard", F.element_at(points, -1)).withColumn("grown_shard", F.element_at(at, -1)).drop(at)


def with_slots(df: DataFrame, columns: list[str], rows_per_chunk: int = 1000) -> DataFrame:
    """One row per row of df (its shard and columns) with slot, gapless from 0 in each shard.

    A shard holds a large part of all rows, so it isn't numbered as one window: rows are dealt by hash into chunks of about rows_per_chunk,
    chunks get their start from the counts of those before, and only a chunk is sorted. Rows that are alike in all columns are counted first
    and numbered together, so that they may be many.
    """
    alike = ["shard", *columns]
    kept = saved(df.groupBy(*alike).agg(F.count("*").alias("_copies")), "shard-rows")
    total, width = kept.agg(F.coalesce(F.sum("_copies"), F.lit(0)), F.count_distinct("shard")).first()
    chunks = max(1, -(-total // (max(width, 1) * rows_per_chunk)))
    kept = kept.withColumn("_chunk", F.pmod(F.xxhash64(*columns), F.lit(chunks)).cast("int"))
    counts = kept.groupBy("shard", "_chunk").agg(F.sum("_copies").alias("_n"))
    starts = counts.selectExpr("shard", "_chunk", "sum(_n) OVER (PARTITION BY shard ORDER BY _chunk) - _n AS _start")
    order = ", ".join(f"`{c}`" for c in columns)
    ends = kept.join(starts, ["shard", "_chunk"]).selectExpr(
        "*", f"_start + sum(_copies) OVER (PARTITION BY shard, _chunk ORDER BY {order}) AS _end"
    )
    return ends.select(*alike, F.explode(F.sequence(F.col("_end") - F.col("_copies"), F.col("_end") - 1)).alias("slot"))


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """The rows themselves, one folder per shard; each task writes what it has, so no shard is gathered in one task."""
    with_shards(df, key, shards).drop("grown_shard").write.partitionBy("shard").parquet(path)


def op6_jump_shards(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = with_slots(with_shards(docs, "doc_id", shards), ["doc_id", "size", "text_crc32", "grown_shard"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
