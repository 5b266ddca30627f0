"""What the corpus operators share: tables, word counts and linking of equal things."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loadsieve.session import saved

#: A word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: Iterable[str], name: str) -> str:
    """name, with underscores before it until no column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null. One space before every word start, so only those are counted."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))), F.lit(0)).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b) of longs: one row (node, root) per linked node, root the smallest node.

    Alternating large and small stars: every round rewrites the links so that each node hangs on a smaller one,
    until all hang on their root. A round costs two grouped minima and two joins, whose hot side (a star's centre)
    the adaptive planner can split; the minima are reduced before the shuffle. Rounds grow with the logarithm of
    a component's diameter. Every round is written to the shared folder, which cuts the lineage.
    """
    links = saved(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = saved(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
        before = state


def extended(batch: pa.RecordBatch, fields: T.StructType, values: pd.DataFrame) -> pa.RecordBatch:
    """A batch with further columns, for mapInArrow; its own columns pass untouched."""
    schema = to_arrow_schema(fields)
    more = [pa.array(values[f.name].tolist(), f.type) for f in schema]
    return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *schema.names])


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def slices(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    """Runs of texts that reach about so many characters; a longer text ends its run, whole."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
