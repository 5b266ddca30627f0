"""SimHash near duplicates through a byte-position inverted index.

A fingerprint is eight bytes, each at its position. Fingerprints that differ in at most two bits share at least six positional bytes, so every pair
that has to be found meets in a list keyed by some six positions and the bytes there: 28 lists for each distinct fingerprint. Lists of a single
positional byte would each hold 1/256 of all fingerprints, and pairing those would be quadratic; a list of six fixed bytes holds at most 65,536 distinct
fingerprints, whatever the input. In a list, the shared positional bytes of a pair are tallied, pairs reaching six are kept and their bits
compared. A list hands on only as many links as join its members, not every pair.

Copies are folded into one fingerprint before anything else, so thousands of them cost one row. Null texts and texts without words have fingerprint zero and
are linked like any other. Very long texts are hashed whole. Other columns of the documents may have any name. Null doc_ids are ignored when a group's smallest is taken; a group of nulls only has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import components, small_batches, table, unused
from loadsieve.session import saved

BYTES = 8
SEED = 42


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """One hash for each shingle, repeats too."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z, and only the six white-space characters
    if not words:
        return np.zeros(0, "<u8")
    shingles = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    join, digest = b" ".join, xxhash.xxh64_intdigest
    return np.array([digest(join(s), SEED) for s in shingles], "<u8")


def fingerprint(text: str | None, shingle: int) -> int:
    """A signed 64-bit number."""
    return majority_bits(shingle_hashes(text, shingle))


def majority_bits(hashes: np.ndarray) -> int:
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """The other columns of docs and fp, the signed fingerprint; a column of that name is replaced."""
    rest = [c for c in docs.columns if c != text and c.lower() != "fp"]
    fields = [f for f in docs.schema if f.name in rest]
    schema = docs.select(*[F.col(f"`{c}`") for c in rest], F.lit(0).cast("long").alias("fp")).schema

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            values = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(len(fields))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], values], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`")).mapInArrow(hashed, schema)


def joined_in_list(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join all members of a list which are reachable from each other by pairs of at most max_bits differing bits.

    A breadth-first walk: every member is compared once with all that aren't reached yet.
    """
    links, waiting = [], values
    while len(waiting) > 1:
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            x = queue.pop()
            differing = waiting ^ x
            shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(1)
            near = shared >= BYTES - max_bits
            near[near] = np.bitwise_count(differing[near].view("<u8")) <= max_bits
            found = waiting[near]
            links += [(int(x), int(y)) for y in found]
            queue += list(found)
            waiting = waiting[~near]
    return links


def fingerprint_links(fingerprints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that have the same components as all pairs of at most max_bits differing bits."""
    masks = [sum(0xFF << 8 * p for p in kept) for kept in combinations(range(BYTES), BYTES - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    # few bytes each, but 28 rows each from here on: dealt over all tasks first, which the adaptive planner would not do for so few bytes
    spread = fingerprints.select("fp").repartition(int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    lists = (
        spread.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("which"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(signed)])).alias("key"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
        .where(F.size("fps") > 1)
        .select("fps")
    )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for fps in batch.column(0):
                found += joined_in_list(fps.values.to_numpy().astype("<i8"), max_bits)
                if len(found) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
                    found = []
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return lists.mapInArrow(linked, "a long, b long")


def fingerprint_groups(marked: DataFrame, max_bits: int = 2) -> DataFrame:
    """fp, root of every distinct fingerprint of marked; fingerprints that are reachable from each other share a root."""
    distinct = marked.select("fp").distinct()
    roots = components(fingerprint_links(distinct, max_bits)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, max_bits: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id of the documents that are reachable over near fingerprints."""
    marked = saved(with_fingerprints(docs.select("doc_id", "text"), shingle=shingle), "fingerprints")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    placed = least.join(fingerprint_groups(marked, max_bits), "fp")
    groups = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(placed.join(groups, "root").select("fp", "component_id"), "fp")


def one_per_group(docs: DataFrame, max_bits: int = 2, shingle: int = 3) -> DataFrame:
    """docs with one document of each group: that of the smallest doc_id, nulls last (of several texts with that id, the one of the smallest hash)."""
    key = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"))
    marked = saved(with_fingerprints(docs.select(key.alias("key"), "text"), shingle=shingle), "fingerprints")
    least = marked.groupBy("fp").agg(F.min("key").alias("key"))
    kept = least.join(fingerprint_groups(marked, max_bits), "fp").groupBy("root").agg(F.min("key").alias("key"))
    one, two = (unused(docs.columns, c) for c in ("one", "two"))
    kept = kept.select(F.xxhash64("key").alias(one), F.xxhash64(F.lit(1), "key").alias(two))
    keyed = docs.withColumn(one, F.xxhash64(key)).withColumn(two, F.xxhash64(F.lit(1), key))
    return keyed.join(kept, [one, two], "left_semi").dropDuplicates([one, two]).drop(one, two)


def op7_simhash_byte_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
