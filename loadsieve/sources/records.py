"""Delimited text whose quoted cells may hold line breaks, as records with stable numbers.

A line changes one thing that later lines depend on: whether it ends inside a quoted cell. Whether it does may depend on how it began, so a line is a function of that one bit, and so is
a block of lines. One pass over the text gives each file block's function, the number of records that begin in it under either assumption and its first records; the bits at the
blocks' starts then follow from windows over that small table. The second pass knows where records begin, whatever block a task reads.

A record that crosses a block's edge is in two tasks' hands. Such records, one per edge at most, are put together from their parts in a table of their own, which
costs one more read of the text where there are any; all others never leave their task.

A cell that starts with a quote runs to its closing quote, and a doubled quote inside stands for one. What follows the closing quote up to the delimiter belongs to the cell, whose quotes
are then text. A quoted cell that never closes takes the rest of its file. Line breaks inside cells are read as a line feed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadsieve.operators.headers import PREVIEW_ROWS
from loadsieve.session import saved
from loadsieve.sources.grid import literal, scan_lines

#: A block table of so many rows goes to every task (some 150 bytes a row); a longer one is joined by block and the lines are put in order again.
BROADCAST_BLOCKS = 100_000
_TEXT = '[^"]*+(?:""[^"]*+)*+'


def _rest(delimiter: str) -> str:
    d = literal(delimiter)
    return f"[^{d}]*+" if len(delimiter) == 1 else f"(?:(?!{d}).)*+"


def split_records(record: Column, delimiter: str) -> Column:
    """Cells of one record."""
    cell = f'(?s){literal(delimiter)}("{_TEXT}"{_rest(delimiter)}|"{_TEXT}$|{_rest(delimiter)})'
    cells = F.regexp_extract_all(F.concat(F.lit(delimiter), record), F.lit(cell), F.lit(1))
    inner = lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda x: F.when(x.startswith('"') & x.rlike(f'^"{_TEXT}"$'), inner(x)).otherwise(x))


def ends_inside(line: Column, delimiter: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted cell: if it begins outside of one, and if it begins inside."""
    d, rest = literal(delimiter), _rest(delimiter)
    whole = f'(?:"{_TEXT}"{rest}|(?!"){rest})'
    opened = f'"{_TEXT}$'
    from_outside = f"(?s)^(?:{whole}{d})*+{opened}"
    from_inside = f'(?s)^{_TEXT}(?:$|"{rest}(?:{d}{whole})*+{d}{opened})'
    quote = line.contains('"')
    return quote & line.rlike(from_outside), ~quote | line.rlike(from_inside)


def inside_before(outside: np.ndarray, inside: np.ndarray, start: int) -> tuple[np.ndarray, int]:
    """For each line whether it begins inside a cell, and whether the last one ends so. Lines that end alike however they began fix the bit; others keep or turn it."""
    n = len(outside)
    turns = np.cumsum(outside & ~inside)
    fixed = np.maximum.accumulate(np.where(outside == inside, np.arange(n), -1))
    after = np.where(fixed >= 0, outside[fixed] ^ ((turns - turns[fixed]) % 2 == 1), bool(start) ^ (turns % 2 == 1))
    return np.r_[bool(start), after[:-1]] if n else after, int(after[-1]) if n else start


def runs_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Slices of batches that lie in one file block, which comes first."""
    for batch in batches:
        codes = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = batch.column("block").to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist() if len(codes) else []
        for a, b in zip([0, *cuts], [*cuts, len(codes)]):
            if a < b:
                yield (batch.column("file")[a].as_py(), int(starts[a])), batch.slice(a, b - a)


def bits(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("from_outside", "from_inside"))


BLOCKS = "file STRING, block BIGINT, ends_0 INT, ends_1 INT, begun_0 BIGINT, begun_1 BIGINT, heads_0 ARRAY<STRING>, heads_1 ARRAY<STRING>"


def block_functions(batches: Iterator[pa.RecordBatch], head_rows: int) -> Iterator[pa.RecordBatch]:
    """One row per block (BLOCKS): what its lines make of either assumption."""
    key, state, begun, heads = None, [0, 1], [0, 0], [[], []]

    def row() -> pa.RecordBatch:
        texts = [["\n".join(h) for h in hs] for hs in heads]
        values = [[key[0]], [key[1]], [state[0]], [state[1]], [begun[0]], [begun[1]], [texts[0]], [texts[1]]]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    for here, part in runs_of_blocks(batches):
        if here != key:
            if key is not None:
                yield row()
            key, state, begun, heads = here, [0, 1], [0, 0], [[], []]
        lines = part.column("line")
        for s in (0, 1):
            before, state[s] = inside_before(*bits(part), state[s])
            starts = np.flatnonzero(~before)
            begun[s] += len(starts)
            # the lines that go on with the last head so far, then new ones
            first = int(starts[0]) if len(starts) else part.num_rows
            if heads[s] and len(heads[s]) == begun[s] - len(starts):
                heads[s][-1] += lines.slice(0, first).to_pylist()
            wanted = starts[: max(0, head_rows - len(heads[s]))].tolist()
            for a, b in zip(wanted, [*starts[1:].tolist(), part.num_rows]):
                heads[s].append(lines.slice(a, b - a).to_pylist())
    if key is not None:
        yield row()


def joined_records(batches: Iterator[pa.RecordBatch], extra: Sequence[str], crossing: bool) -> Iterator[pa.RecordBatch]:
    """Records of blocks whose start is known: whole ones, or the parts of those that cross an edge (with their block)."""
    held: dict = {}
    names = ["file", "row_no", "block", "line"] if crossing else ["file", "row_no", "line", *extra]

    def emit(rows: pa.RecordBatch, numbers: list[int], texts: list[str]) -> pa.RecordBatch:
        values = {"row_no": pa.array(numbers, pa.int64()), "line": pa.array(texts, pa.string())}
        return pa.RecordBatch.from_arrays([values.get(c, rows.column(c) if c not in values else None) for c in names], names=names)

    def ended(at_edge: bool) -> Iterator[pa.RecordBatch]:
        """The record held so far, which ends here or goes on in the next block."""
        if held.get("lines") and (at_edge or held["cut"]) == crossing:
            yield emit(held["row"], [held["number"]], ["\n".join(held["lines"])])
        held["lines"] = []

    key = None
    for here, part in runs_of_blocks(batches):
        if here != key:
            if key is not None:
                yield from ended(bool(held["goes_on"]))
            key = here
            state, number, goes_on = (part.column(c)[0].as_py() for c in ("starts", "earlier", "goes_on"))
            # what goes on from the block before is the last record that began there
            held = {"state": state, "goes_on": goes_on, "number": number - 1, "lines": [], "cut": bool(state), "row": part.slice(0, 1)}
        outside, inside = bits(part)
        before, held["state"] = inside_before(outside, inside, held["state"])
        lines = part.column("line")
        starts = np.flatnonzero(~before)
        first = int(starts[0]) if len(starts) else part.num_rows
        held["lines"] += lines.slice(0, first).to_pylist()
        if not len(starts):
            continue
        yield from ended(False)
        ends = np.r_[starts[1:], part.num_rows]
        number = held["number"] + 1
        # all but the last are whole; most are single lines and pass as they are
        if not crossing and len(starts) > 1:
            rows = pa.array(starts[:-1])
            texts = lines.take(rows).to_pylist()
            for i in np.flatnonzero(ends[:-1] - starts[:-1] > 1).tolist():
                texts[i] = "\n".join(lines.slice(int(starts[i]), int(ends[i] - starts[i])).to_pylist())
            yield emit(pa.RecordBatch.from_arrays([c.take(rows) for c in part.columns], names=part.schema.names), list(range(number, number + len(rows))), texts)
        last = int(starts[-1])
        held |= {"number": number + len(starts) - 1, "lines": lines.slice(last).to_pylist(), "cut": False, "row": part.slice(last, 1)}
    if key is not None:
        yield from ended(bool(held["goes_on"]))


@dataclass(frozen=True)
class Records:
    """Text files as records: the lines with what they do to the quoting, the placed blocks, and the records that cross an edge."""

    lines: DataFrame
    blocks: DataFrame
    crossing: DataFrame | None

    def preview(self, rows: int = PREVIEW_ROWS) -> DataFrame:
        """First records of each file: file, row_no, line."""
        heads = self.blocks.where(F.col("earlier") < rows).select("file", "earlier", F.posexplode("heads").alias("at", "line"))
        found = heads.select("file", (F.col("earlier") + F.col("at")).alias("row_no"), "line").where(F.col("row_no") < rows)
        if self.crossing is None:
            return found
        whole = self.crossing.withColumnRenamed("line", "whole")
        return found.join(whole, ["file", "row_no"], "left").select("file", "row_no", F.coalesce("whole", "line").alias("line"))

    def numbered(self, per_file: DataFrame | None = None, extra: Sequence[str] = ()) -> DataFrame:
        """file, row_no, line and the columns `extra` of per_file (one row per file)."""
        placed = self.blocks.drop("heads")
        if per_file is not None:
            placed = saved(placed.join(per_file.select("file", *extra), "file"), "placed-blocks")
        whole = _joined(self.lines, placed, extra, False)
        if self.crossing is None:
            return whole
        more = self.crossing if per_file is None else self.crossing.join(per_file.select("file", *extra), "file")
        return whole.unionByName(more.select("file", "row_no", "line", *extra))


def _joined(lines: DataFrame, placed: DataFrame, extra: Sequence[str], crossing: bool, limit: int = BROADCAST_BLOCKS) -> DataFrame:
    if placed.limit(limit + 1).count() <= limit:
        both = lines.join(F.broadcast(placed), ["file", "block"])
    else:
        both = lines.join(placed, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "pos")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    names = "file STRING, row_no BIGINT, " + ("block BIGINT, line STRING" if crossing else ", ".join(["line STRING", *(f"`{c}` {kinds[c]}" for c in extra)]))
    return both.mapInArrow(lambda batches: joined_records(batches, extra, crossing), names)


def scan_records(spark: SparkSession, path: str | Sequence[str], delimiter: str = "|", head_rows: int = PREVIEW_ROWS) -> Records:
    """Read text files as records; head_rows of each block's first ones are kept for previews."""
    raw = scan_lines(spark, path)
    outside, inside = ends_inside(F.col("line"), delimiter)
    lines = raw.select("file", "block", "pos", "line", outside.alias("from_outside"), inside.alias("from_inside"))
    table = saved(lines.select("file", "block", "line", "from_outside", "from_inside").mapInArrow(lambda b: block_functions(b, head_rows), BLOCKS), "record-blocks")
    in_order = W.partitionBy("file").orderBy("block")
    so_far, earlier = in_order.rowsBetween(W.unboundedPreceding, 0), in_order.rowsBetween(W.unboundedPreceding, -1)
    turns = F.sum(((F.col("ends_0") == 1) & (F.col("ends_1") == 0)).cast("int"))
    fixed = F.when(F.col("ends_0") == F.col("ends_1"), F.struct("ends_0", F.col("turns").alias("at")))
    known = table.withColumn("turns", turns.over(so_far)).withColumn("before", F.coalesce(turns.over(earlier), F.lit(0)))
    known = known.withColumn("fixed", F.last(fixed, ignorenulls=True).over(earlier))
    bit = F.when(F.col("fixed").isNull(), F.col("before") % 2).otherwise((F.col("fixed.ends_0") + F.col("before") - F.col("fixed.at")) % 2)
    known = known.withColumn("starts", bit.cast("int"))
    inside_now = F.col("starts") == 1
    begun = F.when(inside_now, F.col("begun_1")).otherwise(F.col("begun_0"))
    blocks = saved(
        known.select(
            "file",
            "block",
            "starts",
            F.coalesce(F.lead("starts").over(in_order), F.lit(0)).alias("goes_on"),
            F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("earlier"),
            F.when(inside_now, F.col("heads_1")).otherwise(F.col("heads_0")).alias("heads"),
        ),
        "placed-record-blocks",
    )
    if blocks.where(inside_now).isEmpty():
        return Records(lines, blocks, None)
    parts = _joined(lines, blocks.drop("heads"), (), True)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("block", "line"))), lambda p: p["line"])
    return Records(lines, blocks, saved(parts.groupBy("file", "row_no").agg(F.array_join(ordered, "\n").alias("line")), "crossing-records"))
