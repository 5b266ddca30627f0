"""Delimited text files as row grids with stable row numbers."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadsieve.operators.headers import PREVIEW_ROWS
from loadsieve.session import saved

def literal(delimiter: str) -> str:
    """The delimiter as a pattern: any text of any length, taken literally."""
    return re.sub(r"([^A-Za-z0-9\s])", r"\\\1", delimiter)


def split_cells(line: Column, delimiter: str = "|") -> Column:
    """Cells of one delimited line without quoting."""
    return F.split(line, literal(delimiter), -1)


def split_quoted(line: Column, delimiter: str = "|") -> Column:
    """Cells of one line whose cells may be quoted; a doubled quote inside stands for one.

    A cell is quoted when its closing quote ends it, else its quotes are text. The same function
    reads headers and data, whatever their width.
    """
    d = literal(delimiter)
    plain = f"[^{d}]*+" if len(delimiter) == 1 else f"(?:(?!{d}).)*+"
    cell = f'(?s){d}("[^"]*+(?:""[^"]*+)*+"(?={d}|$)|{plain})'
    cells = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(cell), F.lit(1))
    closed = lambda x: (F.length(x) > 1) & x.startswith('"') & x.endswith('"')
    inner = lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda x: F.when(closed(x), inner(x)).otherwise(x))


def cells_of(line: Column, delimiter: str = "|", quoted: bool = False) -> Column:
    return split_quoted(line, delimiter) if quoted else split_cells(line, delimiter)


def scan_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of text files with file, file block and a position that grows inside each block."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def scan_blocks(lines: DataFrame, head_rows: int = PREVIEW_ROWS) -> DataFrame:
    """One saved row per file block, from one pass over the lines: file, block, n, first_pos, heads
    (its first lines, head_rows at most) and earlier (lines of the file's blocks before it).

    A block's lines sit next to each other in one task, so a task streams through them and keeps a
    count and a few lines; nothing is sorted or shuffled but the rows of the block table.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, first, heads = None, 0, 0, []

        def row() -> pa.RecordBatch:
            values = ([key[0]], [key[1]], [n], [first], [heads])
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())))],
                names=["file", "block", "n", "first_pos", "heads"],
            )

        for batch in batches:
            files, blocks, positions, text = batch.columns
            codes = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            starts = blocks.to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist() if len(codes) else []
            for a, b in zip([0, *cuts], [*cuts, len(codes)]):
                if a == b:
                    continue
                here = (files[a].as_py(), int(starts[a]))
                if here != key:
                    if key is not None:
                        yield row()
                    key, n, first, heads = here, 0, positions[a].as_py(), []
                n += b - a
                heads += text.slice(a, min(b - a, head_rows - len(heads))).to_pylist()
        if key is not None:
            yield row()

    schema = "file STRING, block BIGINT, n BIGINT, first_pos BIGINT, heads ARRAY<STRING>"
    blocks = lines.select("file", "block", "pos", "line").mapInArrow(counted, schema)
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return saved(blocks.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))), "blocks")


def number_lines(
    lines: DataFrame, blocks: DataFrame | None = None, per_file: DataFrame | None = None, extra: Sequence[str] = ()
) -> DataFrame:
    """Adds row_no, counted from 0 inside each file, without sorting a file in one task.

    A line's place in its block plus the lines of the file's earlier blocks is its row number. A
    file may be split over any number of tasks, and a position outside its block stops the job
    instead of giving a wrong number. `per_file` holds one row per file; its columns `extra` ride along.

    The block table is a saved table of known size, so the planner sends it to the lines while
    it is below spark.sql.autoBroadcastJoinThreshold, and joins by block beyond that.
    """
    placed = (blocks if blocks is not None else scan_blocks(lines, 0)).drop("heads")
    if per_file is not None:
        placed = saved(placed.join(per_file.select("file", *extra), "file"), "placed-blocks")
    offset = F.col("pos") - F.col("first_pos")
    inside = (offset >= 0) & (offset < F.col("n"))
    row_no = F.when(inside, F.col("earlier") + offset).otherwise(
        F.raise_error(F.concat(F.lit("files changed while being read: "), F.col("file"))).cast("bigint")
    )
    return lines.join(placed, ["file", "block"]).select("file", row_no.alias("row_no"), "line", *extra)


def preview(blocks: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """First rows of each file, from the block table: whatever blocks they lie in."""
    heads = blocks.where(F.col("earlier") < rows).select("file", "earlier", F.posexplode("heads").alias("at", "line"))
    return heads.select("file", (F.col("earlier") + F.col("at")).alias("row_no"), "line").where(F.col("row_no") < rows)


def header_cells(preview_rows: DataFrame, header_rows: DataFrame) -> DataFrame:
    """Header frame (feed_id, ordinal, raw_header) taken from each file's header row; the preview
    rows hold an array `cells`.

    Readers name an empty header cell after its position and label a repeated header X.1, X.2.
    """
    at = header_rows.select("file", F.col("header_row").alias("row_no"))
    cells = preview_rows.join(at, ["file", "row_no"], "left_semi").select(
        F.col("file").alias("feed_id"), F.posexplode("cells").alias("at", "cell")
    )
    shown = F.when(F.trim("cell") == "", F.concat(F.lit("Unnamed: "), F.col("at").cast("string"))).otherwise(
        F.col("cell")
    )
    turn = F.row_number().over(W.partitionBy("feed_id", "cell").orderBy("at")) - 1
    return (
        cells.withColumn("cell", shown)
        .withColumn("turn", turn)
        .select(
            "feed_id",
            (F.col("at") + 1).alias("ordinal"),
            F.when(F.col("turn") == 0, F.col("cell"))
            .otherwise(F.concat_ws(".", "cell", F.col("turn").cast("string")))
            .alias("raw_header"),
        )
    )


def scan_table(rows: DataFrame, headers: Sequence[str], delimiter: str = "|", quoted: bool = True) -> DataFrame:
    """Rows of files that share one header list as text columns."""
    cells = rows.select("file", "row_no", cells_of(F.col("line"), delimiter, quoted).alias("__cells"))
    return cells.select("file", "row_no", *[F.get("__cells", F.lit(i)).alias(h) for i, h in enumerate(headers)])


def cells_to_rows(cells: DataFrame) -> DataFrame:
    """Cell table (file, row_no, col_no, value) to one array per row; a row is one sheet wide."""
    packed = F.sort_array(F.collect_list(F.struct("col_no", "value")))
    return cells.groupBy("file", "row_no").agg(F.transform(packed, lambda x: x["value"]).alias("cells"))


def latest_file(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Newest path per group of a file listing (path, modificationTime); the later path on ties."""
    newest = F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    return files.groupBy(*by).agg(newest, F.max("modificationTime").alias("modificationTime"))


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """File listing through the binaryFile source; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "modificationTime")
    )


def pick_file(spark: SparkSession, folder: str, file_name: str | None = None, pattern: str = "*") -> str:
    files = list_files(spark, folder, file_name or pattern)
    found = latest_file(files).first()
    if found is None or found["path"] is None:
        raise FileNotFoundError(f"no file {file_name or pattern} in {folder}")
    return found["path"]
