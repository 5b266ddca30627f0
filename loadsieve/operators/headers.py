"""Header names, repeated headers and header-row detection, many feeds in one job.

Header frames hold one row per source column: feed_id, ordinal (from 1), raw_header. The width
of a feed is that of its file's header line, so a group "per feed" or "per feed and key" is never
larger than one line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadsieve.functions.similarity import DEFAULT_THRESHOLD, best_of_known
from loadsieve.functions.text import canonical_key, canonical_key_py, is_unnamed, safe_text, strip, text_array

# The rows looked at when a header row is searched, the score that ends the search and the score a stored header row must reach.
PREVIEW_ROWS = 25
EARLY_STOP_SCORE = 200.0
HEADER_MIN_SCORE = 10.0

DOT_REPEAT = "^(.*)[.]([0-9]+)$"
NUMBERED = "^(.*?)([0-9]+)$"


def is_dot_repeat(header: Column) -> Column:
    """X.1, X.2, ...: how readers label a repeated header."""
    return strip(header).rlike("[.][0-9]+$")


def _group(t: Column, pattern: str, at: int) -> Column:
    return F.regexp_extract(t, pattern, at)


def _dot_name(t: Column) -> Column:
    number = _group(t, DOT_REPEAT, 2).try_cast("decimal(38,0)") + 1
    return F.concat(strip(_group(t, DOT_REPEAT, 1)), number.cast("decimal(38,0)").cast("string"))


def _with_base(headers: DataFrame) -> DataFrame:
    """Adds `txt`, `base`, `number` and whether the base is itself a header of the feed."""
    t = strip(F.col("raw_header"))
    numbered = t.rlike(NUMBERED) & ~t.rlike(DOT_REPEAT)
    rows = headers.withColumns(
        {
            "txt": t,
            "number": F.when(numbered, _group(t, NUMBERED, 2).try_cast("decimal(38,0)")),
            "base": F.when(numbered, strip(_group(t, NUMBERED, 1))),
        }
    )
    present = headers.select("feed_id", strip(F.col("raw_header")).alias("base"), F.lit(True).alias("base_seen"))
    # aggregating first keeps one row per name, however often a name repeats
    present = present.groupBy("feed_id", "base").agg(F.first("base_seen").alias("base_seen"))
    return rows.join(present, ["feed_id", "base"], "left")


def _numbered_repeat() -> Column:
    return F.coalesce(F.col("base_seen") & (F.col("number") >= 2), F.lit(False))


def name_headers(headers: DataFrame) -> DataFrame:
    """Repeat-aware name of each header and its key.

    X.1 becomes X2; X2 stays when X is also a header; otherwise the n-th header with one key
    takes the suffix n.
    """
    extra = [c for c in headers.columns if c not in ("feed_id", "ordinal", "raw_header")]
    rows = _with_base(headers).withColumn(
        "kind",
        F.when(F.col("txt").rlike("[.][0-9]+$"), 1).when(_numbered_repeat(), 2).otherwise(3),
    )
    rows = rows.withColumn("base_key", canonical_key(F.col("txt")))
    turn = W.partitionBy("feed_id", "base_key", "kind").orderBy("ordinal")
    rows = rows.withColumn("turn", F.row_number().over(turn))
    number = F.col("number").cast("string")
    name = (
        F.when(F.col("kind") == 1, _dot_name(F.col("txt")))
        .when(F.col("kind") == 2, F.concat(F.col("base"), number))
        .when(F.col("turn") == 1, F.col("txt"))
        .otherwise(F.concat(F.col("txt"), F.col("turn").cast("string")))
    )
    named = rows.withColumn("name", name)
    return named.select(
        "feed_id", "ordinal", "raw_header", *extra, "name", canonical_key(F.col("name")).alias("key")
    )


def near_repeats(headers: DataFrame) -> DataFrame:
    """Headers that look like a numbered copy of another one: base key and detected name."""
    rows = _with_base(headers)
    t = F.col("txt")
    dotted = t.rlike(DOT_REPEAT)
    base = F.when(dotted, strip(_group(t, DOT_REPEAT, 1))).otherwise(F.col("base"))
    name = F.when(dotted, _dot_name(t)).otherwise(F.concat(F.col("base"), F.col("number").cast("string")))
    return rows.filter(dotted | _numbered_repeat()).select(
        "feed_id", "ordinal", "raw_header", canonical_key(base).alias("base_key"), name.alias("detected_name")
    )


def near_repeat_report(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Near repeats with the target proposed for each, empty when there is none."""
    proposed = mapping.select("feed_id", "ordinal", "target")
    return (
        near_repeats(headers)
        .join(proposed, ["feed_id", "ordinal"], "left")
        .withColumn("target", F.coalesce(F.col("target"), F.lit("")))
    )


def approvals_changed(current: DataFrame, saved: DataFrame) -> DataFrame:
    """Per target table: does the current set of approved pairs differ from the saved one?

    One aggregation over both sets instead of two set differences.
    """
    cols = ["target_table", "raw_header", "target"]
    both = current.select(*cols, F.lit(True).alias("now"), F.lit(False).alias("before")).unionByName(
        saved.select(*cols, F.lit(False).alias("now"), F.lit(True).alias("before"))
    )
    pairs = both.groupBy(*cols).agg(F.bool_or("now").alias("now"), F.bool_or("before").alias("before"))
    return pairs.groupBy("target_table").agg(F.bool_or(F.col("now") != F.col("before")).alias("changed"))


def score_rows(rows: DataFrame, targets: Sequence[str], threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Score of each row as a header for the target columns.

    `rows` has an array column `cells`; everything else is kept. The score is computed inside
    the row, so no shuffle is needed; only keys without an exact match go to the similarity UDF.
    """
    keys = list(dict.fromkeys(canonical_key_py(t) for t in targets))
    known = text_array(keys)
    texts = F.filter(F.transform(F.col("cells"), safe_text), lambda x: x != "")
    cells = F.transform(texts, lambda x: F.struct(x.alias("text"), canonical_key(x).alias("key")))
    base = rows.withColumns({"__filled": F.size(texts), "__cells": F.filter(cells, lambda x: x["key"] != "")})

    matched = lambda x: F.array_contains(known, x["key"])
    base = base.withColumns(
        {
            "__distinct": F.size(F.array_distinct(F.transform("__cells", lambda x: x["key"]))),
            "__exact": F.size(F.filter("__cells", matched)),
            "__others": F.filter("__cells", lambda x: ~matched(x)),
        }
    )
    other_keys = F.transform("__others", lambda x: x["key"])
    base = base.withColumn("__ratios", best_of_known(other_keys, keys, threshold))

    def worth(cell: Column, best: Column) -> Column:
        letters = F.when(cell["text"].rlike("[a-zA-Z]"), 0.4).otherwise(0.0)
        short = F.when(F.length(cell["text"]) <= 60, 0.2).otherwise(0.0)
        unnamed = F.when(is_unnamed(cell["text"]), 2.0).otherwise(0.0)
        return F.when(best > 0, best + 3.0).otherwise(letters + short) - unnamed

    others = F.aggregate(F.zip_with("__others", "__ratios", worth), F.lit(0.0), lambda a, x: a + x)
    repeats = F.size("__cells") - F.col("__distinct")
    total = (
        (F.col("__distinct") - repeats) * 0.25
        + F.col("__exact") * 6.0
        + others
        + F.least(F.col("__filled"), F.lit(20)) * 0.15
    )
    # rounding keeps the order of summation from deciding a tie
    score = F.when(F.col("__filled") == 0, -1.0).otherwise(F.round(total, 9))
    return base.select(*rows.columns, score.alias("score"))


def detect_header(scored: DataFrame, early_stop: float = EARLY_STOP_SCORE) -> DataFrame:
    """Header row per file: the first at or above the early stop, else the best, first on ties."""
    first = F.min(F.when(F.col("score") >= early_stop, F.col("row_no")))
    best = F.min_by("row_no", F.struct((-F.col("score")).alias("s"), F.col("row_no").alias("r")))
    return scored.groupBy("file").agg(F.coalesce(first, best).alias("header_row"))


def valid_headers(scored: DataFrame, least: float = HEADER_MIN_SCORE) -> DataFrame:
    return scored.filter(F.col("score") >= least)


def resolve_header(
    files: DataFrame, configured: DataFrame, stored: DataFrame, scored: DataFrame, detected: DataFrame
) -> DataFrame:
    """Header row per file: configured, else stored if that row still scores as a header, else
    detected, else the first row.

    `configured` and `stored` count rows from 1 and are keyed by (target_table, file), the rest
    from 0. Each side holds at most one row per key.
    """
    good = valid_headers(scored).select("file", "row_no", F.lit(True).alias("good"))
    kept = (
        stored.select("target_table", "file", (F.col("header_row") - 1).alias("row_no"))
        .join(good, ["file", "row_no"], "left_semi")
        .select("target_table", "file", F.col("row_no").alias("stored_row"))
    )
    asked = configured.select("target_table", "file", (F.col("header_row") - 1).alias("configured_row"))
    found = detected.select("file", F.col("header_row").alias("detected_row"))
    rows = (
        files.join(asked, ["target_table", "file"], "left")
        .join(kept, ["target_table", "file"], "left")
        .join(found, "file", "left")
    )
    origin = (
        F.when(F.col("configured_row").isNotNull(), "configured")
        .when(F.col("stored_row").isNotNull(), "stored")
        .otherwise("detected")
    )
    row = F.coalesce("configured_row", "stored_row", "detected_row", F.lit(0))
    return rows.select("target_table", "file", row.cast("bigint").alias("header_row"), origin.alias("origin"))
