"""Mapping of source headers to target columns, many feeds in one job.

Frames:
  headers  feed_id, target_table, ordinal, raw_header
  targets  target_table, ordinal, target        (columns open to matching)
  rules    target_table, raw_header, target     (configured or remembered pairs)
  mapping  feed_id, target_table, ordinal, raw_header, snake, target, method, score
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadsieve.functions.parsers import parse_default_literal
from loadsieve.functions.similarity import DEFAULT_THRESHOLD, best_of, best_suggestions
from loadsieve.functions.text import (
    canonical_key,
    canonical_key_v1,
    is_unnamed,
    snake_name,
    strip,
)
from loadsieve.operators.cleaning import keep_rows
from loadsieve.operators.headers import DOT_REPEAT, _dot_name, is_dot_repeat, name_headers
from loadsieve.plans.spec import ColumnMeta
from loadsieve.session import saved, small_frame

# Target of a header that is left out, and the methods that need no review.
IGNORE = "__IGNORAR__"
SURE_METHODS = ("mapping_ini", "config_map", "exact")

def rule_key(raw_header: Column) -> Column:
    """Key of a remembered header: the key its repeat-aware name gets at lookup."""
    t = strip(raw_header)
    return canonical_key(F.when(t.rlike(DOT_REPEAT), _dot_name(t)).otherwise(t))


def rules_by_key(rules: DataFrame) -> DataFrame:
    """Latest target per table and key."""
    version = F.col("version") if "version" in rules.columns else F.lit(0)
    return (
        rules.withColumn("key", rule_key(F.col("raw_header")))
        .groupBy("target_table", "key")
        .agg(F.max_by(strip(F.col("target")), F.struct(version, F.col("raw_header"))).alias("target"))
    )


def merge_rules(store: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert into the store; the latest version of a pair wins.

    Unnamed headers and left-out headers are not remembered. max_by aggregates before the
    shuffle, so a header written over and over costs one row per task.
    """
    cols = ["target_table", "raw_header", "target", "version"]
    fresh = new.filter(~is_unnamed(F.col("raw_header")) & (F.col("target") != IGNORE))
    return (
        store.select(*cols)
        .unionByName(fresh.select(*cols))
        .groupBy("target_table", "raw_header")
        .agg(F.max_by("target", "version").alias("target"), F.max("version").alias("version"))
    )


def target_arrays(targets: DataFrame) -> DataFrame:
    """One row per target table: its columns and their keys in ordinal order, keys distinct."""
    packed = F.sort_array(F.collect_list(F.struct("ordinal", "target")))
    arrays = targets.groupBy("target_table").agg(packed.alias("cols"))
    names = F.transform("cols", lambda x: x["target"])
    keys = F.transform("cols", lambda x: canonical_key(x["target"]))
    arrays = arrays.select("target_table", names.alias("names"), keys.alias("keys"))
    clash = F.size(F.array_distinct("keys")) < F.size("keys")
    fail = F.raise_error(F.concat(F.lit("clashing column names in "), F.col("target_table")))
    return arrays.withColumn("keys", F.when(clash, fail.cast("array<string>")).otherwise(F.col("keys")))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def best_matches(keys: DataFrame, targets: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Best target per (target_table, key) at or above the threshold, first on ties.

    Each distinct key is compared once, inside its row, with the columns of its table: no pair
    of a header and a column ever becomes a row. Keys are spread before they meet the arrays,
    one row per target table in a saved table, which the planner sends to them; the comparison
    is pinned to that place, so no filter or projection can repeat it.
    """
    arrays = saved(target_arrays(targets), "target-arrays")
    # few bytes but much work each: the number of tasks is set, so that the adaptive planner keeps it
    distinct = keys.select("target_table", "key").distinct().repartition(_tasks(keys), "target_table", "key")
    rows = distinct.join(arrays.select("target_table", "keys"), "target_table")
    found = rows.select("target_table", "key", best_of(F.col("key"), F.col("keys"), threshold).alias("best"))
    hits = keep_rows(found, F.col("best.position") >= 0, [F.col("target_table"), F.col("key"), F.col("best")])
    return hits.join(arrays.select("target_table", "names"), "target_table").select(
        "target_table",
        "key",
        F.element_at("names", F.col("best.position") + 1).alias("best_target"),
        F.col("best.ratio").alias("ratio"),
    )


def propose_mapping(
    headers: DataFrame,
    targets: DataFrame,
    configured: DataFrame,
    stored: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Target, method and score for each header of each feed.

    A configured or remembered target is always kept. Any other header takes its exact target,
    else its best match, if it is the first of its feed (in column order) to claim that target;
    otherwise it is left out. "First" is one row_number over feed and claimed target.
    """
    named = name_headers(headers)
    pin = lambda rules, name: rules_by_key(rules).withColumnRenamed("target", name)
    exact = targets.select(
        "target_table", canonical_key(F.col("target")).alias("key"), F.col("target").alias("exact_target")
    )
    on = ["target_table", "key"]
    rows = (
        named.join(pin(configured, "cfg_target"), on, "left")
        .join(pin(stored, "stored_target"), on, "left")
        .join(exact, on, "left")
    )
    pinned = F.coalesce("cfg_target", "stored_target")
    open_keys = named.join(exact, on, "left_anti")
    rows = rows.join(best_matches(open_keys, targets, threshold), on, "left")
    rows = rows.withColumns(
        {"pinned": pinned, "claim": F.coalesce(pinned, "exact_target", "best_target")}
    )
    # a header without a claim forms a group of its own, so the left-out ones never pile up
    claimed = F.when(F.col("claim").isNull() | (F.col("claim") == IGNORE), F.col("ordinal").cast("string"))
    spread = W.partitionBy("feed_id", F.coalesce("claim", F.lit("")), claimed).orderBy("ordinal")
    rows = rows.withColumn("turn", F.row_number().over(spread))

    free = F.col("claim").isNotNull() & (F.col("turn") == 1)
    method = (
        F.when(F.col("cfg_target").isNotNull(), "config_map")
        .when(F.col("stored_target").isNotNull(), "mapping_ini")
        .when(free & F.col("exact_target").isNotNull(), "exact")
        .when(free, "fuzzy")
        .when(is_dot_repeat(F.col("raw_header")), "excel_extra_duplicate")
        .otherwise("excel_extra")
    )
    target = F.when(F.col("pinned").isNotNull() | free, F.col("claim")).otherwise(IGNORE)
    return rows.withColumns({"method": method, "target": target}).select(
        "feed_id",
        "target_table",
        "ordinal",
        "raw_header",
        snake_name(F.col("raw_header")).alias("snake"),
        "target",
        "method",
        F.when(F.col("method").isin(*SURE_METHODS), 1.0)
        .when(F.col("method") == "fuzzy", F.round("ratio", 4))
        .otherwise(0.0)
        .alias("score"),
    )


def _repeat_suffix(name: Column, turn: Column) -> Column:
    return (
        F.when(turn == 1, name)
        .when(turn == 2, F.concat(name, F.lit("__dup")))
        .otherwise(F.concat(name, F.lit("__dup"), turn.cast("string")))
    )


def column_names(mapping: DataFrame) -> DataFrame:
    """Kept headers with the column name each becomes; repeats of a target get a suffix."""
    turn = F.row_number().over(W.partitionBy("feed_id", "target").orderBy("ordinal"))
    kept = mapping.filter(F.col("target") != IGNORE).withColumn("turn", turn)
    return kept.withColumn("column_name", _repeat_suffix(F.col("target"), F.col("turn"))).drop("turn")


def apply_mapping(df: DataFrame, names: list[tuple[str, str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Keep and rename the mapped columns of one feed; `names` are (header, column name) pairs."""
    quoted = [(h.replace("`", "``"), n) for h, n in names]
    return df.select(*keep, *[F.col(f"`{h}`").alias(n) for h, n in quoted])


def alias_mapping(headers: DataFrame, aliases: DataFrame) -> DataFrame:
    """Fixed alias table: the alias of the header's key, else the key; repeats get a suffix."""
    rows = headers.withColumn("key", canonical_key_v1(F.col("raw_header")))
    rows = rows.join(aliases.select("key", "alias"), "key", "left")
    rows = rows.withColumn("mapped", F.coalesce("alias", "key"))
    turn = F.row_number().over(W.partitionBy("feed_id", "mapped").orderBy("ordinal"))
    return rows.withColumn("turn", turn).select(
        "feed_id",
        "ordinal",
        "raw_header",
        _repeat_suffix(F.col("mapped"), F.col("turn")).alias("column_name"),
    )


def alias_proposal(headers: DataFrame, aliases: DataFrame, targets: Sequence[str]) -> DataFrame:
    """A mapping frame from the alias table: headers whose alias is a target column."""
    named = alias_mapping(headers, aliases).select("feed_id", "ordinal", "column_name")
    known = F.col("column_name").isin(*targets)
    return headers.join(named, ["feed_id", "ordinal"]).select(
        "feed_id",
        "target_table",
        "ordinal",
        "raw_header",
        snake_name(F.col("raw_header")).alias("snake"),
        F.when(known, F.col("column_name")).otherwise(IGNORE).alias("target"),
        F.when(known, "config_map").otherwise("excel_extra").alias("method"),
        F.when(known, 1.0).otherwise(0.0).alias("score"),
    )


def auto_confirm(mapping: DataFrame) -> DataFrame:
    """Per feed: may the mapping be used without review?"""
    kept = F.col("target") != IGNORE
    sure = (
        F.col("method").isin(*SURE_METHODS) & ~F.col("snake").contains("__dup") & (F.col("target") != "errores")
    )
    return mapping.groupBy("feed_id").agg(
        (F.bool_or(kept) & F.bool_and(~kept | sure)).alias("auto_confirm")
    )


def low_confidence(mapping: DataFrame) -> DataFrame:
    return mapping.filter((F.col("score") < 1) & (F.col("target") != IGNORE))


def missing_columns(mapping: DataFrame, feeds: DataFrame, targets: DataFrame) -> DataFrame:
    """Target columns no header of a feed maps to: feed_id, target_table, target.

    `feeds` lists feed_id and target_table. The mapped targets of a feed and the columns of a
    table are bounded arrays, so the difference is taken inside one row per feed.
    """
    present = (
        mapping.filter(F.col("target") != IGNORE)
        .groupBy("feed_id")
        .agg(F.collect_set("target").alias("present"))
    )
    # one row per target table, a saved table of known size
    arrays = saved(target_arrays(targets).select("target_table", "names"), "target-names")
    rows = feeds.join(present, "feed_id", "left").join(arrays, "target_table")
    absent = F.array_except("names", F.coalesce("present", F.array().cast("array<string>")))
    return rows.select("feed_id", "target_table", F.explode(absent).alias("target"))


def with_defaults(missing: DataFrame, defaults: DataFrame) -> DataFrame:
    """Missing columns with default_expr, whether it is a literal, and the literal's value.

    `defaults`: target_table, target, column_default; one row per column of the target tables.
    """
    literal = parse_default_literal(F.col("default_expr"))
    rows = missing.join(defaults.withColumnRenamed("column_default", "default_expr"), ["target_table", "target"], "left")
    return rows.select(
        *missing.columns,
        "default_expr",
        literal["kind"].isNotNull().alias("has_literal_default"),
        literal["value"].alias("default_value"),
    )


def missing_plan(missing: DataFrame, columns: Sequence[ColumnMeta]) -> DataFrame:
    """Missing columns of one table with what its catalogue says about their defaults."""
    pairs = [(c.name, c.column_default) for c in columns]
    known = small_frame(missing.sparkSession, pairs, "target STRING, column_default STRING")
    tables = missing.select("target_table").distinct()
    return with_defaults(missing, tables.join(F.broadcast(known)))


def coverage(mapping: DataFrame, missing: DataFrame) -> DataFrame:
    """Per feed: source columns, mapped, left out and missing ones."""
    counts = mapping.groupBy("feed_id").agg(
        F.count("*").alias("source_columns"),
        F.count_if(F.col("target") != IGNORE).alias("mapped"),
        F.count_if(F.col("target") == IGNORE).alias("ignored"),
    )
    gaps = missing.groupBy("feed_id").agg(F.count("*").alias("missing"))
    return counts.join(gaps, "feed_id", "left").withColumn("missing", F.coalesce("missing", F.lit(0)))


def suggest(mapping: DataFrame, missing: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Best left-out header for each missing column, and whether the hint is worth taking.

    A hint is useful at or above the threshold, or when one header and one column are left.
    """
    left_out = (
        mapping.filter(F.col("target") == IGNORE)
        .groupBy("feed_id")
        .agg(F.sort_array(F.collect_list(F.struct("ordinal", "raw_header"))).alias("left_out"))
        .select(
            "feed_id",
            F.transform("left_out", lambda x: x["raw_header"]).alias("left_headers"),
            F.transform("left_out", lambda x: canonical_key(x["raw_header"])).alias("left_keys"),
        )
    )
    gaps = missing.groupBy("feed_id").agg(F.sort_array(F.collect_list("target")).alias("gaps"))
    none = F.array().cast("array<string>")
    rows = gaps.join(left_out, "feed_id", "left").select(
        "feed_id",
        "gaps",
        F.coalesce("left_headers", none).alias("left_headers"),
        F.coalesce("left_keys", none).alias("left_keys"),
    )
    gap_keys = F.transform("gaps", lambda x: canonical_key(x))
    # one comparison per feed: its missing columns against its left-out headers, no copies of either
    rows = rows.repartition(_tasks(mapping), "feed_id").withColumn("best", best_suggestions(gap_keys, F.col("left_keys")))
    only_one = (F.size("left_keys") == 1) & (F.size("gaps") == 1)
    hint = lambda x: F.when(x["position"] >= 0, F.get("left_headers", x["position"]))
    found = F.zip_with("gaps", "best", lambda t, x: F.struct(t.alias("target"), hint(x).alias("header"), x["ratio"].alias("ratio")))
    each = rows.select("feed_id", only_one.alias("only_one"), F.explode(found).alias("s"))
    return each.select(
        "feed_id",
        "s.target",
        F.coalesce("s.header", F.when(~F.col("only_one"), "")).alias("suggested_header"),
        F.round("s.ratio", 4).alias("score"),
        ((F.col("s.ratio") >= threshold) | F.col("only_one")).alias("useful"),
    )


def accept_suggestions(suggestions: DataFrame, target_table: str, version: int) -> DataFrame:
    """Useful hints as rules for merge_rules."""
    header = strip(F.col("suggested_header"))
    return suggestions.filter(F.col("useful") & (F.coalesce(header, F.lit("")) != "")).select(
        F.lit(target_table).alias("target_table"),
        header.alias("raw_header"),
        F.col("target"),
        F.lit(version).cast("bigint").alias("version"),
    )
