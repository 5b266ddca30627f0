"""Filter interaction audit: what each filter removes, at each step of every order of the filters.

A document's failures are a mask, one bit a filter. Documents are counted into cells (part, mask), at most 2^filters of them a part, and everything after that works on
cells. Every cell is folded over the array of all orders: `transform` goes over the orders and `aggregate` over the steps of one, so that a cell becomes one struct for
each order and step (600 of five filters), weighted with the cell's documents. The structs of a part's cells are added up place by place.

The orders are one constant of the plan (120 strings of five letters), which goes to the executors with it.

Texts are parsed once, into rows of a mask and a hash of the text. Later copies are found by grouping alone: rows of one (text, part, labels) are reduced before they move, then
the few rows of a text share its smallest doc_id. So a text that a third of all documents have costs no task more than its share.

Null texts count as empty, empty texts are copies of each other, and null languages make the part ''. A null doc_id is neither smaller nor larger than any other: such a
document is never a later copy and has no labels. Rows of one doc_id and text are each counted, and neither is a later copy of the other. Labels of one doc_id are joined by
"or". Very long texts are counted whole. Empty tables give no rows. Columns other than those named are not read, so their names may clash with anything.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadsieve.llm.common import table
from loadsieve.session import saved

#: Fixed values of the query's five filters; E is the later copy.
COPY = "E"
SEPARATOR = r"[\x20\x09-\x0D]"


def word_filters(text: Column) -> dict[str, Column]:
    """The failures that a text alone decides, by filter letter."""
    words = F.array_remove(F.split(text, SEPARATOR), "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def bit(filters: str, letter: str) -> int:
    return 1 << filters.index(letter)


def marked(docs: DataFrame, failures: Mapping[str, Column], filters: str, part: str = "lang", text: str = "text") -> DataFrame:
    """doc_id, part, mask of the given failures, and a hash of the text."""
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    mask = sum((F.when(failed, bit(filters, letter)).otherwise(0) for letter, failed in failures.items()), F.lit(0))
    return docs.select("doc_id", F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"), mask.alias("mask"), F.unhex(F.sha2(raw, 256)).alias("content"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with good and toxic; rows without a doc_id don't meet in the join."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.bool_or(F.col(c) == 1).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    joined = rows.where("doc_id IS NOT NULL").join(known, "doc_id", "left")
    bare = rows.where("doc_id IS NULL").withColumns({c: F.lit(False) for c in ("good", "toxic")})
    return joined.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")}).unionByName(bare)


def cells(rows: DataFrame, copy_bit: int) -> DataFrame:
    """part, mask, n, n_good, n_toxic, with copy_bit set for later copies. rows: doc_id, part, mask, content, good, toxic."""
    kind = ["content", "part", "mask", "good", "toxic"]
    counted = rows.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    few = counted.groupBy(*kind).agg(
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n"))), F.lit(0)).alias("n_known"),
    )
    # a text has one row here for each part and pair of labels
    first = F.min("first").over(Window.partitionBy("content"))
    late = F.col("n_known") - F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    split = few.withColumn("least", first).withColumn("late", late)
    both = F.array(F.struct((F.col("mask") + copy_bit).alias("mask"), F.col("late").alias("n")), F.struct("mask", (F.col("n") - F.col("late")).alias("n")))
    one = split.select("part", "good", "toxic", F.explode(both).alias("cell")).select("part", "good", "toxic", "cell.*").where("n > 0")
    sums = [F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(f"n_{c}") for c in ("good", "toxic")]
    return one.groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums)


#: A cell at one step of one order: has an earlier filter removed its documents, and does this one fail them?
STEP = """named_struct(
    'filter_order', o, 'step', s,
    'kept', IF(seen.gone OR {fails}, 0L, n),
    'removed', IF(NOT seen.gone AND {fails}, n, 0L),
    'redundant', IF(seen.gone AND {fails}, n, 0L),
    'unique_fails', IF({fails} AND bit_count(mask) = 1, n, 0L),
    'good_lost', IF(NOT seen.gone AND {fails}, n_good, 0L),
    'toxic_lost', IF(NOT seen.gone AND {fails}, n_toxic, 0L))"""
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def folded(found: DataFrame, filters: str) -> DataFrame:
    """cells with `steps`: a weighted struct for each order and step, in the order of the constant array."""
    orders = ",".join(map("".join, permutations(filters)))
    fails = f"getbit(mask, locate(substr(o, s, 1), '{filters}') - 1) = 1"
    step = STEP.format(fails=fails)
    kinds = ", ".join(["filter_order: string", "step: int", *(f"{m}: bigint" for m in MEASURES)])
    fold = f"""flatten(transform(split('{orders}', ','), o -> aggregate(
        sequence(1, {len(filters)}),
        named_struct('gone', false, 'steps', CAST(array() AS array<struct<{kinds}>>)),
        (seen, s) -> named_struct('gone', seen.gone OR {fails}, 'steps', concat(seen.steps, array({step}))),
        seen -> seen.steps)))"""
    return found.withColumn("steps", F.expr(fold))


def interactions(found: DataFrame, filters: str) -> DataFrame:
    """One row per part, order and step: counts of documents, and the removals of the step's filter over all orders (shapley).

    found: part, mask (bit i: filter i of `filters` fails), n, n_good, n_toxic. filters: distinct letters; their orders are enumerated, so six are the most.
    """
    if factorial(len(filters)) > 720 or len(set(filters)) < len(filters) or not filters.isalpha():
        raise ValueError("filters must be one to six distinct letters")
    places = folded(found, filters).select("part", F.posexplode("steps").alias("place", "at")).select("part", "place", "at.*")
    merged = places.groupBy("part", "place", "filter_order", "step").agg(*[F.sum(m).alias(m) for m in MEASURES])
    own = Window.partitionBy("part", F.expr("substr(filter_order, step, 1)"))
    return merged.withColumn("shapley", F.sum("removed").over(own)).drop("place")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = "ABCD" + COPY
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = saved(marked(docs, word_filters(F.coalesce("text", F.lit(""))), filters), "audit-rows")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return interactions(cells(labelled(rows, labels), bit(filters, COPY)), filters)


AUDIT_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    len(words) < 100 AS a,
    100 * len(list_distinct(words)) < 80 * len(words) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM docs LEFT JOIN known USING (doc_id)),
cell AS (
  SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END
    || CASE WHEN e THEN 'E' ELSE '' END AS failed, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
  FROM failing GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT p.l || q.l || r.l || s.l || u.l AS filter_order FROM letter p, letter q, letter r, letter s, letter u
  WHERE len(list_distinct([p.l, q.l, r.l, s.l, u.l])) = 5),
steps AS (
  SELECT filter_order, step, filter_order[step] AS filter, filter_order[1:step - 1] AS earlier FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
met AS (
  SELECT *, contains(failed, filter) AS fails, len(list_intersect(string_split(failed, ''), string_split(earlier, ''))) > 0 AND failed <> '' AND earlier <> '' AS gone
  FROM cell, steps),
sums AS (
  SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND fails), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE failed = filter), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley
FROM sums
"""
