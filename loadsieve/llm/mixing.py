"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is r times its size takes every document floor(r) times, and once more with chance p = r - floor(r). The chances are rounded together:
two documents meet, and word mass is moved from one to the other, at random in either direction, until one of them is taken or left; the other goes on with what remains.
Words aren't created or lost by a move, and every document keeps its expected number of copies. The documents of a source meet in order of their size, in a reduction tree: blocks of
about LEAF documents of like size, then FAN blocks' remainders at a time, level by level, until one document per source remains, which is rounded to the nearest. So
a source's words miss its target by half a document at most. A level is one grouped fold; a block's size is bounded, whatever the source.

Everything is built-in functions. Draws are hashes of the two documents, so that reruns agree, however the rows are dealt. Rows alike in key, source and size are one
unit of many and are expanded at the end. Documents without words are taken 0 times, of null texts too. The null source is a source, the last. Very long texts are counted whole. Empty tables give empty
results. Other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import table, unused, word_count
from loadsieve.session import saved

LEAF = 24
FAN = 96
MOST = 3.0
SEED = 20_240_607


def source_targets(units: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = MOST) -> DataFrame:
    """sid, source, source_size, target: one row per source (a short table, ordered as a whole).

    Sources share the sum of all sizes by weight, none above most times its own; the excess goes to the others by weight. At the end there is one level of words per
    weight: sources are capped in order of cap / weight, and the level follows from those that aren't.
    """
    sums = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    ordered = sums.selectExpr("*", "row_number() OVER (ORDER BY source ASC NULLS LAST) AS sid").withColumn("weight", weight)
    ordered = saved(ordered.withColumn("cap", F.col("source_size") * most), "sources")
    by_cap = "ORDER BY cap / weight, sid"
    levels = ordered.selectExpr(
        "*",
        "sum(source_size) OVER () AS total",
        f"sum(cap) OVER ({by_cap}) - cap AS capped_before",
        f"sum(weight) OVER ({by_cap} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left",
    ).withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
    free = F.when(F.col("cap") / F.col("weight") > F.col("level"), F.struct((F.col("cap") / F.col("weight")).alias("o"), "sid", "level"))
    level = levels.agg(F.coalesce(F.min(free)["level"], F.lit(float("inf"))).alias("level"))
    return ordered.join(F.broadcast(level)).select("sid", "source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) that follows from the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / float(1 << 53)


def folded(members: Column, level: int) -> Column:
    """Members (size, hash, unit, chance) of a block, in their order, met one after the other (the largest first, so that small ones remain): what is decided, and the one that remains."""

    def meet(state: Column, new: Column) -> Column:
        old = state["rest"]
        a, b = old["size"].cast("double"), new["size"].cast("double")
        gain, loss = (1 - old["chance"]) * a, old["chance"] * a  # words that the old one can win or lose
        up, down = F.least(gain, new["chance"] * b), F.least(loss, (1 - new["chance"]) * b)
        wins = uniform(F.lit(SEED), F.lit(level), old["hash"], new["hash"], F.size(state["decided"])) * (up + down) < down  # so that nobody's expectation moves
        old_decided = F.when(wins, gain <= new["chance"] * b).otherwise(loss <= (1 - new["chance"]) * b)
        new_left = F.when(wins, new["chance"] - up / b).otherwise(new["chance"] + down / b)
        old_left = F.when(wins, old["chance"] + up / a).otherwise(old["chance"] - down / a)
        decided = F.when(old_decided, F.struct(old["unit"].alias("unit"), wins.alias("more"))).otherwise(F.struct(new["unit"].alias("unit"), (~wins).alias("more")))
        rest = F.when(old_decided, with_chance(new, new_left)).otherwise(with_chance(old, old_left))
        return F.struct(F.concat(state["decided"], F.array(decided)).alias("decided"), rest.alias("rest"))

    def with_chance(member: Column, chance: Column) -> Column:
        return F.struct(member["size"].alias("size"), member["hash"].alias("hash"), member["unit"].alias("unit"), F.greatest(F.least(chance, F.lit(1.0)), F.lit(0.0)).alias("chance"))

    first = F.element_at(members, 1)
    nothing = F.filter(F.transform(members, lambda m: F.struct(m["unit"].alias("unit"), F.lit(True).alias("more"))), lambda _: F.lit(False))
    return F.aggregate(F.slice(members, 2, F.greatest(F.size(members) - 1, F.lit(0))), F.struct(nothing.alias("decided"), first.alias("rest")), meet)


def mix(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = (1, 2, 3), most: float = MOST) -> DataFrame:
    """keys, source, size, source_size, target, copies, taken of every document. docs: keys (what tells documents apart), source, text."""
    sized = docs.select(*keys, "source", word_count(F.col("text")).alias("size"))
    units = saved(sized.groupBy(*keys, "source", "size").agg(F.count("*").alias("rows")), "units")
    sources = saved(source_targets(units, weights, most), "targets")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    known = units.join(sources, units["source"].eqNullSafe(sources["source"])).select(
        *keys, units["source"], "size", "rows", "sid", "source_size", "target", F.floor(ratio).alias("base"), (ratio - F.floor(ratio)).alias("part")
    )
    # of a unit of several rows, the whole part of rows * part is certain
    known = known.withColumn("sure", F.floor(F.col("rows") * F.col("part"))).withColumn("chance", F.col("rows") * F.col("part") - F.col("sure"))
    per_size = known.where("size > 0").groupBy("sid", "size").agg(F.ceil(F.count("*") / F.lit(LEAF)).alias("leaves"))
    per_size = per_size.selectExpr("sid AS s", "size AS z", "leaves", "sum(leaves) OVER (PARTITION BY sid ORDER BY size DESC) - leaves AS before")
    unit = F.struct(*keys, "source", "size", "rows", "source_size", "target", "base", "sure")
    placed = known.where("size > 0").join(per_size, (F.col("sid") == F.col("s")) & (F.col("size") == F.col("z"))).select(
        "sid",
        (F.col("before") + F.pmod(F.xxhash64(F.lit(SEED), *keys), F.col("leaves"))).alias("leaf"),
        F.struct("size", F.xxhash64(*keys).alias("hash"), unit.alias("unit"), "chance").alias("member"),
    )
    last = per_size.agg(F.max(F.col("before") + F.col("leaves"))).first()[0] or 0
    level, decided = 0, []
    while True:
        blocks = placed.groupBy("sid", "leaf").agg(folded(F.sort_array(F.collect_list("member"), asc=False), level).alias("met"))
        blocks = saved(blocks.select("sid", "leaf", "met.decided", "met.rest"), f"mix-level-{level}")
        decided.append(blocks.select(F.explode("decided").alias("d")).select("d.unit", "d.more"))
        if last <= 1:
            break
        placed = blocks.select("sid", F.floor(F.col("leaf") / FAN).alias("leaf"), F.col("rest").alias("member"))
        last, level = -(-last // FAN), level + 1
    decided.append(blocks.select(F.col("rest.unit").alias("unit"), (F.col("rest.chance") >= 0.5).alias("more")))
    without = known.where("size = 0").select(unit.alias("unit"), F.lit(False).alias("more"))
    every = reduce(DataFrame.unionByName, [*decided, without]).select("unit.*", "more")
    one = every.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("n"))
    extra = (F.col("n") <= F.col("sure") + F.col("more").cast("int")).cast("long")
    copies = F.when(F.col("size") > 0, F.col("base") + extra).otherwise(F.lit(0)).cast("long")
    return one.select(*keys, "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = MOST) -> DataFrame:
    """The documents of the mix, each as often as it is taken. Rows alike in doc_id, source and text are one document of so many rows.

    All columns of docs pass, whatever their names."""
    one, two, times = (unused(docs.columns, c) for c in ("one", "two", "times"))
    keyed = docs.withColumn(one, F.xxhash64("doc_id", "source", "text")).withColumn(two, F.xxhash64(F.lit(1), "doc_id", "source", "text"))
    taken = mix(keyed.select(one, two, "doc_id", "source", "text"), (one, two), weights, most).groupBy(one, two).agg(F.sum("copies").alias(times)).where(F.col(times) > 0)
    once = keyed.join(taken, [one, two]).dropDuplicates([one, two])
    every = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))).alias(unused(docs.columns, "copy"))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns], every).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
