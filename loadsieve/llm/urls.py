"""URL filter by path-template trees.

Every host has a tree of path segments. Segments that are plainly variable (numbers, hashes, dates, long slugs) become wildcards by their shape.
Level by level, branches below a node are compared with all their siblings taken together: a branch whose labelled share and whose shapes of following
segments don't differ from theirs (a two-proportion test, a distance of distributions) is merged with them into one wildcard branch. A page's template
is its way down that tree. A template is rejected when its labelled purity, smoothed towards its host's and that towards the whole table's, is below a threshold.

Labels are a boolean column (true: good, false: bad, null: none). Equal paths of a host are counted once before the tree is built, so a common host or path
costs counts, not rows; every level is a few grouped sums and joins. Segments below the depth limit make up one last wildcard.

Null urls and urls without :// have an empty host and path and share one template. Repeated rows are judged each. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import table
from loadsieve.session import saved

#: The rules (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The longest fitting rule as a struct of rule and verdict, or null. rules: a short, fixed list."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def segment_shape(segment: Column) -> Column:
    """A segment as it enters the tree: a wildcard for what is plainly variable, with its file ending, or the segment."""
    name = F.regexp_extract(segment, r"^(.*?)(\.[A-Za-z]{1,5})?$", 1)
    end = F.lower(F.regexp_extract(segment, r"^(.*?)(\.[A-Za-z]{1,5})?$", 2))
    kind = (
        F.when(name.rlike(r"^\d{4}-\d{2}-\d{2}$"), "{date}")
        .when(name.rlike(r"^\d+$"), "{number}")
        .when(name.rlike(r"^[0-9a-fA-F-]{8,}$") & name.rlike(r"\d"), "{hash}")
        .when(name.rlike(r"^[^-]+(-[^-]+){3,}$"), "{slug}")
        .when(name.rlike(r"\d.*\d.*\d"), "{code}")
    )
    return F.when(kind.isNotNull(), F.concat(kind, end)).otherwise(segment)


def merged_level(paths: DataFrame, level: int, min_z: float, max_distance: float) -> DataFrame:
    """paths with template taken one level further. paths: host, segments, n, good, bad, template."""
    here = F.coalesce(F.get("segments", F.lit(level)), F.lit(""))
    after = F.coalesce(F.get("segments", F.lit(level + 1)), F.lit(""))
    # what the next level looks like: wildcards by their kind, all literal segments alike
    shape = F.when(after.startswith("{"), after).when(after == "", "").otherwise("{literal}")
    node, branch = ["host", "template"], ["host", "template", "segment"]
    at = paths.select(*node, here.alias("segment"), shape.alias("next"), "n", "good", "bad")
    cells = saved(at.groupBy(*branch, "next").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")]), f"url-level-{level}")
    branches = cells.groupBy(*branch).agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    nodes = branches.groupBy(*node).agg(*[F.sum(c).alias(f"node_{c}") for c in ("n", "good", "bad")], F.count("*").alias("width"))
    pooled = cells.groupBy(*node, "next").agg(F.sum("n").alias("node_next"))
    # the distance between a branch's next shapes and its siblings': half the sum of |share - share|; shapes the branch lacks add their siblings' share
    rated = branches.join(nodes, node)
    shares = cells.select(*branch, "next", F.col("n").alias("own")).join(pooled, [*node, "next"]).join(rated, branch)
    siblings = F.greatest(F.col("node_n") - F.col("n"), F.lit(1))
    sibling_share = (F.col("node_next") - F.col("own")) / siblings
    distances = shares.groupBy(*branch).agg(
        (0.5 * (F.sum(F.abs(F.col("own") / F.col("n") - sibling_share)) + 1 - F.sum(sibling_share))).alias("distance")
    )
    own_n, rest_n = F.col("good") + F.col("bad"), F.col("node_good") + F.col("node_bad") - F.col("good") - F.col("bad")
    rest_good = F.col("node_good") - F.col("good")
    share = F.col("node_good") / (own_n + rest_n)
    spread = F.sqrt(share * (1 - share) * (1 / own_n + 1 / rest_n))
    z = F.when((own_n > 0) & (rest_n > 0) & (spread > 0), F.abs(F.col("good") / own_n - rest_good / rest_n) / spread).otherwise(0.0)
    alike = (F.col("width") > 1) & ~F.startswith("segment", F.lit("{")) & (F.col("segment") != "") & (z < min_z) & (F.col("distance") <= max_distance)
    names = rated.join(distances, branch).select(
        *branch, F.when(F.col("segment") == "", F.col("template")).otherwise(F.concat("template", F.lit("/"), F.when(alike, "*").otherwise(F.col("segment")))).alias("further")
    )
    # the names are one row per branch; a branch's paths may be many, which the adaptive planner splits
    return paths.withColumn("segment", here).join(names, branch).drop("template", "segment").withColumnRenamed("further", "template")


def path_templates(pages: DataFrame, depth: int = 8, min_z: float = 2.58, max_distance: float = 0.25) -> DataFrame:
    """host, path, template, n, good, bad for every distinct host and path. pages: host, path, label."""
    good = F.coalesce(F.col("label").cast("long"), F.lit(0).cast("long"))
    bad = F.coalesce((~F.col("label")).cast("long"), F.lit(0).cast("long"))
    split = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), segment_shape)
    cut = F.when(F.size(split) > depth, F.concat(F.slice(split, 1, depth - 1), F.array(F.lit("{rest}")))).otherwise(split)
    paths = pages.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(good).alias("good"), F.sum(bad).alias("bad"))
    paths = saved(paths.withColumn("segments", cut).withColumn("template", F.lit("")), "url-paths")
    deepest = paths.agg(F.max(F.size("segments"))).first()[0] or 0
    # paths that are alike in their segments stay together from here on
    ways = paths.groupBy("host", "segments", "template").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    for level in range(deepest):
        ways = saved(merged_level(ways, level, min_z, max_distance), f"url-ways-{level}")
    return paths.select("host", "path", "segments", "n", "good", "bad").join(ways.select("host", "segments", "template"), ["host", "segments"])


def judged_templates(paths: DataFrame, strength: float, threshold: float) -> DataFrame:
    """host, template, purity, verdict. strength: labels that a prior is worth."""
    templates = paths.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    hosts = templates.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("bad").alias("host_bad"))
    whole = hosts.agg(F.sum("host_good").alias("all_good"), F.sum("host_bad").alias("all_bad"))
    overall = (F.coalesce("all_good", F.lit(0)) + 1) / (F.coalesce("all_good", F.lit(0)) + F.coalesce("all_bad", F.lit(0)) + 2)
    host_purity = (F.col("host_good") + strength * overall) / (F.col("host_good") + F.col("host_bad") + strength)
    purity = (F.col("good") + strength * host_purity) / (F.col("good") + F.col("bad") + strength)
    joined = templates.join(hosts, "host").join(F.broadcast(whole))  # one row
    return joined.select("host", "template", purity.alias("purity")).withColumn("verdict", F.when(F.col("purity") < threshold, "block").otherwise("allow"))


def judge_urls(pages: DataFrame, strength: float = 2.0, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity. pages: page_id, url; what the rules say are the labels."""
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    parsed = parsed.withColumn("matched", matched_rule(F.col("host"), F.col("path")))
    labelled = parsed.select("host", "path", (F.col("matched.verdict") == "allow").alias("label"))
    paths = saved(path_templates(labelled), "url-templates")
    verdicts = judged_templates(paths, strength, threshold)
    by_path = paths.select("host", "path", "template").join(verdicts, ["host", "template"])
    return parsed.join(by_path, ["host", "path"]).select(
        "page_id", "host", "path", F.col("matched.rule").alias("rule"), F.coalesce("matched.verdict", "verdict").alias("verdict"), "template", "purity"
    )


def op8_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
