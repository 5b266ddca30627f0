"""Secret scan over a trigram inverted index.

Every rule's regular expression is turned into a Boolean query on trigrams (in lower case) that each text it matches must hold: literal runs give conjunctions,
alternatives and optional parts disjunctions. One pass over the texts writes the postings (trigram, document) of the trigrams that the queries name; others would
never be read. Postings are intersected by counting, for each document and alternative of a query, how many of its trigrams are there. Only candidates are
searched for the rule. Rules without a mandatory trigram, such as long hexadecimal runs, are searched in every text.

Everything is built-in functions. Spans count code points, ends exclusive: a text is split at a rule's matches, and the lengths of pieces and matches add up.

Null texts count as empty. Repeated rows get their spans each; documents are told apart by doc_id (null too) and text. Empty tables give empty results.
Very long texts are searched whole. Other columns may have any name, but `found` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import table, unused
from loadsieve.session import saved, small_frame


@dataclass(frozen=True)
class Rule:
    """kind: its name. at_least: characters that group must have; shorter matches are passed over."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1


#: The base rules.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),  # runs are taken whole, so shorter ones needn't be matched first
)
#: Well-known formats of keys.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)

MANY = 64  # strings or alternatives beyond which a part of an expression is left out of its query
Query = frozenset[frozenset[str]]  # alternatives, each a set of trigrams; one empty set: no condition
ANY: Query = frozenset([frozenset()])


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def simplified(query: Query) -> Query:
    """Without alternatives that ask for more than another one."""
    return frozenset(a for a in query if not any(b < a for b in query))


def both(one: Query, two: Query) -> Query:
    joined = simplified(frozenset(a | b for a in one for b in two))
    return joined if len(joined) <= MANY else min(one, two, key=len)


def of_strings(strings: frozenset[str]) -> Query:
    return simplified(frozenset(map(trigrams, strings)))


def analysed(items: list) -> tuple[frozenset[str] | None, Query]:
    """The strings that a parsed expression can match, if they are few, and its query."""
    exact: frozenset[str] | None = frozenset([""])
    run, query = exact, ANY
    for op, value in items:
        strings, inner = one_item(op, value)
        if strings is not None and len(run) * len(strings) <= MANY:
            run = frozenset(a + b for a in run for b in strings)
            exact = None if exact is None else run
        else:
            query, run, exact = both(both(query, of_strings(run)), inner), strings or frozenset([""]), None
    return exact, both(query, of_strings(run))


def one_item(op, value) -> tuple[frozenset[str] | None, Query]:
    if op is C.LITERAL:
        return frozenset([chr(value).lower()]), ANY
    if op is C.IN and all(o is C.LITERAL for o, _ in value) and len(value) <= 8:
        return frozenset(chr(v).lower() for _, v in value), ANY
    if op is C.SUBPATTERN:
        return analysed(list(value[3]))
    if op is C.BRANCH:
        parts = [analysed(list(p)) for p in value[1]]
        query = simplified(frozenset().union(*(q for _, q in parts)))
        if all(s is not None for s, _ in parts):
            strings = frozenset().union(*(s for s, _ in parts))
            return (strings if len(strings) <= MANY else None), query
        return None, query
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        least, most, inner = value
        strings, query = analysed(list(inner))
        if most == 1 and strings is not None:
            return strings | {""}, ANY
        return None, query if least else ANY
    if op is C.AT:
        return frozenset([""]), ANY
    return None, ANY


def trigram_query(pattern: str) -> Query:
    """Alternatives of trigrams, one of which all texts that match hold whole (in lower case); ANY if nothing is mandatory."""
    query = analysed(list(_parser.parse(pattern)))[1]
    return ANY if frozenset() in query else query


def grams_pattern(grams: set[str]) -> str:
    """An expression whose first group is each occurrence of one of the trigrams, overlapping ones too."""
    by_first: dict[str, list[str]] = {}
    for g in sorted(grams):
        by_first.setdefault(g[0], []).append(re.escape(g[1:]))
    return "(?=(" + "|".join(re.escape(a) + "(?:" + "|".join(rest) + ")" for a, rest in by_first.items()) + "))"


def posting_lists(docs: DataFrame, grams: set[str]) -> DataFrame:
    """gram, doc_id, text_hash: the index. docs: doc_id, text, text_hash."""
    there = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(grams_pattern(grams)), F.lit(1)))
    return docs.select(F.explode(there).alias("gram"), "doc_id", "text_hash").sortWithinPartitions("gram")


def candidates(postings: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """doc_id, text_hash, kinds: the rules whose query the document meets."""
    asked = [(kind, i, len(grams), g) for kind, query in queries.items() for i, grams in enumerate(sorted(map(sorted, query))) for g in grams]
    terms = small_frame(postings.sparkSession, asked, "kind string, alternative int, asked int, gram string")
    keys = ["doc_id", "text_hash", "kind", "alternative", "asked"]
    # the terms are those of the rules, a fixed few
    counts = postings.dropDuplicates(["doc_id", "text_hash", "gram"]).join(F.broadcast(terms), "gram").groupBy(*keys).count()
    met = counts.where(F.col("count") == F.col("asked"))
    return met.groupBy("doc_id", "text_hash").agg(F.collect_set("kind").alias("kinds"))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end, kind) of a rule's matches, leftmost and not overlapping, without those that fail."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)

    def add(state: Column, match: Column) -> Column:
        start = state["at"] + F.char_length(match["gap"])
        end = start + F.char_length(match["whole"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        passes = F.char_length(match["value"]) >= rule.at_least
        return F.struct(end.alias("at"), F.when(passes, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    zipped = F.arrays_zip(whole.alias("whole"), value.alias("value"), F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    found = F.when(text.rlike(rule.pattern), F.aggregate(zipped, start, add)["spans"]).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text: str = "text") -> DataFrame:
    """Every column of docs (doc_id and the text among them) and found, the rules' spans (start, end, kind) in order of start, then of the rules.

    found replaces a column of that name; all others pass, whatever their names."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != ANY}
    grams = {g for q in queries.values() for alternative in q for g in alternative}
    full = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = docs.drop("found")
    hash_of, kinds_of, other_id, other_hash = (unused(docs.columns, c) for c in ("own_hash", "own_kinds", "other_id", "other_hash"))
    keyed = docs.withColumn(hash_of, F.xxhash64(full))
    spaces = keyed.select("doc_id", full.alias("text"), F.col(hash_of).alias("text_hash"))
    if grams:
        postings = saved(posting_lists(spaces, grams), "postings")
        kinds = saved(candidates(postings, queries), "candidates").select(F.col("doc_id").alias(other_id), F.col("text_hash").alias(other_hash), F.col("kinds").alias(kinds_of))
        keyed = keyed.join(kinds, keyed["doc_id"].eqNullSafe(kinds[other_id]) & (keyed[hash_of] == kinds[other_hash]), "left").drop(other_id, other_hash)
    else:
        keyed = keyed.withColumn(kinds_of, F.lit(None).cast("array<string>"))
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def ordered(rank: int, rule: Rule) -> Column:
        spans = rule_spans(full, rule)
        if rule.kind in queries:
            spans = F.when(F.coalesce(F.array_contains(kinds_of, rule.kind), F.lit(False)), spans).otherwise(none)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))

    every = F.sort_array(F.concat(*[ordered(i, r) for i, r in enumerate(rules)]))
    return keyed.withColumn("found", F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).drop(kinds_of, hash_of)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def equals(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def op4_trigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("found", lambda s: s["kind"].isin([r.kind for r in BASE]))
    counts = [F.size(F.filter(F.transform("found", lambda s: s["kind"]), equals(r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def secrets_sql() -> str:
    """The same by searching every text for every rule."""

    def one(rank: int, rule: Rule) -> str:
        p = "'" + rule.pattern.replace("'", "''") + "'"
        return f"""SELECT id, doc_id, {rank} AS rank, '{rule.kind}' AS kind, regexp_extract_all(text, {p}, 0) AS m,
          regexp_extract_all(text, {p}, {rule.group}) AS v, regexp_split_to_array(text, {p}) AS g, {rule.at_least} AS least FROM d"""

    matches = "\nUNION ALL ".join(one(i, r) for i, r in enumerate(BASE + MORE))
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    text = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
matches AS (
{matches}),
each AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM matches WHERE len(m) > 0),
placed AS (
  SELECT id, rank, kind, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
    length(m[i]) AS n FROM each WHERE length(v[i]) >= least),
spans AS (SELECT id, rank, kind, s, s + n AS e FROM placed),
summed AS (SELECT id, {counts}, {text} FILTER (WHERE kind IN ({base})) AS base, {text} AS spans FROM spans GROUP BY id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN summed USING (id)
"""
