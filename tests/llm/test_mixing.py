import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loadsieve.llm import QUERIES
from loadsieve.llm.mixing import mix, mixed, source_targets


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight; cap; share the excess among the others again, until nobody is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize(
    "sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 2, "d": 3}, {"z": 5, None: 50, "é": 7, "𝄞": 1}, {"a": 4}, {"a": 0, "b": 9}, {"a": 0}]
)
def test_targets(spark, sizes):
    units = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, size long, rows long")
    got = {r.source: r.target for r in source_targets(units).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def check(rows, texts):
    """rows: of mix. texts: (key, source, text) of the documents."""
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), str(r.source), r.size) for r in rows) == sorted((str(d), str(s), words(t)) for d, s, t in texts)
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, s, t in texts:
        sizes[s] += words(t)
        largest[s] = max(largest[s], words(t))
    want = brute_targets(sizes)
    for r in rows:
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        if r.size:
            assert int(r.target / r.source_size + 1e-9) <= r.copies <= r.target / r.source_size + 1 + 1e-9
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_documents(spark, sf_dir, docs):
    rows = mix(docs).collect()
    check(rows, [(r.doc_id, r.source, r.text) for r in docs.collect()])
    again = mix(docs.repartition(5, "lang")).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    got = QUERIES["op3_pivotal_mixing"](spark, sf_dir)
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert sorted((r.doc_id, r.taken) for r in got.collect()) == sorted((r.doc_id, r.taken) for r in rows)


def test_chances_keep_their_expectation(spark):
    """Over many equal sources, a document's mean number of copies is its share."""
    docs = spark.range(6000).select("id", F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.lpad((F.col("id") / 6).cast("int").cast("string"), 4, "0")).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 6 + 1).cast("int")).alias("text"))
    got = mix(docs).where("source_size > target").groupBy("size").agg(F.avg("copies"), F.avg(F.col("target") / F.col("source_size"))).collect()
    for _, mean, share in got:
        assert mean == pytest.approx(share, abs=0.12)


def test_edges(spark, edge, nothing):
    check(mix(edge).collect(), [(r.doc_id, r.source, r.text) for r in edge.collect()])
    same = spark.range(999).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    both = same.unionByName(spark.createDataFrame([(1, "x " * 3000, "t")], "doc_id long, text string, source string"))
    check(mix(both).collect(), [(r.doc_id, r.source, r.text) for r in both.collect()])
    assert mix(nothing).count() == 0 and mixed(nothing).count() == 0
    out = mixed(edge)
    assert out.columns == edge.columns
    copies = {(r.doc_id, r.source, r.size): 0 for r in mix(edge).collect()}
    for r in mix(edge).collect():
        copies[r.doc_id, r.source, r.size] += r.copies
    got = out.groupBy("doc_id", "source", "text").count().collect()
    assert sum(r["count"] for r in got) == sum(copies.values())
