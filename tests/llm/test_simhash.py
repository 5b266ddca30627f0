import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from loadsieve.llm import QUERIES
from loadsieve.llm.common import components
from loadsieve.llm.simhash import fingerprint, fingerprint_links, near_duplicates, one_per_group


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, max_bits):
    """value -> smallest value reachable."""
    values, group = sorted(set(values)), {}
    for v in values:
        if v in group:
            continue
        todo = [v]
        while todo:
            x = todo.pop()
            if x not in group:
                group[x] = v
                todo += [y for y in values if y not in group and (x ^ y).bit_count() <= max_bits]
    return group


def test_fingerprints(docs):
    texts = [r.text for r in docs.limit(80).collect()] + [None, "", " ", "One", "one TWO", "É é É é", "a\x85b c\xa0d e f"]
    for t in texts:
        assert fingerprint(t, 3) % (1 << 64) == brute_fingerprint(t)


def test_links_keep_the_components_of_all_pairs(spark):
    draw = random.Random(3)
    values = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(30):
        centre = draw.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(draw.randrange(7)):
                x ^= 1 << draw.randrange(64)
            values.add(x)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in components(fingerprint_links(fps)).collect()}
    want = brute_groups(values, 2)
    same = lambda groups: sorted(sorted(v for v in values if groups.get(v, v) == g) for g in {groups.get(v, v) for v in values})
    assert same(got) == same(want)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(100)}


def test_query_against_all_pairs(spark, sf_dir, docs):
    rows = docs.select("doc_id", "text").collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    groups = brute_groups(prints.values(), 2)
    least = {}
    for d, p in prints.items():
        least[groups[p]] = min(d, least.get(groups[p], d))
    got = QUERIES["op7_simhash_byte_index"](spark, sf_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect())) == sorted((d, f"{p:016x}", least[groups[p]]) for d, p in prints.items())
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(least.values())


def test_edges(edge, nothing):
    got = [tuple(r) for r in near_duplicates(edge).select("doc_id", "fp", "component_id").collect()]
    assert len(got) == edge.count()
    assert {(d, c) for d, f, c in got if f == 0} == {(2, 2), (3, 2), (4, 2)}
    assert {c for d, _, c in got if d is None} == {None}
    kept = one_per_group(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and ids.count(None) == 1 and 3 not in ids
    assert near_duplicates(nothing).count() == 0 and one_per_group(nothing).count() == 0


@pytest.mark.parametrize("copies", [3000])
def test_many_copies_are_one_row_of_the_index(spark, copies):
    one = spark.range(copies).select(F.col("id").alias("doc_id"), F.lit("the same words in every copy of it").alias("text"))
    assert near_duplicates(one).select("component_id").distinct().collect()[0][0] == 0
