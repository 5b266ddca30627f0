from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from loadsieve.llm import ORACLES, QUERIES
from loadsieve.llm.audit import cells, interactions, labelled, marked, word_filters
from tests.check_queries import connect, differences


def brute(rows, labels):
    """rows: (doc_id, text, lang). One set of counts per part, order and step, document by document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, text, _ in rows:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    counts, removed = {}, Counter()
    for lang in {r[2] or "" for r in rows}:
        for o in permutations("ABCDE"):
            for s in range(5):
                counts[lang, "".join(o), s + 1] = Counter()
    for d, text, lang in rows:
        t, lang = text or "", lang or ""
        words = t.encode().split()
        failed = {
            f
            for f, bad in {
                "A": len(words) < 100,
                "B": 100 * len(set(words)) < 80 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                "D": any(c in "#$%&*|" for c in t),
                "E": d is not None and first[t] < d,
            }.items()
            if bad
        }
        for o in permutations("ABCDE"):
            gone = False
            for s, f in enumerate(o):
                c = counts[lang, "".join(o), s + 1]
                c["unique"] += failed == {f}
                if gone:
                    c["redundant"] += f in failed
                elif f in failed:
                    gone = True
                    c["removed"] += 1
                    c["good"] += d in good
                    c["toxic"] += d in toxic
                    removed[lang, f] += 1
                else:
                    c["kept"] += 1
    return sorted(
        (lang, o, s, c["kept"], c["removed"], c["redundant"], c["unique"], c["good"], c["toxic"], removed[lang, o[s - 1]]) for (lang, o, s), c in counts.items()
    )


def audit(docs, labels):
    rows = marked(docs, word_filters(F.coalesce("text", F.lit(""))), "ABCDE")
    return interactions(cells(labelled(rows, labels), 16), "ABCDE")


def test_query_equals_sql(spark, sf_dir):
    name = "op11_filter_audit"
    assert differences(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) is None


def test_edges_against_brute_force(spark, edge, nothing):
    more = [(20, "|" * 5, None), (21, "ABC", ""), (22, "ABC", "𝄞"), (None, "ABC", None), (3, "ABC", "en"), (22, "ABC", "𝄞"), (23, "Hi " * 150, "de"), (24, None, "de")]
    docs = edge.select("doc_id", "text", "lang", "kept").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string").withColumn("kept", F.lit("mine")))
    known = [(1, 1, 0), (1, 0, 1), (22, None, 1), (23, 1, None), (None, 1, 1), (99, 1, 1), (24, 0, 0), (3, 1, 0)]
    labels = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    got = audit(docs, labels)
    assert got.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    want = brute([(r.doc_id, r.text, r.lang) for r in docs.collect()], known)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 4 * 600
    assert audit(nothing, labels).count() == 0
    assert audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_other_filters_and_clashing_columns(spark):
    rows = spark.createDataFrame([("p", 3, 5, 1, 0), ("p", 1, 2, 0, 2)], "part string, mask int, n long, n_good long, n_toxic long")
    got = {(r.filter_order, r.step): tuple(r)[3:] for r in interactions(rows, "XY").collect()}
    assert got == {("XY", 1): (0, 7, 0, 2, 1, 2, 9), ("XY", 2): (0, 0, 5, 0, 0, 0, 5), ("YX", 1): (2, 5, 0, 0, 1, 0, 5), ("YX", 2): (0, 2, 5, 2, 0, 2, 9)}
    assert got["XY", 1][:2] == (0, 7) and got["YX", 1][:2] == (2, 5) and got["YX", 2][1] == 2
    with pytest.raises(ValueError):
        interactions(rows, "XX")
