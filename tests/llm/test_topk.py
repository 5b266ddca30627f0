import math
import random

import numpy as np
from pyspark.sql import functions as F

from loadsieve.llm import ORACLES, QUERIES
from loadsieve.llm.topk import top_k, whole_vectors
from loadsieve.session import saved
from tests.check_queries import connect, differences


def brute(rows, k, asked):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {(i, tuple(v)) for i, v in whole if asked(i)}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows, k=5, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    vectors = saved(whole_vectors(df, "vec_id", "embedding"), "test-vectors")
    return sorted(tuple(r) for r in top_k(vectors, F.col("vec_id") % 10 == 0, k, **sizes).collect())


def test_many_shards_and_ties_against_brute_force(spark):
    draw = random.Random(9)
    rows = [(i, [float(draw.choice([-1, -0.5, 0, 0.25, 1])) for _ in range(4)]) for i in range(900)]
    rows += [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(900, 1300)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows, shard_rows=200, block_rows=40) == brute(rows, 5, lambda i: i % 10 == 0)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (10, [0.5, -1.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [1.0, 2.0, 3.0]), (6, [1.0, 1.0]), (20, [1.0, 1.0, 1.0]), (30, [])]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 10 == 0)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_long_vectors_against_brute_force(spark):
    """Squared lengths of 2^53 and more: doubles would mix up neighbouring scores."""
    draw = random.Random(10)
    rows = [(i, [float(draw.randint(-3, 3)) for _ in range(3)]) for i in range(200)]
    rows += [(i, [400_000.0 + i / 256, float(draw.randint(-400_000, 400_000)), 1.0]) for i in range(200, 260)]
    rows += [(i, [2.0**20, 2.0**20 + (i - 300) / 8, 2.0**19]) for i in range(300, 330)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows, shard_rows=60, block_rows=20) == brute(rows, 5, lambda i: i % 10 == 0)


def test_query(spark, sf_dir):
    assert differences(spark, connect(sf_dir), QUERIES["op9_ball_tree_topk"], ORACLES["op9_ball_tree_topk"], sf_dir) is None
    assert differences(spark, connect(sf_dir), QUERIES["op4_trigram_index"], ORACLES["op4_trigram_index"], sf_dir) is None
