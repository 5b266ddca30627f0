"""Exact top-k by inner product: ball trees over shards of the candidates, searched by branch and bound.

Components become whole numbers, so scores are whole and exact. Candidates are dealt evenly into shards by hash and the queries into blocks; a task holds one shard and one block.
It builds the shard's ball tree (halved along the widest direction, a centre and a radius per node) and visits nodes by falling upper bound
q.c + |q| r, a whole block at a time, skipping for each query the nodes that can't reach its kth score. The kth score is shared between shards: each query
is first searched in one shard, and what it finds there is the bound that it brings to all others.

Rows whose vector is null or holds null or non-finite components take no part; nor does a pair of vectors of different lengths. Repeated vec_ids are candidates each,
a query leaves out the rows of its own vec_id. Null vec_ids take no part. Fewer candidates than k give fewer rows; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import table
from loadsieve.session import saved

LEAF = 64
#: Nodes that each query visits in its own order.
FIRST = 4


@dataclass
class BallTree:
    """Nodes in levels order: node i has children 2i+1 and 2i+2; rows of a node are order[first:last]."""

    rows: np.ndarray
    ids: np.ndarray
    firsts: np.ndarray
    lasts: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    leaves: np.ndarray


def ball_tree(rows: np.ndarray, ids: np.ndarray) -> BallTree:
    """Leaves hold about LEAF rows. rows: whole numbers as doubles."""
    order = np.lexsort((ids,))
    spans, level = [(0, len(rows))], [(0, len(rows))]
    while level and level[0][1] - level[0][0] > LEAF:
        below = []
        for first, last in level:
            own = order[first:last]
            middle = first + (last - first) // 2
            part = rows[own]
            along = part @ direction(part)
            order[first:last] = own[np.argsort(along, kind="stable")]
            below += [(first, middle), (middle, last)]
        spans += below
        level = below
    firsts, lasts = (np.array(x) for x in zip(*spans, strict=True))
    placed = rows[order]
    centres = np.stack([placed[a:b].mean(0) for a, b in spans])
    radii = np.array([np.sqrt(((placed[a:b] - c) ** 2).sum(1).max()) for (a, b), c in zip(spans, centres, strict=True)])
    return BallTree(placed, ids[order], firsts, lasts, centres, radii, np.arange(len(spans)) >= len(spans) - len(level))


def direction(part: np.ndarray) -> np.ndarray:
    """From the row farthest from the mean to the row farthest from that one."""
    one = part[((part - part.mean(0)) ** 2).sum(1).argmax()]
    return part[((part - one) ** 2).sum(1).argmax()] - one


#: Stands for no score.
NONE = np.iinfo(np.int64).min + 1


def products(queries: np.ndarray, rows: np.ndarray, reach: float) -> np.ndarray:
    """Inner products of whole numbers, exact: in double precision where no product of norms (reach) leaves it, else in 64-bit integers, which are slower."""
    if reach < 2**53:
        return (queries @ rows.T).astype(np.int64)
    return queries.astype(np.int64) @ rows.T.astype(np.int64)


def search(tree: BallTree, queries: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best of the tree for each query, filled up with NONE; what is below a query's bound may be left out.

    own: each query's id, which is left out. A node whose upper bound equals the kth score is still visited, for ties go to the smaller id.
    """
    n = len(queries)
    best = np.full((n, k), NONE)
    who = np.full((n, k), np.iinfo(np.int64).max)
    norms = np.sqrt((queries**2).sum(1))
    leaves = np.flatnonzero(tree.leaves)
    upper = queries @ tree.centres.T + norms[:, None] * tree.radii  # of all nodes; a shard has few
    upper += 1e-6 * (1 + np.abs(upper))  # rounding never hides a candidate
    parents = (np.arange(len(tree.radii)) - 1) // 2
    for node in range(1, len(tree.radii)):  # a node reaches no higher than the ball around it
        upper[:, node] = np.minimum(upper[:, node], upper[:, parents[node]])
    upper = upper[:, leaves]
    long = np.array([np.sqrt((tree.rows[tree.firsts[x] : tree.lasts[x]] ** 2).sum(1).max()) for x in leaves])
    kth = bound.copy()
    open_ = np.ones(upper.shape, bool)

    def visit(leaf: int, those: np.ndarray) -> None:
        a, b = tree.firsts[leaves[leaf]], tree.lasts[leaves[leaf]]
        open_[those, leaf] = False
        scores = products(queries[those], tree.rows[a:b], norms[those].max() * long[leaf])
        scores[own[those][:, None] == tree.ids[None, a:b]] = NONE
        hopeful = scores.max(1) >= kth[those]
        those, scores = those[hopeful], scores[hopeful]
        if len(those):
            all_scores = np.hstack([best[those], scores])
            all_ids = np.hstack([who[those], np.broadcast_to(tree.ids[a:b], scores.shape)])
            chosen = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
            best[those] = np.take_along_axis(all_scores, chosen, 1)
            who[those] = np.take_along_axis(all_ids, chosen, 1)
            kth[those] = np.maximum(kth[those], best[those, -1])

    ranked = np.argsort(-upper, axis=1, kind="stable")
    for step in range(min(FIRST, len(leaves))):  # each query's own best nodes raise its kth score
        nodes = ranked[:, step]
        for leaf in np.unique(nodes):
            those = np.flatnonzero((nodes == leaf) & (upper[:, leaf] >= kth))
            if len(those):
                visit(leaf, those)
    for leaf in np.argsort(-upper.max(0), kind="stable"):  # then all nodes that still reach it, whole blocks at a time
        those = np.flatnonzero(open_[:, leaf] & (upper[:, leaf] >= kth))
        if len(those):
            visit(leaf, those)
    return best, who


def whole_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, v (whole components as doubles) of the rows that take part."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return df.where(F.col(vec_id).isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(doubles, lambda x: F.floor(x * 256).cast("double")).alias("v")
    )


def top_k(vectors: DataFrame, is_query: Column, k: int, shard_rows: int = 16_384, block_rows: int = 2_048) -> DataFrame:
    """query_id, rank, vec_id, score. vectors: vec_id, v, of a written table.

    Scores are exact as long as they fit 64 bits.
    """
    total = vectors.count()
    shards = max(1, -(-total // shard_rows))
    rows = vectors.select("vec_id", "v", F.size("v").alias("dims"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"))
    queries = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dims")).dropDuplicates()
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // block_rows))
    queries = saved(queries.withColumn("block", F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)).cast("int")), "queries")
    home = F.pmod(F.col("block"), F.lit(shards)).cast("int")

    def found(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        as_rows = lambda s: np.array(s.tolist(), float).reshape(len(s), -1)
        tree = ball_tree(as_rows(right.v), right.vec_id.to_numpy())
        best, who = search(tree, as_rows(left.v), left.query_id.to_numpy(), left.bound.to_numpy(), k)
        there = best > NONE
        ids = np.repeat(left.query_id.to_numpy(), there.sum(1))
        return pd.DataFrame({"query_id": ids, "vec_id": who[there], "score": best[there]})

    schema = "query_id long, vec_id long, score long"
    tasks = max(1, min(blocks * shards, 4096))

    def searched(asked: DataFrame, there: DataFrame) -> DataFrame:
        keys = ["block", "shard", "dims"]
        return asked.repartition(tasks, *keys).groupBy(*keys).cogroup(there.repartition(tasks, *keys).groupBy(*keys)).applyInPandas(found, schema)

    def copies(numbers: Column) -> DataFrame:
        """Each shard's rows once for each of the blocks that search it."""
        return rows.withColumn("block", F.explode(numbers))

    lowest = F.lit(float("-inf")).alias("bound")
    first = saved(
        searched(
            queries.select("*", home.alias("shard"), lowest),
            copies(F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.pmod(b, F.lit(shards)) == F.col("shard"))),
        ),
        "first-shard",
    )
    bounds = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
    bounds = bounds.select("query_id", F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf")).alias("bound"))
    if shards > 1:
        others = queries.join(bounds, "query_id", "left").na.fill(float("-inf"), ["bound"])
        others = others.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(F.col("shard") != home)
        rest = searched(others, copies(F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.pmod(b, F.lit(shards)) != F.col("shard"))))
        first = first.unionByName(rest)
    ranked = first.selectExpr("*", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank")
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op9_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = saved(whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5)


#: The same by comparing every query with every row.
TOPK_SQL = """
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
