"""Quality classifier: naive Bayes support vector machine over hashed n-gram indicators.

Features of a text are the sets of its byte trigrams, words and word pairs, and which of those repeat in it, hashed into BUCKETS. Every indicator is
scaled by its class log-count ratio; a linear machine with hinge loss is fitted on the scaled rows by dual coordinate descent, its weights are drawn
towards their mean size (interpolation), and margins of held-back folds set the logistic curve that turns a margin into a score.

The fit reads max_rows labelled training rows at most (those with the smallest hash of doc_id), a documented bound that lets one task hold them; their ids are
the only broadcast besides the weights, whose size is fixed. Scores are made in one pass without a shuffle over all rows and whole texts.

Null and empty texts have no feature and get the score of the bias. Rows labelled more than once count once with their mean, rounded up at a half; null labels are dropped.
Without labels of both classes the score is the share of good labels (0.5 without any).
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsieve.llm.common import extended, small_batches, table
from loadsieve.session import saved

BUCKETS = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)  # a fixed odd number: products with it spread over the high bits
SHIFT = np.uint64(64 - 18)


def spread(codes: np.ndarray, kind: int) -> np.ndarray:
    """Buckets of 64-bit codes; kinds of features share the buckets but not the places."""
    return (((codes + np.uint64(kind)) * MIX) >> SHIFT).astype(np.int32)


def features(text: str | None, numbers: dict[bytes, int]) -> np.ndarray:
    """The buckets of a text's indicators, each once. numbers: hashes of words seen before."""
    raw = (text or "").encode()
    if not raw:
        return np.empty(0, np.int32)
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    grams = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
    found = [spread(grams, 1)]
    split = raw.split()
    hashes = np.empty(len(split), np.uint64)
    for i, w in enumerate(split):
        h = numbers.get(w)
        if h is None:
            if len(numbers) > 500_000:
                numbers.clear()
            h = numbers[w] = xxhash.xxh64_intdigest(w)
        hashes[i] = h
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:]
    found += [spread(hashes, 2), spread(pairs, 3)]
    for kind, codes in ((4, hashes), (5, pairs)):  # how much of the text is said twice, in tenths
        if len(codes):
            found.append(spread(np.array([10 * (len(codes) - len(np.unique(codes))) // len(codes)], np.uint64), kind))
    return np.unique(np.concatenate(found))


def descend(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float, rounds: int, seed: int) -> np.ndarray:
    """Dual coordinate descent for the hinge loss. Returns weights of the indicators themselves (the scale is multiplied in), the bias last."""
    w = np.zeros(len(scale) + 1)
    # eight bytes a feature, for all rows of the sample are held
    own = [np.append(scale[r] / max(1e-12, np.sqrt((scale[r] ** 2).sum())), 1.0).astype(np.float32) for r in rows]
    places = [np.append(r, np.int32(len(scale))) for r in rows]
    norms = np.array([float(v @ v) for v in own])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            gradient = y[i] * (w[places[i]] @ own[i]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            if new != alpha[i]:
                w[places[i]] += (new - alpha[i]) * y[i] * own[i]
                alpha[i] = new
    return w


def ratios(rows: list[np.ndarray], y: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    counts = [np.bincount(np.concatenate([r for r, s in zip(rows, y, strict=True) if s == side]), minlength=BUCKETS) + smoothing for side in (1, -1)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def margins(rows: list[np.ndarray], scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.array([w[-1] + (scale[r] @ w[r]) / max(1e-12, np.sqrt((scale[r] ** 2).sum())) for r in rows])


def logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margins to chances, by Newton's method with Platt's smoothed targets."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([m, np.ones_like(m)], 1)
    beta = np.array([1.0, np.log((good + 1) / (bad + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (t - p) - 1e-6 * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], y: np.ndarray, cost: float, rounds: int, mixing: float, folds: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Scale and weights; the weights end with the bias, the slope and the offset of the score."""

    def train(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = [rows[i] for i in chosen]
        scale = ratios(own, y[chosen])
        w = descend(own, scale, y[chosen], cost, rounds, 7)
        w[:-1] = (1 - mixing) * np.sign(w[:-1]) * np.abs(w[:-1]).mean() + mixing * w[:-1]
        return scale, w

    held = np.zeros(len(rows))
    fold = np.arange(len(rows)) % folds
    for k in range(folds):
        inner, outer = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(set(y[inner])) == 2:
            held[outer] = margins([rows[i] for i in outer], *train(inner))
    scale, w = train(np.arange(len(rows)))
    return scale, np.r_[w, logistic(held, y)]


def train_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, cost: float = 1.0, rounds: int = 12, mixing: float = 0.9) -> np.ndarray | float:
    """Scale and weights as rows of one array; or the share of good labels where there aren't both classes.

    docs: doc_id, text. labels: doc_id, quality, of training rows only.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    known = saved(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows), "labelled-rows")
    counts = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    if len(counts) < 2:
        return counts.get(True, 0) / max(1, sum(counts.values())) if counts else 0.5

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        for batch in small_batches(batches):
            found = [features(t.as_py(), numbers).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["doc_id", "good", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "good", "text")

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        y = np.where(group.good, 1, -1)
        if len(set(y)) < 2:
            return pd.DataFrame({"scale": pd.Series(dtype="object"), "weights": pd.Series(dtype="object")})
        scale, w = fit([np.frombuffer(x, np.int32) for x in group.found], y, cost, rounds, mixing)
        return pd.DataFrame({"scale": [scale.astype("<f8").tobytes()], "weights": [w.astype("<f8").tobytes()]})

    # at most max_rows rows meet here
    found = rows.mapInArrow(of, f"doc_id {kind}, good boolean, found binary")
    model = found.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fitted, "scale binary, weights binary").collect()
    if not model:  # labelled rows of one class only have a document
        return counts[True] / sum(counts.values())
    scale, weights = (np.frombuffer(bytes(model[0][c]), "<f8") for c in ("scale", "weights"))
    return np.stack([np.r_[scale, 0, 0, 0], weights])


SCORED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score_quality(docs: DataFrame, model: np.ndarray | float, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The other columns of docs, score and predicted; columns of docs with these names are replaced."""
    rest = [c for c in docs.columns if c != text and c.lower() not in ("score", "predicted")]
    kinds = T.StructType([f for f in docs.schema if f.name in rest] + SCORED.fields)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        for batch in small_batches(batches):
            texts = batch.column(len(rest))
            if isinstance(shared.value, float):
                scores = np.full(len(texts), shared.value)
            else:
                scale, w = shared.value[0][:BUCKETS], shared.value[1]
                m = margins([features(t.as_py(), numbers) for t in texts], scale, w[: BUCKETS + 1])
                scores = 1 / (1 + np.exp(-np.clip(w[-2] * m + w[-1], -30, 30)))
            out = pd.DataFrame({"score": scores, "predicted": (scores >= threshold).astype(int)})
            yield extended(pa.RecordBatch.from_arrays(batch.columns[: len(rest)], names=rest), SCORED, out)

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`")).mapInArrow(scored, kinds)


def remainder(doc_id: Column, parts: int = 4) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def op10_nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(remainder(F.col("doc_id")) != 2)
    marked = docs.withColumn("held_out", remainder(F.col("doc_id")) == 2)
    return score_quality(marked, train_quality(docs, labels))
