import zlib

import numpy as np

from loadsieve.llm import QUERIES
from loadsieve.llm.classifier import descend, features, fit, margins, ratios, score_quality, train_quality


def auc(good, bad):
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_held_out_accuracy(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    got = QUERIES["op10_nb_svm_quality"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(rows[d].score, y) for d, y in labels.items() if rows[d].held_out]
    assert auc([s for s, y in held if y], [s for s, y in held if not y]) > 0.97
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.93


def test_held_out_labels_change_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    one = {r.doc_id: r.score for r in score_quality(docs, train_quality(docs, labels)).collect()}
    two = {r.doc_id: r.score for r in score_quality(docs.repartition(4), train_quality(docs.repartition(3), labels.unionByName(labels))).collect()}
    assert all(abs(one[d] - two[d]) < 1e-9 for d in one)


def test_dual_descent_separates_and_ratios_have_the_right_sign():
    draw = np.random.default_rng(2)
    y = np.where(np.arange(60) % 3 == 0, -1, 1)
    rows = [np.unique(np.r_[[5 if s > 0 else 9], draw.integers(20, 200, 8)]).astype(np.int32) for s in y]
    scale = ratios(rows, y)
    assert scale[5] > 0 > scale[9]
    w = descend(rows, scale, y, 1.0, 20, 1)
    assert (np.sign(margins(rows, scale, w)) == y).all()
    _, weights = fit(rows, y, 1.0, 10, 0.9)
    assert weights[-2] > 0  # higher margins are better


def test_features_of_short_texts():
    assert len(features(None, {})) == 0 and len(features("", {})) == 0
    assert len(features("a", {})) > 0 and len(features(" \n", {})) >= 0


def test_edges(spark, edge, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert train_quality(edge, none) == 0.5
    one_class = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    assert train_quality(edge, one_class) == 1.0
    missing = spark.createDataFrame([(777, 1), (778, 0)], "doc_id long, quality int")
    assert train_quality(edge, missing) == 0.5
    labels = spark.createDataFrame([(1, 1), (5, 1), (8, 0), (6, 1), (7, 0), (3, 0)], "doc_id long, quality int")
    for model in (train_quality(edge, labels), 0.5):
        got = score_quality(edge, model)
        assert got.columns == [c for c in edge.columns if c not in ("text", "score")] + ["score", "predicted"]
        rows = got.collect()
        assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert score_quality(nothing, 0.5).count() == 0
