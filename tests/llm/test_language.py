import zlib

import numpy as np
from pyspark.sql import functions as F

from loadsieve.llm import QUERIES
from loadsieve.llm.language import fit, for_reading, gradients, label_positions, pooled, reaching, read_states, start, states, train_languages, windows_of, with_languages


def test_held_out_accuracy(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    got = QUERIES["op12_gru_language"](spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    rows = got.collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not letters)
    held = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 200 and np.mean(held) > 0.98


def random_windows(draw, languages, n=7, window=9):
    raws = [bytes(draw.integers(0, 256, draw.integers(1, window + 1), np.uint8)) for _ in range(n)]
    codes, lengths, _ = windows_of(raws, window)
    return codes, lengths, draw.integers(0, languages, n)


def test_gradient_against_differences():
    draw = np.random.default_rng(1)
    codes, lengths, truth = random_windows(draw, 3)
    w = {k: v.astype(np.float64) for k, v in start(3, 4, 2).items()}
    _, found = gradients(w, codes, lengths, truth)
    met = int(codes[0, 0])
    for k, at in [("e", (0, met, 1)), ("e", (1, met, 6)), ("e", (0, met, 10)), ("u", (0, 2, 3)), ("u", (1, 0, 5)), ("u", (0, 1, 9)), ("v", (5, 1)), ("c", (2,))]:
        losses = []
        for step in (1e-2, -1e-2):
            moved = {n: v.copy() for n, v in w.items()}
            moved[k][at] += step
            losses.append(gradients(moved, codes, lengths, truth)[0])
        assert abs((losses[0] - losses[1]) / 2e-2 - found[k][at]) < 2e-3, (k, at)


def test_reading_equals_the_trained_recurrence():
    draw = np.random.default_rng(4)
    codes, lengths, _ = random_windows(draw, 2, 30, 20)
    order = np.argsort(-lengths, kind="stable")
    turned, active = np.ascontiguousarray(codes[order].T), reaching(lengths, 20)
    w = start(2, 6, 3)
    for d, weights in enumerate(for_reading(w)):
        one = states(w["e"][d], w["u"][d], turned, active, bool(d))
        two = read_states(*weights, turned, active, bool(d)).transpose(0, 2, 1)
        assert np.abs(one - two).max() < 1e-5


def test_every_position_has_a_label_and_texts_pool_them():
    draw = np.random.default_rng(5)
    raws = [bytes(draw.integers(65, 123, n, np.uint8)) for n in (1, 8, 9, 100, 3)] + [b""]
    w = start(3, 4, 6)
    seen, sums = set(), np.zeros((len(raws), 3))
    for texts, places, p in label_positions(w, raws, 8, at_once=4):
        assert np.allclose(p.sum(0), 1, atol=1e-5)
        for t, i, q in zip(texts, places, p.T):
            assert (t, i) not in seen and i < len(raws[t])
            seen.add((t, i))
            sums[t] += q
    assert len(seen) == sum(map(len, raws))
    got = pooled(w, raws, 8)
    assert np.allclose(got[:5], sums[:5] / np.array([[len(r)] for r in raws[:5]])) and (got[5] == 0).all()


def test_learns_what_follows_what():
    """Two languages with the same bytes in another order: only the recurrence can tell them."""
    draw = np.random.default_rng(7)
    raws = [b"".join((b"ab", b"ba")[k][:1] * 1 + (b"b", b"a")[k] + b" " for _ in range(8)) for k in (0, 1)] * 40
    raws = [r[int(draw.integers(0, 4)) :] for r in raws]
    codes, lengths, _ = windows_of(raws, 24)
    w = fit(codes, lengths, np.arange(80) % 2, 2, 6, 120)
    assert (pooled(w, raws, 24).argmax(1) == np.arange(80) % 2).mean() > 0.95


def test_edges(spark, edge, nothing):
    few = spark.createDataFrame([(1, "der die das und", "de"), (2, "the of and", "en"), (3, "the and", "en"), (4, None, "fr"), (5, "", "it"), (6, "x", None)], "doc_id long, text string, lang string")
    model = train_languages(few, rounds=5)
    assert model[0] == ["de", "en"]
    clashing = edge.withColumns({"lang_pred": F.lit(1), "whole": F.lit(2), "held_out": F.lit(3)})
    got = with_languages(clashing, *model)
    rest = [c for c in clashing.columns if c not in ("text", "lang_pred", "score")]
    assert got.columns == [*rest, "lang_pred", "score"]
    rows, texts = got.collect(), {r.doc_id: r.text for r in edge.collect()}
    assert len(rows) == edge.count()
    for r in rows:
        text = texts[r.doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        else:
            assert r.lang_pred in ("de", "en") and 0.5 <= r.score <= 1
    twice = [r for r in rows if r.doc_id == 1]
    assert twice[0].lang_pred == twice[1].lang_pred and abs(twice[0].score - twice[1].score) < 1e-6
    assert with_languages(nothing, *model).count() == 0
    none = train_languages(nothing)
    assert none == ([], None) and {r.lang_pred for r in with_languages(edge, *none).collect()} == {"und"}
    alone = train_languages(few.where("lang = 'de'"), rounds=2)
    assert {r.lang_pred for r in with_languages(edge, *alone).collect()} == {"und", "de"}
    again = train_languages(few.repartition(3), rounds=5)
    assert all(np.array_equal(model[1][k], again[1][k]) for k in model[1])
