"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's bytes (A-Z lower-cased) in windows of `window` bytes, from both ends of each window. At every byte the two states give a softmax over the learned languages, so
every position has a label; a text's probability of a language is the mean over all its positions. All windows of a text are read, so texts of any length count whole.

Training is plain numpy: cross entropy at every position, gradients by backpropagation through time, Adam. It takes a bounded sample: about max_rows labelled texts, evenly from
all languages and chosen by a hash of their doc_id and text, each with `windows` stretches of 64 bytes at hashed places. One task fits them; the weights (a size that follows from the number
of languages) are the only thing broadcast. Languages are few and their counts pass through the driver. Predictions need no shuffle.

A text that is null or holds no letter is `und` with score 0, and so is every text where no language could be learned. Null languages teach nothing; an empty one is a language like
any other. Repeated rows are each predicted; scores of equal texts agree to six places (single precision). Empty tables give empty results. Columns `lang_pred` and `score` of the input are replaced, others pass.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsieve.llm.classifier import remainder
from loadsieve.llm.common import slices, small_batches, table, unused

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
TRAINED_BYTES = 64
Weights = dict[str, np.ndarray]


def start(languages: int, hidden: int, seed: int) -> Weights:
    """e: a row of input weights (update, reset, candidate) for every byte, biases within; u: state weights; v, c: the output. One e and u a direction."""
    draw = np.random.default_rng(seed)
    near = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
    e = draw.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32)
    return {"e": e, "u": near(2, hidden, 3 * hidden), "v": near(2 * hidden, languages), "c": np.zeros(languages, np.float32)}


def windows_of(raws: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (rows of bytes, padded at the end), their lengths and the text each belongs to."""
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    counts = -(-sizes // window)
    starts = np.cumsum(counts) - counts
    codes = np.zeros((int(counts.sum()), window), np.uint8)
    flat = codes.reshape(-1)
    for raw, at in zip(raws, (starts * window).tolist(), strict=True):
        flat[at : at + len(raw)] = np.frombuffer(raw, np.uint8)
    owner = np.repeat(np.arange(len(raws)), counts)
    lengths = np.minimum(window, sizes[owner] - window * (np.arange(len(codes)) - starts[owner]))
    return codes, lengths, owner


def states(e: np.ndarray, u: np.ndarray, codes: np.ndarray, active: np.ndarray, backwards: bool, kept: list | None = None) -> np.ndarray:
    """The state after each byte, as (place, window, unit). codes: (place, window), longest windows first; active: windows that reach each place. kept: takes what the gradient needs."""
    places, batch = codes.shape
    hidden = len(u)
    h = np.zeros((batch, hidden), np.float32)
    out = np.zeros((places, batch, hidden), np.float32)
    for t in range(places - 1, -1, -1) if backwards else range(places):
        n = active[t]
        if not n:
            continue
        before = h[:n]
        x = e[codes[t, :n]]
        g = before @ u
        gates = x[:, : 2 * hidden]
        gates += g[:, : 2 * hidden]
        gates *= 0.5
        np.tanh(gates, out=gates)  # the logistic function by way of tanh
        gates *= 0.5
        gates += 0.5
        z, r = gates[:, :hidden], gates[:, hidden:]
        candidate = x[:, 2 * hidden :]
        candidate += r * g[:, 2 * hidden :]
        np.tanh(candidate, out=candidate)
        new = before - candidate
        new *= z
        new += candidate
        if kept is not None:
            kept.append((t, n, before.copy(), z, r, candidate, g[:, 2 * hidden :]))
        h[:n] = new
        out[t, :n] = new
    return out


def softmax(logits: np.ndarray) -> np.ndarray:
    """Over the first axis."""
    p = np.exp(logits - logits.max(0))
    return p / p.sum(0)


def reaching(lengths: np.ndarray, places: int) -> np.ndarray:
    """How many windows are longer than each place."""
    return len(lengths) - np.searchsorted(np.sort(lengths), np.arange(places), side="right")


def gradients(w: Weights, codes: np.ndarray, lengths: np.ndarray, truth: np.ndarray) -> tuple[float, Weights]:
    """Mean cross entropy over all positions of some windows, and its gradient by backpropagation through time. codes: (window, place)."""
    order = np.argsort(-lengths, kind="stable")
    codes, lengths, truth = codes[order].T, lengths[order], truth[order]
    places, batch = codes.shape
    active = reaching(lengths, places)
    there = np.arange(places)[:, None] < lengths
    kept: list[list] = [[], []]
    h = np.concatenate([states(w["e"][d], w["u"][d], codes, active, bool(d), kept[d]) for d in (0, 1)], axis=2)
    p = softmax((h @ w["v"] + w["c"]).transpose(2, 0, 1))
    right = p[truth, np.arange(places)[:, None], np.arange(batch)]
    total = there.sum()
    loss = -np.log(np.maximum(right, 1e-30))[there].sum() / total
    p[truth, np.arange(places)[:, None], np.arange(batch)] -= 1
    d_logits = (p * there / total).transpose(1, 2, 0).astype(np.float32)
    flat = d_logits.reshape(-1, d_logits.shape[2])
    found = {k: np.zeros_like(v) for k, v in w.items()}
    found["v"], found["c"] = h.reshape(len(flat), -1).T @ flat, flat.sum(0)
    hidden = w["u"].shape[1]
    for d in (0, 1):
        d_out = d_logits @ w["v"][d * hidden : (d + 1) * hidden].T
        d_h = np.zeros((batch, hidden), np.float32)
        inputs, bytes_met = [], []
        for t, n, before, z, r, candidate, a in reversed(kept[d]):
            own = d_h[:n] + d_out[t, :n]
            d_candidate = own * (1 - z) * (1 - candidate * candidate)
            d_z = own * (before - candidate) * z * (1 - z)
            d_r = d_candidate * a * r * (1 - r)
            d_g = np.concatenate([d_z, d_r, d_candidate * r], axis=1)
            found["u"][d] += before.T @ d_g
            d_h[:n] = own * z + d_g @ w["u"][d].T
            inputs.append(np.concatenate([d_z, d_r, d_candidate], axis=1))
            bytes_met.append(codes[t, :n])
        met = np.concatenate(bytes_met)
        by_byte = np.argsort(met, kind="stable")
        values, firsts = np.unique(met[by_byte], return_index=True)
        found["e"][d][values] = np.add.reduceat(np.concatenate(inputs)[by_byte], firsts, axis=0)
    return float(loss), found


def fit(codes: np.ndarray, lengths: np.ndarray, truth: np.ndarray, languages: int, hidden: int, rounds: int, seed: int = 11, batch: int = 128, rate: float = 0.02) -> Weights:
    """Weights after `rounds` batches, each drawn evenly from the languages."""
    draw = np.random.default_rng(seed)
    w = start(languages, hidden, seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    of = [np.flatnonzero(truth == k) for k in range(languages)]
    for step in range(1, rounds + 1):
        wanted = draw.permutation(np.resize(draw.permutation(languages), batch))
        chosen = np.array([of[k][draw.integers(len(of[k]))] for k in wanted])
        _, g = gradients(w, codes[chosen], lengths[chosen], truth[chosen])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        now = rate * min(1.0, 1.1 - step / rounds)
        for k in w:
            own = g[k] * min(1.0, 1.0 / max(norm, 1e-12))
            first[k] += 0.1 * (own - first[k])
            second[k] += 0.01 * (own * own - second[k])
            w[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return w


def for_reading(w: Weights) -> list[tuple[np.ndarray, np.ndarray]]:
    """Input weights of both directions, and their state weights with units first; halved where read_states needs it."""
    hidden = w["u"].shape[1]
    halves = np.full((3 * hidden, 1), 0.5, np.float32)
    only_gates = np.where(np.arange(3 * hidden)[:, None] < 2 * hidden, halves, np.float32(1))
    return [(np.ascontiguousarray(w["e"][d] * only_gates.T), np.ascontiguousarray(w["u"][d].T * halves)) for d in (0, 1)]


def read_states(e: np.ndarray, u: np.ndarray, codes: np.ndarray, active: np.ndarray, backwards: bool) -> np.ndarray:
    """What `states` gives, as (place, unit, window), without what only the gradient needs.

    The logistic function of x is (tanh(x / 2) + 1) / 2, so with halved weights a gate is its tanh, one more and halved; the half of the reset gate is in the state weights too.
    """
    places, batch = codes.shape
    hidden = u.shape[1]
    h = np.zeros((hidden, batch), np.float32)
    out = np.zeros((places, hidden, batch), np.float32)
    for t in range(places - 1, -1, -1) if backwards else range(places):
        n = active[t]
        if not n:
            continue
        before = h[:, :n]
        x = np.ascontiguousarray(e[codes[t, :n]].T)
        g = u @ before
        gates, candidate = g[: 2 * hidden], x[2 * hidden :]
        gates += x[: 2 * hidden]
        np.tanh(gates, out=gates)
        asked = g[2 * hidden :]
        candidate += asked
        asked *= gates[hidden:]
        candidate += asked
        np.tanh(candidate, out=candidate)
        apart = before - candidate
        new = gates[:hidden]
        new *= apart
        new += apart
        new *= 0.5
        new += candidate
        h[:, :n] = new
        out[t, :, :n] = new
    return out


def label_positions(w: Weights, raws: list[bytes], window: int, at_once: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For some windows at a time: the text and place of every position (of the windows' bytes), and the probabilities there as (language, position).

    at_once: windows that are read together; so few stay in the caches, and the products don't call up more threads.
    """
    codes, lengths, owner = windows_of([r.lower() for r in raws], window)
    order = np.argsort(-lengths, kind="stable")
    firsts = np.r_[0, np.cumsum(-(-np.fromiter(map(len, raws), np.int64, len(raws)) // window))][:-1]
    directions = for_reading(w)
    hidden = w["u"].shape[1]
    of_both = [np.ascontiguousarray(v.T) for v in (w["v"][:hidden], w["v"][hidden:])]
    for i in range(0, len(order), at_once):
        own = order[i : i + at_once]
        turned = np.ascontiguousarray(codes[own].T)
        active = reaching(lengths[own], window)
        h = [read_states(*directions[d], turned, active, bool(d)) for d in (0, 1)]
        texts, places = owner[own], window * (own - firsts[owner[own]])
        for t in range(window):
            n = active[t]
            if n:
                logits = of_both[0] @ h[0][t, :, :n] + of_both[1] @ h[1][t, :, :n]
                yield texts[:n], places[:n] + t, softmax(logits + w["c"][:, None])


def pooled(w: Weights, raws: list[bytes], window: int) -> np.ndarray:
    """Mean probabilities of the texts, (text, language); zeros for an empty text."""
    sums = np.zeros((w["v"].shape[1], len(raws)))
    for owner, _, p in label_positions(w, raws, window):
        for k, row in enumerate(p):
            sums[k] += np.bincount(owner, weights=row, minlength=len(raws))
    return (sums / np.maximum(1, [len(r) for r in raws])).T


def train_languages(docs: DataFrame, max_rows: int = 4_000, windows: int = 4, hidden: int = 8, rounds: int = 400) -> tuple[list[str], Weights | None]:
    """Learned languages and weights. docs: doc_id, text, lang of training rows."""
    rows = docs.where("lang IS NOT NULL AND text <> ''")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return [], None
    wanted = max(1, max_rows // len(languages))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, wanted / counts[k]))])
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    seeds = F.transform(F.sequence(F.lit(1), F.lit(windows)), lambda i: F.pmod(F.xxhash64("text", "doc_id", i), F.greatest(F.lit(1), F.char_length("text") - TRAINED_BYTES // 2)))
    # at least one text of each language, whatever the hashes say
    least = rows.groupBy("lang").agg(F.min(chance).alias("least"))
    drawn = rows.join(F.broadcast(least), "lang").where((chance < share[F.col("lang")]) | (chance == F.col("least")))
    stretches = drawn.select("lang", F.explode(F.array_distinct(seeds)).alias("at"), "text").select("lang", F.expr(f"substring(text, int(at) + 1, {TRAINED_BYTES})").alias("stretch"))

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["lang", "stretch"], ignore_index=True)
        raws = [s.encode()[:TRAINED_BYTES].lower() for s in group.stretch]
        codes, lengths, _ = windows_of(raws, TRAINED_BYTES)
        numbers = {k: i for i, k in enumerate(languages)}
        w = fit(codes, lengths, group.lang.map(numbers).to_numpy(np.int64), len(languages), hidden, rounds)
        return pd.DataFrame({"weights": [pickle.dumps(w)]})

    # about max_rows * windows stretches of 64 characters meet here
    model = stretches.where("stretch <> ''").withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fitted, "weights binary").first()
    return languages, pickle.loads(bytes(model["weights"]))


def with_languages(docs: DataFrame, languages: list[str], w: Weights | None, text: str = "text", window: int = 128) -> DataFrame:
    """The other columns of docs, lang_pred and score."""
    rest = [c for c in docs.columns if c != text and c.lower() not in ("lang_pred", "score")]
    schema = T.StructType([f for f in docs.schema if f.name in rest]).add("lang_pred", "string").add("score", "double")
    shared = docs.sparkSession.sparkContext.broadcast((languages, w))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = shared.value
        for batch in small_batches(batches):
            texts = batch.column(len(rest)).to_pylist()
            found = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            for i, j in slices(texts, 250_000) if weights is not None else ():
                asked = [k for k in range(i, j) if texts[k] and LETTER.search(texts[k])]
                p = pooled(weights, [texts[k].encode() for k in asked], window)
                for k, best, row in zip(asked, p.argmax(1), p, strict=True):
                    found[k], scores[k] = names[best], min(1.0, row[best])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(found, pa.string()), pa.array(scores)], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(unused(docs.columns, "whole"))).mapInArrow(predicted, schema)


def op12_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train_languages(docs.where(remainder(F.col("doc_id")) != 2))
    marked = docs.select("doc_id", "text", (remainder(F.col("doc_id")) == 2).alias("held_out"))
    return with_languages(marked, *model)
