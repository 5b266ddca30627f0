"""Header similarity: the ratio 2*M/T over recursively longest common blocks.

The recursion has no native expression. It runs here on arrays, for all pairs of a batch at once: the longest common block of every pair comes from one table of run lengths that grows
along the first texts, and the parts to its left and right are the next round's pairs. The block that begins first in the first text, then in the second, wins ties, as the ratio
depends on it.

Pairs are kept from that work by an exact upper bound, never by a cap: the characters that two texts share, counted in SIGNATURE buckets. A pair whose bound cannot reach what is
asked for is not compared.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# executors get the functions of this module with the plan; the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: lowest ratio at which a header is taken for a target column.
DEFAULT_THRESHOLD = 0.78
# Fixed value: from this length on the measure leaves frequent characters of the second text out, which only single comparisons do.
LONG = 200
SIGNATURE = 64
#: Cells of the table of run lengths that are held at once.
TABLE_CELLS = 4_000_000

BEST_TYPE = T.StructType().add("position", T.IntegerType()).add("ratio", T.DoubleType())


def length_bound(a: Column, b: Column) -> Column:
    """Largest ratio two texts of these lengths can reach."""
    la, lb = F.length(a), F.length(b)
    return F.when(la + lb == 0, F.lit(1.0)).otherwise(F.least(la, lb) * 2.0 / (la + lb))


def characters(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, one row each, and their lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    width = max(1, int(lengths.max(initial=0)))
    codes = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes.astype(np.int32).reshape(len(texts), width), lengths


def signatures(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket of characters occurs in each text, and the texts' lengths. Nothing is padded, so one long text (a title
    among cells) costs its own characters only; about TABLE_CELLS characters are held at once, or one text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.zeros((len(texts), SIGNATURE), np.int32)
    ends, start = np.cumsum(lengths), 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] - lengths[start] + TABLE_CELLS, "right")))
        codes = np.frombuffer("".join(texts[start:end]).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.repeat(np.arange(end - start) * SIGNATURE, lengths[start:end]) + codes % SIGNATURE
        counts[start:end] = np.bincount(place, minlength=(end - start) * SIGNATURE).reshape(-1, SIGNATURE)
        start = end
    return counts, lengths


def longest_blocks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and starts of each pair's longest common block. Rows end in codes that equal nothing."""
    n = len(a)
    runs = np.zeros((n, b.shape[1] + 1), np.int16)
    size, at_a, at_b = (np.zeros(n, np.int64) for _ in range(3))
    every = np.arange(n)
    for i in range(a.shape[1]):
        runs[:, 1:] = (runs[:, :-1] + 1) * (a[:, i : i + 1] == b)
        j = runs.argmax(1)
        longest = runs[every, j]
        more = longest > size
        size[more], at_a[more], at_b[more] = longest[more], i + 1 - longest[more], j[more] - longest[more]
    return size, at_a, at_b


def windows(codes: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, filler: int) -> np.ndarray:
    at = starts[:, None] + np.arange(int((ends - starts).max()))
    inside = at < ends[:, None]
    return np.where(inside, codes[rows[:, None], np.where(inside, at, 0)], filler)


def ratios(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """The ratio of each pair."""
    found = np.empty(len(left))
    long = [i for i, (x, y) in enumerate(zip(left, right)) if max(len(x), len(y)) >= LONG]
    for i in long:
        found[i] = SequenceMatcher(None, left[i], right[i]).ratio()
    short = np.setdiff1d(np.arange(len(left)), long)
    # pairs of like size lie together, so that little is padded
    sizes = np.array([max(len(left[i]), len(right[i]), 1) for i in short], np.int64)
    short, sizes = short[np.argsort(sizes, kind="stable")], np.sort(sizes)
    start = 0
    while start < len(short):
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:] ** 2), TABLE_CELLS)))
        some = short[start:end].tolist()
        found[short[start:end]] = _short_ratios([left[i] for i in some], [right[i] for i in some])
        start = end
    return found


def _short_ratios(left: list[str], right: list[str]) -> np.ndarray:
    (a, la), (b, lb) = characters(left), characters(right)
    matched = np.zeros(len(left), np.int64)
    pair, a0, a1, b0, b1 = np.arange(len(left)), np.zeros_like(la), la, np.zeros_like(lb), lb
    while True:
        open_ = (a1 > a0) & (b1 > b0)
        pair, a0, a1, b0, b1 = (v[open_] for v in (pair, a0, a1, b0, b1))
        if not len(pair):
            break
        size, i, j = longest_blocks(windows(a, pair, a0, a1, -1), windows(b, pair, b0, b1, -2))
        np.add.at(matched, pair, size)
        hit = size > 0
        pair, a0, a1, b0, b1, size, i, j = (v[hit] for v in (pair, a0, a1, b0, b1, size, i, j))
        # what lies left of the block, and what lies right of it
        pair = np.r_[pair, pair]
        a0, a1, b0, b1 = np.r_[a0, a0 + i + size], np.r_[a0 + i, a1], np.r_[b0, b0 + j + size], np.r_[b0 + j, b1]
    total = la + lb
    return np.where(total > 0, 2.0 * matched / np.maximum(total, 1), 1.0)


@pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    pairs = pd.DataFrame({"a": a[known].tolist(), "b": b[known].tolist()})
    distinct = pairs.drop_duplicates()
    worth = distinct.assign(ratio=ratios(distinct.a.tolist(), distinct.b.tolist()))
    out[known] = pairs.merge(worth, on=["a", "b"], how="left").ratio
    return pd.Series(out).where(known, None)


class Pairs:
    """Texts of both sides, each once, and the ratios of those pairs that were worth comparing."""

    def __init__(self) -> None:
        self.left: dict[str, int] = {}
        self.right: dict[str, int] = {}
        self.compared = 0

    def bounds(self, left: list[int], right: list[int]) -> np.ndarray:
        """Upper bounds of the pairs' ratios, by the characters that they share."""
        out = []
        (of_a, la), (of_b, lb) = signatures(list(self.left)), signatures(list(self.right))
        x, y = np.array(left, np.int64), np.array(right, np.int64)
        for i in range(0, len(x), 50_000):
            u, v = x[i : i + 50_000], y[i : i + 50_000]
            total = la[u] + lb[v]
            out.append(np.where(total > 0, 2.0 * np.minimum(of_a[u], of_b[v]).sum(1, dtype=np.int64) / np.maximum(total, 1), 1.0))
        return np.concatenate(out) if out else np.empty(0)

    def ratios(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ratios of pairs, each distinct one compared once."""
        code, back = np.unique(left * (len(self.right) + 1) + right, return_inverse=True)
        self.compared += len(code)
        names, others = list(self.left), list(self.right)
        return ratios([names[c] for c in (code // (len(self.right) + 1)).tolist()], [others[c] for c in (code % (len(self.right) + 1)).tolist()])[back]


def firsts_of_best(groups: np.ndarray, places: np.ndarray, worth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and worth of each group's best, the first place on ties; -1 and 0 for groups without any."""
    at, best = np.full(n, -1, np.int64), np.zeros(n)
    order = np.lexsort((places, -worth, groups))
    heads = np.unique(groups[order], return_index=True)
    at[heads[0]], best[heads[0]] = places[order][heads[1]], worth[order][heads[1]]
    return at, best


def best_positions(asked: Sequence[tuple[str, Sequence[str]]], floor: float) -> tuple[list[tuple[int, float]], int]:
    """Position and ratio of the first best candidate above `floor` for each key, and how many pairs were compared."""
    pairs = Pairs()
    left, right, group, place = [], [], [], []
    for g, (key, candidates) in enumerate(asked):
        one = pairs.left.setdefault(key, len(pairs.left))
        for p, c in enumerate(candidates):
            left.append(one)
            right.append(pairs.right.setdefault(c, len(pairs.right)))
            group.append(g)
            place.append(p)
    hopeful = np.flatnonzero(pairs.bounds(left, right) > floor)
    left, right, group, place = (np.array(v, np.int64)[hopeful] for v in (left, right, group, place))
    worth = pairs.ratios(left, right)
    above = worth > floor
    at, best = firsts_of_best(group[above], place[above], worth[above], len(asked))
    return list(zip(at.tolist(), best.tolist())), pairs.compared


def _below(threshold: float) -> float:
    """Ratios are fractions of small whole numbers: a hair below keeps "at or above"."""
    return threshold - 1e-12


def best_of(key: Column, targets: Column, threshold: float) -> Column:
    """struct(position, ratio) of the first best target at or above the threshold.

    `targets` is an array column with the keys of one target table in ordinal order; the
    position is -1 when no target reaches the threshold.
    """
    floor = _below(threshold)

    @pandas_udf(BEST_TYPE)
    def udf(k: pd.Series, t: pd.Series) -> pd.DataFrame:
        found, _ = best_positions([("", ()) if x is None else (x, y) for x, y in zip(k, t)], floor)
        return pd.DataFrame(found, columns=["position", "ratio"])

    return udf(key, targets)


def best_of_known(keys: Column, target_keys: Sequence[str], threshold: float) -> Column:
    """Best ratio for each key of an array, for a target the driver knows.

    A ratio below the threshold is reported as 0.0. Each distinct key of a batch is compared once.
    """
    known = list(target_keys)
    floor = _below(threshold)

    @pandas_udf(T.ArrayType(T.DoubleType()))
    def udf(rows: pd.Series) -> pd.Series:
        distinct = list({k: None for row in rows if row is not None for k in row})
        found, _ = best_positions([(k, known) for k in distinct], floor)
        ratio = {k: r for k, (_, r) in zip(distinct, found)}
        return pd.Series([None if row is None else [ratio[k] for k in row] for row in rows])

    return udf(keys)


def suggested(asked: Sequence[tuple[str, Sequence[str]]]) -> tuple[list[tuple[int, float]], int]:
    """First best key for each target, where containment counts as at least 0.75, and how many pairs were compared.

    The pair of the highest bound is compared first for every target; then only pairs whose bound reaches what that one, or containment, is worth.
    """
    pairs = Pairs()
    left, right, group, place, least = [], [], [], [], []
    for g, (target, keys) in enumerate(asked):
        two = pairs.right.setdefault(target, len(pairs.right))
        for p, k in enumerate(keys):
            left.append(pairs.left.setdefault(k, len(pairs.left)))
            right.append(two)
            group.append(g)
            place.append(p)
            least.append(0.75 if k and target and (k in target or target in k) else 0.0)
    if not group:
        return [(-1, 0.0)] * len(asked), 0
    bound = pairs.bounds(left, right)
    left, right, group, place = (np.array(v, np.int64) for v in (left, right, group, place))
    worth = np.array(least)
    top = np.zeros(len(asked))
    np.maximum.at(top, group, worth)
    highest = np.unique(group[np.lexsort((-bound, group))], return_index=True)[1]
    some = np.lexsort((-bound, group))[highest]
    done = np.zeros(len(group), bool)
    for chosen in (some, None):
        if chosen is None:
            chosen = np.flatnonzero(~done & (bound >= top[group]) & (bound > worth))
        worth[chosen] = np.maximum(worth[chosen], pairs.ratios(left[chosen], right[chosen]))
        done[chosen] = True
        np.maximum.at(top, group, worth)
    some = worth > 0
    at, best = firsts_of_best(group[some], place[some], worth[some], len(asked))
    return list(zip(at.tolist(), best.tolist())), pairs.compared


@pandas_udf(T.ArrayType(BEST_TYPE))
def best_suggestions(targets: pd.Series, keys: pd.Series) -> pd.Series:
    """For each missing target of a row, struct(position, ratio) of the left-out header that suits it best."""
    found = iter(suggested([(t, ks) for ts, ks in zip(targets, keys) for t in ts])[0])
    out = [[dict(zip(("position", "ratio"), next(found))) for _ in ts] for ts in targets]
    return pd.Series(out, dtype="object")
