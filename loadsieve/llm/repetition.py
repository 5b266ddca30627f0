"""Repetition inside a document by suffix arrays over its words.

The suffixes of a text are sorted by prefix doubling; neighbours in that order share the longest common prefixes (LCP). The deepest LCP interval
around a suffix is as long as the longer prefix that it shares with a neighbour, so that length is the longest repeat which starts there. Repeats
that can't be extended to the left are the maximal repeated substrings; the union of the spans of those of at least min_words words is the covered part.
A document fails when too large a part is covered or its longest repeat is too long.

One pass without a shuffle. Documents are taken in runs of about RUN_CHARS characters that share one sorting: the first rank of a word holds its
document, so no repeat spans two documents. A longer document makes a run of its own, whole.

Null and empty texts have no words and fail the base rules. Repeated rows are judged each by itself. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsieve.llm.common import WHITE, extended, slices, small_batches, table

RUN_CHARS = 1_000_000
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, WINDOW, MAX_WINDOW_PERCENT = 50, 3, 50


def suffix_ranks(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the rank of every position by its first 1, 2, 4, ... words.

    ends: for every position, where its document ends. words: numbers that differ between documents. A round only sorts suffixes that share
    their rank with another; a suffix shorter than the compared length comes first and equals no other.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    sorted_words = words[order]
    heads = np.r_[True, sorted_words[1:] != sorted_words[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    levels, span = [rank], 1
    while True:
        sizes = np.bincount(rank, minlength=n)
        slots = np.flatnonzero(sizes[rank[order]] > 1)
        if not len(slots):
            return order, levels
        tied = order[slots]
        after = tied + span
        inside = after < ends[tied]
        second = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        key = rank[tied] * (n + 1) + second
        by_key = np.argsort(key, kind="stable")
        tied, key = tied[by_key], key[by_key]
        order[slots] = tied
        new = np.r_[True, key[1:] != key[:-1]]
        rank = rank.copy()
        rank[tied] = np.maximum.accumulate(np.where(new, slots, 0))
        levels.append(rank)
        span *= 2


def longest_repeats(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every position the length of the longest text from there on that occurs elsewhere in its document."""
    n = len(words)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    order, levels = suffix_ranks(words, ends)
    left, right = order[:-1], order[1:]
    near = np.flatnonzero(levels[0][left] == levels[0][right])
    left, right = left[near], right[near]
    lcp = np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + lcp, right + lcp
        inside = (a < ends[left]) & (b < ends[right])
        same = inside & (levels[k][np.where(inside, a, 0)] == levels[k][np.where(inside, b, 1)])
        lcp += same * (1 << k)
    np.maximum.at(found, left, lcp)
    np.maximum.at(found, right, lcp)
    return found


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in the union of the spans."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def maximal_repeats(found: np.ndarray, firsts: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the repeats of at least min_words words that don't continue one from the word before."""
    before = np.r_[0, found[:-1]]
    before[firsts] = 0
    starts = np.flatnonzero((found >= min_words) & (before <= found))
    return starts, found[starts]


def measure(texts: list[str | None], min_words: int) -> pd.DataFrame:
    """The counts of some documents, sorted together."""
    split = [(t or "").encode().split() for t in texts]  # bytes split at the six white-space characters only
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    firsts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split for w in ws), np.int64, n)
    document = np.repeat(np.arange(len(split)), sizes)
    found = longest_repeats(document * (len(numbers) + 1) + ids, np.repeat(firsts + sizes, sizes))
    nonempty = firsts[sizes > 0]
    starts, lengths = maximal_repeats(found, nonempty, min_words)
    windows = np.flatnonzero(found >= WINDOW)
    per_document = lambda flags: np.bincount(document[flags], minlength=len(split))
    longest = np.zeros(len(split), np.int64)
    np.maximum.at(longest, document, found)
    return pd.DataFrame(
        {
            "n_words": sizes,
            "word_chars": [len(t or "") - sum(map((t or "").count, WHITE)) for t in texts],
            "n_symbols": [sum(map((t or "").count, SYMBOLS)) for t in texts],
            "n_dup_lines": [duplicate_lines(t or "") for t in texts],
            "n_repeat_words": per_document(covered(windows, np.full(len(windows), WINDOW), n)),
            "covered_words": per_document(covered(starts, lengths, n)),
            "n_maximal_repeats": np.bincount(document[starts], minlength=len(split)),
            "longest_repeat": longest,
        }
    ).astype("int64")


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def repeated_spans(text: str | None, min_words: int) -> list[tuple[int, int]]:
    """The union of a text's maximal repeats as spans of word numbers, ends exclusive."""
    split = (text or "").encode().split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in split), np.int64, len(split))
    found = longest_repeats(ids, np.full(len(ids), len(ids)))
    starts, lengths = maximal_repeats(found, np.zeros(min(1, len(ids)), np.int64), min_words)
    edges = np.diff(np.r_[0, covered(starts, lengths, len(ids)).astype(np.int8), 0])
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("covered_words", "n_maximal_repeats", "longest_repeat")
MEASURES = T.StructType(
    [T.StructField(c, T.LongType()) for c in BASE]
    + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
    + [T.StructField(c, T.LongType()) for c in MORE]
)


def judge_repetition(
    docs: DataFrame, text: str = "text", min_words: int = 8, max_covered: float = 0.3, max_longest: int = 50
) -> DataFrame:
    """Every column of docs and the measures; measures replace columns of docs that have their names (text may not be one).

    min_words: shortest repeat that counts as covered. max_covered: largest covered part of the words, below the base rules' half, as covered words also
    lie in repeated windows. max_longest: longest repeat in words.
    """
    names = {f.name.lower() for f in MEASURES}
    kept_columns = [c for c in docs.columns if c.lower() not in names]
    schema = T.StructType([f for f in docs.schema if f.name in kept_columns] + MEASURES.fields)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(kept_columns.index(text)).to_pylist()
            for a, b in slices(texts, RUN_CHARS):
                out = measure(texts[a:b], min_words)
                out["base_failed"] = (out.n_words < MIN_WORDS) | (100 * out.n_repeat_words > MAX_WINDOW_PERCENT * out.n_words)
                fails = (out.covered_words > max_covered * out.n_words) | (out.longest_repeat > max_longest)
                out["kept"] = ~(out.base_failed | fails)
                yield extended(batch.slice(a, b - a), MEASURES, out)

    return docs.select(*[F.col(f"`{c}`") for c in kept_columns]).mapInArrow(judge, schema)


def op1_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_repetition(docs).drop("text")
