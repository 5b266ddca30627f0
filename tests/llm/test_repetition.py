import random
import re

import numpy as np

from loadsieve.llm import QUERIES
from loadsieve.llm.repetition import judge_repetition, longest_repeats, maximal_repeats, measure, repeated_spans
from tests.llm.conftest import LONG

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_longest(words):
    def common(i, j):
        k = 0
        while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
            k += 1
        return k

    return [max((common(i, j) for j in range(len(words)) if j != i), default=0) for i in range(len(words))]


def brute_measure(text, min_words):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    longest = brute_longest(words)
    covered = {i + d for i, n in enumerate(longest) if n >= min_words for d in range(n)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return [
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(repeated),
        len(covered),
        max(longest, default=0),
    ]


def test_longest_repeats_of_several_documents_sorted_together():
    draw = random.Random(5)
    for _ in range(60):
        documents = [[draw.randrange(draw.choice([1, 2, 5])) for _ in range(draw.randrange(0, 40))] for _ in range(draw.randrange(1, 6))]
        sizes = [len(d) for d in documents]
        words = np.array([w + 10 * i for i, d in enumerate(documents) for w in d], np.int64)
        ends = np.repeat(np.cumsum(sizes), sizes)
        assert longest_repeats(words, ends).tolist() == [n for d in documents for n in brute_longest(d)]


def test_maximal_repeats_cover_what_all_repeats_cover():
    draw = random.Random(6)
    for _ in range(40):
        words = [draw.choice("ab") for _ in range(draw.randrange(1, 50))]
        found = np.array(brute_longest(words))
        starts, lengths = maximal_repeats(found, np.array([0]), 3)
        covered = {i + d for i, n in enumerate(found) if n >= 3 for d in range(n)}
        assert {s + d for s, n in zip(starts, lengths) for d in range(n)} == covered
        assert {i for a, b in repeated_spans(" ".join(words), 3) for i in range(a, b)} == covered


def test_measures_against_brute_force(docs):
    texts = [r.text for r in docs.where("length(text) < 4000").select("text").limit(60).collect()]
    texts += [None, "", " \n", "a b c a b c", "x\nx\n\nx", "é | $ é | $", "a\x85b a\x85b a\x85b a\x85b"]
    got = measure(texts, 8)[["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]]
    assert got.values.tolist() == [brute_measure(t, 8) for t in texts]


def test_edges(edge, nothing):
    got = judge_repetition(edge)
    assert got.columns[:4] == ["doc_id", "text", "lang", "source"] and got.columns.count("kept") == 1 and "size" in got.columns
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert got.count() == edge.count()
    for (_, text), r in rows.items():
        if text is None or text.strip() == "":
            assert (r.n_words, r.base_failed, r.kept) == (0, True, False)
    long = next(r for (_, t), r in rows.items() if t == LONG)
    assert long.n_words == 30_000 and not long.base_failed
    assert judge_repetition(nothing).count() == 0


def test_query(spark, sf_dir, docs):
    got = QUERIES["op1_suffix_array_repetition"](spark, sf_dir)
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count()
    for r in docs.where("length(text) < 2000").collect():
        n_words, _, _, _, n_repeat, covered, longest = brute_measure(r.text, 8)
        failed = n_words < 50 or 100 * n_repeat > 50 * n_words
        assert rows[r.doc_id].base_failed == failed
        assert rows[r.doc_id].kept == (not failed and covered <= 0.5 * n_words and longest <= 100)


def test_each_limit_rejects_documents_that_pass_the_base_rules(spark):
    fresh = iter(range(10_000))
    new = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    a, b, long, fine = new(40), new(40), new(60), new(50)
    texts = {
        "covered": [*a, *new(100), *b, *new(100), *a, *new(40), *b],  # 160 of 400 words, longest 40
        "longest": [*long, *new(880), *long],  # 120 of 1,000 words, longest 60
        "neither": [*fine, *new(300), *fine],  # 100 of 400 words, longest 50
    }
    rows = {r.doc_id: r for r in judge_repetition(spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id string, text string")).collect()}
    assert [(rows[k].n_words, rows[k].covered_words, rows[k].longest_repeat) for k in texts] == [(400, 160, 40), (1000, 120, 60), (400, 100, 50)]
    assert not any(r.base_failed for r in rows.values())
    assert [rows[k].kept for k in texts] == [False, False, True]
