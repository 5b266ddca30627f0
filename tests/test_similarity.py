"""Similarity on arrays against the measure itself, pair by pair."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from loadsieve.functions.similarity import Pairs, best_positions, ratios, suggested


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


def words(draw, letters, longest, n):
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("letters,longest", [("ab", 12), ("abcdefghij0123", 30), ("aé𝄞\0 ñ", 9), ("abc", 230)])
def test_ratios_are_those_of_the_measure(letters, longest):
    draw = random.Random(longest)
    n = 1500 if longest < 100 else 60
    left, right = words(draw, letters, longest, n), words(draw, letters, longest, n)
    assert ratios(left, right).tolist() == [ratio(a, b) for a, b in zip(left, right)]


def test_known_asymmetry_and_empties():
    assert ratios(["tide", "diet", "", "a", ""], ["diet", "tide", "", "", "b"]).tolist() == [0.25, 0.5, 1.0, 0.0, 0.0]
    assert len(ratios([], [])) == 0


def test_bounds_are_upper_bounds():
    draw = random.Random(3)
    left, right = words(draw, "abcdeñ\x80\xc0", 15, 400), words(draw, "abcdeñ\x80\xc0", 15, 400)
    pairs = Pairs()
    a = [pairs.left.setdefault(x, len(pairs.left)) for x in left]
    b = [pairs.right.setdefault(x, len(pairs.right)) for x in right]
    assert (pairs.bounds(a, b) >= np.array([ratio(x, y) for x, y in zip(left, right)]) - 1e-12).all()


def test_first_best_above_the_threshold_with_few_comparisons():
    draw = random.Random(4)
    targets = words(draw, "abcdefghijklmn", 12, 60) + ["fechapedido", "fechapedidos", "pedidofecha"]
    asked = [(k, targets) for k in [*words(draw, "abcdefghijklmn", 12, 200), "fechapedid", "", "fechpedidos"]] + [("x", [])]
    found, compared = best_positions(asked, 0.78 - 1e-12)
    for (key, candidates), (at, worth) in zip(asked, found):
        scores = [ratio(key, c) for c in candidates]
        best = max(scores, default=0)
        assert (at, worth) == ((scores.index(best), best) if best >= 0.78 - 1e-12 else (-1, 0.0))
    assert compared < len(asked) * len(targets) / 20


def test_suggestions_with_few_comparisons():
    draw = random.Random(5)
    keys = words(draw, "abcdefgh", 10, 40) + ["importe", "importetotal", ""]
    asked = [(t, keys) for t in [*words(draw, "abcdefgh", 10, 80), "importetotaleur", "imp", ""]] + [("solo", [])]
    found, compared = suggested(asked)
    for (target, candidates), (at, worth) in zip(asked, found):
        scores = [max(ratio(k, target), 0.75 if k and target and (k in target or target in k) else 0.0) for k in candidates]
        best = max(scores, default=0)
        assert (at, worth) == ((scores.index(best), best) if best > 0 else (-1, 0.0))
    assert compared < sum(len(c) for _, c in asked) / 2
