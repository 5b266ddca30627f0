"""Parsers, keys and similarity on literal cases and against brute force."""

import datetime as dt
import random
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from loadsieve.functions import parsers as P
from loadsieve.functions import similarity as S
from loadsieve.functions import text as X

D = dt.date


def values(spark, texts, parse):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    return [r[1] for r in df.select("i", parse(F.col("t"))).orderBy("i").collect()]


CASES = [
    (P.parse_period, ["ene-24", "dic/2025", "invalido"], [D(2024, 1, 1), D(2025, 12, 1), None]),
    (P.parse_period, ["ene/97", "jul/97", "MAY24", "feb-0050"], [D(2097, 1, 1), D(2097, 7, 1), D(2024, 5, 1), D(2050, 2, 1)]),
    (P.parse_number, ["1.234,56", "1234,56", "np.float64(12.5)", "x"], [1234.56, 1234.56, 12.5, None]),
    (P.parse_number, ["1,234,567", "1,234.56", "5f", "1_000", "0x10", "True"], [None, 1.23456, None, None, None, None]),
    (P.parse_number, ["inf", "-Infinity", " 7 ", ".5", "5.", "1e3", "NaN"], [float("inf"), float("-inf"), 7.0, 0.5, 5.0, 1000.0, None]),
    (P.parse_number, ["np.float64(np.int64(3))", "np.int64(np.float64(3))", "np.float64(5))"], [3.0, None, None]),
    (P.parse_number_v1, ["1.234,56", "12.5"], [None, 12.5]),
    (P.parse_bool, ["si", "no", "1", "0", "talvez", " SÍ "], [True, False, True, False, None, True]),
    (P.parse_serial_date, ["1", "46958", "73050", "73051", "0.5"], [D(1899, 12, 31), D(2028, 7, 24), D(2099, 12, 31), None, None]),
    (P.parse_date_unbounded, ["2024", "2958465", "2958466", "31/04/2024", "5-6-9999"], [D(1905, 7, 16), D(9999, 12, 31), None, None, D(9999, 6, 5)]),
    (P.parse_date_unbounded, ["0000-01-01", "1_000", "2024-05-06 99:99:99", "ene-24"], [None, D(1902, 9, 26), D(2024, 5, 6), None]),
    (P.parse_date, ["03/04/2024", "2024-05-06", "3-4-2024", "31/02/2024", "2024-02-30", "0000-01-01"], [D(2024, 4, 3), D(2024, 5, 6), D(2024, 4, 3), None, None, None]),
    (P.parse_date, ["03/04/2024 10:00:00", "2024-05-06 24:00:00", "03/04/24", "20240506"], [D(2024, 4, 3), None, None, None]),
    (P.parse_timestamp, ["03/04/2024 10:20:30", "46958.5", "2024-05-06"], [dt.datetime(2024, 4, 3, 10, 20, 30), dt.datetime(2028, 7, 24, 12), dt.datetime(2024, 5, 6)]),
]


@pytest.mark.parametrize("parse,texts,expected", CASES)
def test_parsers(spark, parse, texts, expected):
    assert values(spark, texts, parse) == expected


def test_default_literals(spark):
    texts = ["false", "true", "'abc'::text", "42", "3.14", "'it''s'", "now()", "nextval('s'::regclass)", "", None]
    got = values(spark, texts, P.parse_default_literal)
    assert [(r["kind"], r["value"]) for r in got] == [
        ("boolean", "false"), ("boolean", "true"), ("text", "abc"), ("integer", "42"), ("decimal", "3.14"),
        ("text", "it's"), (None, None), (None, None), (None, None), (None, None),
    ]


def test_clean_text(spark):
    texts = ["-", "--", "—", "–", "nan", "None", "N/A", "n/a", "", "\t  x 　", "NaN", "---"]
    assert values(spark, texts, X.clean_text) == [None] * 9 + ["x", "NaN", "---"]
    assert values(spark, ["-", "nan"], lambda c: X.clean_text(c, X.NULL_TOKENS_V1)) == ["-", None]


def brute_key(text):
    low = text.strip().lower()
    while "(" in low and ")" in low[low.index("("):]:
        start = low.index("(")
        low = low[:start] + " " + low[low.index(")", start) + 1:]
    return "".join(c for c in unicodedata.normalize("NFKD", low) if c in "abcdefghijklmnopqrstuvwxyz0123456789")


def test_keys_equal_unicode_decomposition(spark):
    rng = random.Random(1)
    pool = "abcXYZ 0129_-.()ñÑáéÍóüçßøłĳ½²№ﬁⅷ㎏①Ａ̧́'ÅŒœ…€日ー"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 24))) for _ in range(3000)]
    got = values(spark, texts, X.canonical_key)
    assert got == [brute_key(t) for t in texts] == [X.canonical_key_py(t) for t in texts]


def test_every_single_character_key(spark):
    chars = [chr(cp) for cp in range(1, 0x3400) if not 0xD800 <= cp < 0xE000]
    got = values(spark, ["a" + c + "b" for c in chars], X.canonical_key)
    assert [g for g in got] == [brute_key("a" + c + "b") for c in chars]


def test_snake_name(spark):
    assert values(spark, ["  Año (EUR) - Núm. 2 "], X.snake_name) == ["ano_num_2"]


def test_similarity(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 12)))
    pairs = [("tide", "diet"), ("diet", "tide"), ("", "")] + [(word(), word()) for _ in range(500)]
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    rows = df.select("a", "b", S.similarity("a", "b").alias("r"), S.length_bound(F.col("a"), F.col("b")).alias("m")).collect()
    assert [r["r"] for r in rows[:2]] == [0.25, 0.5]
    assert all(r["r"] == SequenceMatcher(None, r["a"], r["b"]).ratio() <= r["m"] for r in rows)


def test_best_match_equals_full_search(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9)))
    targets = [word() for _ in range(40)]
    keys = [word() for _ in range(400)]
    df = spark.createDataFrame([(k,) for k in keys], "k STRING")
    best = S.best_of(F.col("k"), X.text_array(targets), 0.6)
    for row in df.select("k", best.alias("b")).collect():
        ratios = [SequenceMatcher(None, row["k"], t).ratio() for t in targets]
        top = max(ratios)
        assert row["b"]["position"] == (ratios.index(top) if top >= 0.6 else -1)


def test_storage_values(spark):
    assert values(spark, [" np.float64(12.5) ", "np.int64(7)", "np.float64(x)", " a "], P.storage_text) == ["12.5", "7", "np.float64(x)", "a"]
    numbers = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.5,), (None,)], "n DOUBLE")
    assert [r[0] for r in numbers.select(P.storage_number(F.col("n"))).collect()] == [None, None, 1.5, None]
