"""Small documents with everything that operators must bear."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, score string, entities string, found string"
# names that operators use or used inside; they pass through like any other
INTERNAL = ["_hash", "_edits", "_copies", "_copy", "_one", "_two", "kinds", "_points", "n_words", "one", "two", "times", "copy", "edits", "text_hash", "own_hash", "own_kinds", "other_id", "other_hash", "points", "whole"]
DOC_SCHEMA += "".join(f", `{c}` string" for c in INTERNAL)
LONG = " ".join(f"w{i % 5003}x{i % 7}" for i in range(30_000))


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), *["mine"] * (5 + len(INTERNAL)))


EDGE = [
    row(1, "one two three four five six seven eight nine ten"),
    row(1, "one two three four five six seven eight nine ten"),
    row(2, None),
    row(3, ""),
    row(4, " \t\n\x0b\x0c\r "),
    row(5, LONG, "b"),
    row(6, "ONE Two Three four\x85five six seven\xa0eight nine ten", None),
    row(None, "token: 'abcdefghijkl0123' é", None),
    row(None, "token: 'abcdefghijkl0123' é", None),
    row(7, "x", "b"),
    row(8, "say again say again\nsay again say again\nsay again say again", "𝄞"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
