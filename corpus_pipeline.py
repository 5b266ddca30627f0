"""A corpus run from raw documents to packed sequences; each stage is written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsieve.llm.common import unused
from loadsieve.llm.mixing import mixed
from loadsieve.llm.packing import pack_pieces, token_pieces
from loadsieve.llm.repetition import MEASURES, judge_repetition
from loadsieve.llm.simhash import one_per_group
from loadsieve.llm.surrogates import replace_entities, secret_key
from loadsieve.session import saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the repetition rules keep."""
    whole, own = unused(MEASURES.names, "whole"), [F.col(f"`{c}`") for c in docs.columns]
    judged = judge_repetition(docs.select(F.struct(*own).alias(whole), F.col("text")))
    return judged.where("kept").select(f"{whole}.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by fingerprints of 3-word shingles within 2 bits."""
    return one_per_group(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates in place of personal data; n_chars, where there is one, follows the new text."""
    found = unused(docs.columns, "found")
    done = replace_entities(docs, secret_key(spark), name=found).drop(found)
    counted = {f.name: F.char_length("text").cast(f.dataType) for f in docs.schema if f.name == "n_chars"}
    return done.withColumns(counted).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix and their places in sequences."""
    return pack_pieces(token_pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("packing", packing),
]
# tokenizing and packing have no SQL; the tests hold the pipeline against a brute-force version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
