"""The corpus pipeline: language ID, near-dedup, suffix-array dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again before the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontamination, language_id, near_dedup, source_mixing, suffix_dedup
from tickloom.llm.common import lasting, scratch, table
from tickloom.llm.queries import PIECE_VOCAB

#: Least words of a passage that is cut, and bytes that such passages have in common at least (fifty-one words of
#: four letters, and blanks).
PASSAGE_WORDS, PASSAGE_BYTES = 51, 250


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return language_id.keep_identified(docs, PIECE_VOCAB)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return near_dedup.one_per_class(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over fifty words that stand elsewhere too leave the texts; no document goes."""
    return suffix_dedup.without_repeats(docs, length=PASSAGE_BYTES, least_words=PASSAGE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, as often as it takes them."""
    return source_mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("near_dedup", one_of_each),
    ("suffix_dedup", cut_repeats),
    ("decontamination", decontaminate),
    ("source_mixing", mix),
]

#: The stages learn models and rank by hashes of texts they have cut: SQL does not express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch(spark):
            docs = lasting(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
