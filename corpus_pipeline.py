"""The training-corpus pipeline over ``documents``: quality rules, near-dedup, removal of
repeated passages, mixing to source weights, and encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read back as the next stage's ``docs``. All stages but the last return the columns of
``docs``. Every stage works on all rows that the one before it kept.

A stage removes what the stage before has written for itself (its output is in ``docs`` by then;
files that ``docs`` still reads stay), so the shared folder holds one stage's intermediates. One
pipeline runs at a time in an application.

Edge cases: nulls in any column, empty and very long texts, repeated rows and rows without an id go
through every stage as its operator defines; columns beyond those of ``documents`` are kept up
to the encoding (near-dedup and suffix dedup need the names ``__block`` and ``__row`` for
themselves); an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowmart.llm import minhash_dedup, mixing, quality, sentencepiece_bpe, suffix_dedup
from flowmart.llm.common import collecting, release, stage, table

Step = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Per application: the folders that the last stage has written for itself.
_MADE: dict[str, list[str]] = {}


def _tidy(step: Step) -> Step:
    """``step`` without what the one before it has left."""

    @functools.wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        paths = _MADE.setdefault(spark.sparkContext.applicationId, [])
        release(spark, paths, docs)
        with collecting(paths):
            return step(spark, docs, sf_dir)

    return run


@_tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far from their language and source go."""
    return quality.keep_good(docs)


@_tidy
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: the one with the smallest id."""
    return minhash_dedup.keep_one(docs)


@_tidy
def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that an earlier document holds are cut out."""
    return suffix_dedup.drop_repeats(docs)


@_tidy
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source gets its share: documents are left out, taken once or twice, or cut."""
    return mixing.mix(docs)


@_tidy
def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, decoded) of every document of the mix."""
    return sentencepiece_bpe.encode_documents(docs, sentencepiece_bpe.model_path())


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("mixing", mixing_stage),
    ("encode", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table, each written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Robust fits, MinHash and tokenisation have no SQL form; tests/llm checks the stages against
#: brute force.
ORACLE_SQL = None
