"""The training-data pipeline: each stage's rows are written and read again as the next one's documents.

All stages but the last return the columns of documents; n_chars follows the text. Null texts and languages, empty and very long texts,
repeated rows, null doc_ids and empty tables are taken as the stages' operators say. A stage's result must be stored before the next
stage starts, which drops the tables that the stage before worked with.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliovent.llm.language_id import keep_identified
from heliovent.llm.ngram_join import one_of_each
from heliovent.llm.packing import pack_documents
from heliovent.llm.pii import without_private
from heliovent.llm.queries import importable
from heliovent.llm.storage import Scratch, stored
from heliovent.llm.suffix_dedup import without_repeats


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


# By application: what the stage before made on its way.
_LEFT: dict[str, Scratch] = {}


def _stage(make):
    """A stage: its tables stay until the next one starts, by when its result is stored."""

    @functools.wraps(make)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        application = spark.sparkContext.applicationId
        if application in _LEFT:
            _LEFT.pop(application).drop(spark)
        with Scratch() as own:
            out = make(spark, docs, sf_dir)
        _LEFT[application] = own
        return out

    return stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled ones go on; those without a letter or a text go."""
    return keep_identified(docs)


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by word n-grams the first goes on; rows of one doc_id stay or go together."""
    return one_of_each(docs)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are taken out; a document of nothing else stays as an empty one."""
    return _counted(without_repeats(docs))


@_stage
def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the names of their kinds; an empty text stays empty."""
    return _counted(without_private(docs))


@_stage
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences for training; an empty text is the end token alone."""
    return pack_documents(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("private_data", private_data),
    ("sequences", sequences),
]

ORACLE_SQL = None  # several stages cannot be said in SQL; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = Scratch()
    for _, stage in STAGES[:-1]:
        with Scratch() as own:
            docs = stored(stage(spark, docs, sf_dir))
        before.drop(spark)
        before = own
    return STAGES[-1][1](spark, docs, sf_dir)
