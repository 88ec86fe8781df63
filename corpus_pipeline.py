"""A corpus pipeline: language, exact copies, near copies, benchmark leaks, packing.

Every stage is a function of (spark, docs, folder of tables); its result is written as
Parquet and is the next one's ``docs``.  All but the last return the columns of
``documents``.  Statistics, models and groups are made from the stage's own input.

Documents are dropped only for what the stage is about: no language or one in doubt; a
copy of a document that stays; a benchmark item in the text.  Nulls, empty texts, ties,
repeated rows and empty tables are handled as the operators' modules say.  SQL cannot
express the language, near-copy and packing stages, so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.decontamination import without_leaks
from clickloom.llm.exact_dedup import without_copies
from clickloom.llm.language import with_language
from clickloom.llm.near_duplicates import without_near_duplicates
from clickloom.llm.packing import pack
from clickloom.llm.shared import table, written
from clickloom.session import ship_package

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
