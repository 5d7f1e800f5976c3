"""The corpus pipeline: from documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's documents. All stages but
the last return the columns of documents, whatever these are called.

Defined cases, for every stage: texts of any length count whole; a null id is an
id like others; an empty table stays empty; nulls in columns that a stage does
not read change nothing. Null and empty texts go in the language stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from locusflow.llm.common import saved
from locusflow.llm.compression_quality import keep_good
from locusflow.llm.language_id import keep_identified
from locusflow.llm.packing import pack
from locusflow.llm.simhash_bk import keep_first
from locusflow.llm.suffix_dedup import remove_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known main language stay.

    Null and empty texts, and texts without a letter, have none. Repeated rows stay or go together.
    """
    return keep_identified(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the compression bands stay; each row is judged by its own text, null counts as empty and goes."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Rows that repeat id and text are one document; of texts with one id the first by hash stays; null and empty texts
    are one group.
    """
    return keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that occur again anywhere are taken out; all rows stay.

    Null texts stay null; of repeated rows each loses its text from 200 bytes on.
    """
    return remove_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of the permitted lengths; null and empty texts are one end mark, repeated rows are
    packed each, equal lengths go in order of id."""
    return pack(docs)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: No stage's rows can be had from SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
