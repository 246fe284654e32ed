"""From raw documents to packed training windows: quality, repeated lines, near duplicates, benchmark leaks, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hazardline.llm import decontam, linedup, mil, neardup, pack
from hazardline.llm.common import cut, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Null and empty texts are scored like others, long ones whole.

    Rows with one text share one fate; without labels all stay; an empty table stays empty. The rows are written to the
    shared folder here, in small batches, whoever reads them: batches of whole texts are held beside an executor's heap.
    """
    return cut(mil.keep_good(docs, table(spark, sf_dir, "labels")), "quality")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat three at a time; a text may become empty, a null one stays null."""
    return linedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8. Texts without words are in no group.

    The smallest doc_id stays, a null one last, ties by the text's hash; of rows that repeat id and text one stays.
    """
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's words; a document that is mostly benchmark goes.

    Null and empty texts pass unchanged; each row is decided by its own text, repeated rows alike.
    """
    return decontam.remove_matches(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of at most 1024 tokens.

    A null or empty text is its end mark alone; repeated rows are documents of their own; long texts are cut into windows.
    """
    return pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The first stage is a learned classifier, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage returns is written to the shared folder and read by the next.

    Columns beyond those of ``documents`` pass through all but the last stage; empty tables pass too.
    """
    docs = quality(spark, table(spark, sf_dir, "documents"), sf_dir)  # written by the stage
    for name, stage in STAGES[1:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE = {"pipeline": (run, ORACLE_SQL)}
