"""The registered corpus queries: each operator over its whole table, with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hazardline.llm import bpe, decontam, feistel, imatch, langid, linedup, mil, neardup, pack, repair, runs, shard, warc
from hazardline.llm.common import table

#: Byte limit of the registered shards: a read of a few thousand documents, which tables of a few MB already split on.
SHARD_BYTES = 1 << 20

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document, windows of ten words."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on four-word shingles at a similarity of 0.8."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how near these and the next ones are."""
    return imatch.compare_edited(table(spark, sf_dir, "documents"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their validated numbers, dates and addresses replaced by keyed pseudonyms."""
    return feistel.pseudonymise(table(spark, sf_dir, "documents"), key="hazardline")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside fold 2 of 4."""
    return langid.identify_held_out(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the public 50k byte-level vocabulary."""
    return bpe.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of at most 1 MiB of text."""
    return shard.assign(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 tokens and shorter tiers."""
    return pack.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated windows of three lines."""
    return linedup.dedup_report(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from labels outside fold 0 of 5."""
    return mil.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after planted damage, with what ails them and their cheapest repair."""
    return repair.report(table(spark, sf_dir, "conversations"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, written as whole gzip streams, normalised to a member each, and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and its text without their repeats."""
    return runs.report(table(spark, sf_dir, "documents"))


CORPUS_QUERIES: dict[str, Query] = {
    "op1_decontaminate": (op1_decontaminate, decontam.REPORT_SQL),
    "op2_near_duplicates": (op2_near_duplicates, neardup.GROUPS_SQL),
    "op3_fingerprints": (op3_fingerprints, imatch.compare_sql()),
    "op4_pseudonyms": (op4_pseudonyms, None),
    "op5_language": (op5_language, None),
    "op6_token_counts": (op6_token_counts, None),
    "op7_shards": (op7_shards, shard.assign_sql(SHARD_BYTES)),
    "op8_pack": (op8_pack, None),
    "op9_line_dedup": (op9_line_dedup, linedup.REPORT_SQL),
    "op10_quality": (op10_quality, None),
    "op11_repair": (op11_repair, repair.report_sql()),
    "op12_warc": (op12_warc, warc.ROUND_TRIP_SQL),
    "op13_periodic_runs": (op13_periodic_runs, None),
}
