"""What the corpus operators share: tables, lineage cuts, Arrow mapping, byte classes, fold rules."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazardline.session import shared_folder

#: Bytes of UTF-8 that stay in a word of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lower-cased; others become a space.
WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256)
)
#: Lower-cases A-Z and leaves every other byte.
LOWER_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Bytes of a batch of rows on its way to a Python worker. The JVM holds a batch while it is filled, and the worker holds
#: it with what it makes of it, both beside the heap.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While an action runs, rows go to Python workers in batches of ``BATCH_BYTES``; the session's setting is then put back."""
    before = spark.conf.get(_BATCH_SETTING, None)
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SETTING)
        else:
            spark.conf.set(_BATCH_SETTING, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back, so that later steps neither repeat its
    work nor depend on executors that may be lost."""
    spark = df.sparkSession
    where = shared_folder(spark, name)
    with small_batches(spark):
        df.write.parquet(where)
    return spark.read.schema(df.schema).parquet(where)


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    return df.mapInArrow(work, schema)


#: The one large thing that this worker holds from task to task.
_HELD: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept for the next task of this worker. What the worker held under another key goes first, so
    a worker that passes from one step to the next never holds the large things of both."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Drops what earlier tasks of this worker held."""
    _HELD.clear()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def fold(doc_id: Column, parts: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``parts``. A null id has fold null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def text_key(text: Column) -> list[Column]:
    """Two longs that stand for a text; equal texts agree, others differ but with the odds of a 128-bit collision."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def sample_by_label(rows: DataFrame, label: str, size: int) -> DataFrame:
    """About ``size`` of ``rows`` (doc_id, label), the same number of each label as far as there are so many.

    A row is drawn by a hash of its doc_id, with the odds that give its label its share; the odds are one small row per
    label. Rows without a label or an id are left out.
    """
    rows = rows.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return rows
    share = size / len(counts)
    odds = rows.sparkSession.createDataFrame(
        [(k, min(1.0, share / n)) for k, n in counts.items()], f"{label} {dict(rows.dtypes)[label]}, odds_ double"
    )
    drawn = F.xxhash64(F.lit(31), "doc_id").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    return rows.join(F.broadcast(odds), label).where(drawn < F.col("odds_")).drop("odds_")
