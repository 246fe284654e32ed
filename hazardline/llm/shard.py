"""Shards by extendible hashing.

A directory is indexed by the leading bits of a document's hash. It starts as one bucket; a bucket over its byte limit
splits on the next bit, all others stay, until each fits. Bytes are first summed per cell of a fine prefix, so that only
sums are shuffled to build the directory; cells that are still too large are opened by further bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import cut

#: Bytes of text in a shard.
LIMIT = 64 * 1024 * 1024
#: Bits of the hash, and further bits that a round opens beyond the depth expected of even buckets.
BITS, AHEAD = 60, 6
#: Rows of a directory that may be broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits from the id and the text."""
    id_text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(id_text, F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))), 1, 15), 16, 10).cast("long")


def _prefix(value: Column, depth: int) -> Column:
    return F.shiftright(value, BITS - depth)


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, depth, shard (the bucket's bits as text, empty for depth 0), shard_bytes, oversize for each row.

    A bucket is split while it holds more than ``limit`` bytes and documents of different hashes. What can't be split, a
    single text over the limit or rows that repeat id and text, stays together and is marked ``oversize``. A null or
    empty text has no bytes; a null id is hashed as an empty one. Other columns are left out; an empty table gives no
    rows.
    """
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    rows = cut(docs.select("doc_id", size.alias("n_bytes"), document_hash(F.col("doc_id"), F.col("text").cast("string")).alias("h")), "hashes")
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    depth = max(0, -(-total // limit) - 1).bit_length()
    left, placed, start = rows, None, 0
    while True:
        end = min(BITS, max(depth, start) + AHEAD)
        cells = left.groupBy(_prefix(F.col("h"), end).alias("cell")).agg(F.sum("n_bytes").alias("b"), F.min("h").alias("low"), F.max("h").alias("high"))
        level = cells.withColumn("depth", F.explode(F.sequence(F.lit(start), F.lit(end)))).withColumn(
            "bucket", F.call_function("shiftright", F.col("cell"), (F.lit(end) - F.col("depth")).cast("int"))
        )
        sums = level.groupBy("depth", "bucket").agg(F.sum("b").alias("shard_bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("low") == F.col("high")) | (F.col("depth") == BITS)).drop("low", "high")
        chosen = level.select("cell", "depth", "bucket").join(fits, ["depth", "bucket"]).groupBy("cell").agg(
            F.min(F.struct("depth", "bucket", "shard_bytes")).alias("at")
        )
        chosen = cut(chosen, "directory")
        keyed = left.withColumn("cell", _prefix(F.col("h"), end))
        known = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
        found = keyed.join(known, "cell").select("doc_id", "n_bytes", "at")
        placed = found if placed is None else placed.union(found)
        left = keyed.join(known, "cell", "left_anti").drop("cell")
        if end == BITS or left.isEmpty():
            break
        start = end + 1
    bits = F.when(F.col("at.depth") > 0, F.right(F.lpad(F.bin("at.bucket"), 64, "0"), F.col("at.depth"))).otherwise(F.lit(""))
    return placed.select(
        "doc_id", "n_bytes", F.col("at.depth").cast("int").alias("depth"), bits.alias("shard"),
        F.col("at.shard_bytes").alias("shard_bytes"), (F.col("at.shard_bytes") > limit).alias("oversize"),
    )


def assign_sql(limit: int = LIMIT, deepest: int = 40) -> str:
    """:func:`assign` as DuckDB SQL, for buckets of at most ``deepest`` bits."""
    return f"""
WITH h AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) h FROM documents),
d AS (SELECT *, h >> ({BITS} - d) bucket FROM h, unnest(range(0, {deepest + 1})) u(d)),
s AS (SELECT d, bucket, sum(n_bytes) b FROM d GROUP BY ALL HAVING sum(n_bytes) <= {limit} OR min(h) = max(h)),
m AS (SELECT doc_id, h, n_bytes, min(d) d FROM d JOIN s USING (d, bucket) GROUP BY ALL)
SELECT doc_id, n_bytes, CAST(m.d AS INTEGER) depth, CASE WHEN m.d = 0 THEN '' ELSE right(lpad(bin(h >> CAST({BITS} - m.d AS BIGINT)), 64, '0'), CAST(m.d AS INTEGER)) END shard,
  CAST(b AS BIGINT) shard_bytes, b > {limit} oversize
FROM m JOIN s ON s.d = m.d AND s.bucket = m.h >> CAST({BITS} - m.d AS BIGINT)
"""
