"""Rows met with ordered points in tiles: blocks of rows against blocks of points, both as tables.

Where every row has to be summed at many points, the points are a table of short sorted arrays. Spark joins rows and blocks
by their bounds (a broadcast of the blocks where they are few, else pairs of partitions), and what follows is summed per
point before any shuffle. No list of points passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.operators.scans import broadcast_small, ordered_scan, position

BLOCK = 256  # points of a block
BROADCAST_BLOCKS = 2048  # blocks up to this many are sent to every task: half a million points


@dataclass(frozen=True)
class Blocks:
    """The kept table ``lo, hi, points``, and the same as it is joined."""

    table: DataFrame
    joined: DataFrame

    def release(self) -> None:
        self.table.unpersist()


def point_blocks(points: DataFrame, carry: Sequence[str] = (), **scan) -> Blocks:
    """The rows of ``points`` (``time``, distinct, and ``carry``) in sorted arrays of ``BLOCK``."""
    placed = ordered_scan(points.select("time", *carry), [], ["time"], {"_at": position()}, **scan)
    blocks = placed.groupBy(F.floor((F.col("_at") - 1) / BLOCK).alias("_block")).agg(
        F.min("time").alias("lo"), F.max("time").alias("hi"), F.array_sort(F.collect_list(F.struct("time", *carry))).alias("points")
    )
    table = blocks.drop("_block").persist()
    return Blocks(table, broadcast_small(table, BROADCAST_BLOCKS))


def spread(rows: DataFrame, of: Blocks, after: str, upto: str) -> DataFrame:
    """Each row once per point in (``after``, ``upto``], as ``at``; a null ``after`` lies before all points."""
    start, end, blocks = F.col(after), F.col(upto), of.joined
    met = rows.join(blocks, (end >= blocks["lo"]) & (start.isNull() | (start < blocks["hi"])))

    def inside(p: Column) -> Column:
        return (p["time"] <= end) & (start.isNull() | (p["time"] > start))

    return met.withColumn("_point", F.explode(F.filter("points", inside))).select(*rows.columns, F.col("_point.time").alias("at"))


def everywhere(rows: DataFrame, of: Blocks) -> DataFrame:
    """Each row once per point, with the point's columns: a stated set of points against all rows, in blocks."""
    met = rows.join(of.joined, of.joined["lo"].isNotNull())
    return met.withColumn("_point", F.explode("points")).select(*rows.columns, "_point.*")
