"""Ordered scans per key that stay parallel when one key holds a large share of the rows.

A plain window puts every row of a key in one task. That is the best plan while keys are
small, so it is what runs when no key is over ``PIECE`` rows. This is measured, not assumed:
once, at the source of a key, by :func:`measure_keys`, whose result is handed down to every scan.
Larger keys are cut along the whole order into pieces: cut points are quantiles of a sample of the
order tuples, so orders of any type and with constant leading columns are cut alike. The window
runs per piece; a summary of one row per large key and piece, summed up over the earlier or later
pieces, supplies what these contribute. Results are the same either way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE = 2_000_000  # a key up to this many rows is one window group; a larger one is cut into pieces of about half as many
SAMPLED = 32  # sampled rows a cut point stands for
SHORT = 128  # leading characters of a text that decide on its piece
FAN = 32  # parts, a power of two, into which a level of the search for a row's piece divides the cut points that are left


@dataclass(frozen=True)
class KeySizes:
    """The keys that hold more than ``floor`` rows (``keys`` and ``_n``), or None where no key does."""

    keys: tuple[str, ...]
    floor: int
    hot: DataFrame | None


@dataclass(frozen=True)
class Step:
    kind: str
    column: str | None = None


def fill_down(column: str) -> Step:
    """Last non-null value up to and including the row."""
    return Step("down", column)


def fill_up(column: str) -> Step:
    """First non-null value from the row on."""
    return Step("up", column)


def following(column: str) -> Step:
    """The value on the next row."""
    return Step("next", column)


def preceding(column: str) -> Step:
    """The value on the previous row."""
    return Step("prev", column)


def position() -> Step:
    """1, 2, 3 … within the key."""
    return Step("rank")


def running_sum(column: str) -> Step:
    return Step("run", column)


def remaining_sum(column: str) -> Step:
    """Sum from the row to the end of the key."""
    return Step("rest", column)


def running_product(column: str) -> Step:
    return Step("prod", column)


def key_max(column: str) -> Step:
    """The greatest value of the key, on every row."""
    return Step("max", column)


def measure_keys(df: DataFrame, keys: Sequence[str], floor: int = PIECE) -> KeySizes:
    """Counts the rows per key in one job and returns the large keys: at most one per ``floor`` rows.

    Take it where the key comes from, over the key columns of a table as read, and hand it down: joins to one row,
    filters and columns added later leave it an upper bound. Counts are combined before the shuffle and exact; a
    frequency sketch would ship as many bytes per task as it tracks keys, and still miss keys near the bound.
    """
    keys = list(keys)
    if not keys:
        n = df.count()
        return KeySizes((), floor, None if n <= floor else df.sparkSession.createDataFrame([(1, n)], "_all int, _n long"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > floor)
    rows = counts.collect()
    return KeySizes(tuple(keys), floor, df.sparkSession.createDataFrame(rows, counts.schema) if rows else None)


def _same_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> Column:
    """Joins on keys where null is a key like others; ``other`` has them as ``_k0``, ``_k1`` …"""
    return reduce(lambda a, b: a & b, [df[k].eqNullSafe(other[f"_k{i}"]) for i, k in enumerate(keys)])


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def _place(df: DataFrame, column: str) -> Column:
    """The order column as a double, for choosing cut points."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.col(column).cast("timestamp").cast("double")
    return F.col(column).cast("double")


def _order_key(order: Sequence[str]) -> Column:
    return F.struct(*[c for o in order for c in (F.col(o).isNull(), F.col(o))])


def _cut_key(df: DataFrame, order: Sequence[str]) -> Column:
    """The order tuple with texts shortened: rows in order have such tuples in order, and cut points stay small.

    Rows that differ only after a shortened text have one tuple, and so one piece.
    """
    parts, whole = [], F.lit(True)
    for i, o in enumerate(order):
        c = F.col(o)
        if isinstance(df.schema[o].dataType, (T.StringType, T.BinaryType)):
            short = F.coalesce(F.length(c) <= SHORT, F.lit(True))
            values = [F.substring(c, 1, SHORT), ~short]
        else:
            short, values = F.lit(True), [c]
        parts += [F.when(whole, v).alias(f"v{i}_{k}") for k, v in enumerate([c.isNull(), *values])]
        whole = whole & short
    return F.struct(*parts)


def _cut_points(df: DataFrame, keys: Sequence[str], place: Column, hot: DataFrame, floor: int) -> DataFrame:
    """Per large key (as ``_k0`` …) its sorted cut points ``_cuts``.

    Each stands for about ``floor / 2`` rows, so there are two for each ``floor`` rows of the table at most.
    """
    rate = min(1.0, 2.0 * SAMPLED / floor)
    large = _renamed(hot, keys)
    ids = [f"_k{i}" for i in range(len(keys))]
    drawn = df.where(F.rand(17) < rate).join(F.broadcast(large), _same_keys(df, large, keys)).select(*ids, place.alias("_at"))
    ranked = drawn.withColumn("_r", F.row_number().over(Window.partitionBy(*ids).orderBy("_at")))
    cuts = ranked.where(F.col("_r") % SAMPLED == 0).groupBy(*ids).agg(F.array_sort(F.array_distinct(F.collect_list("_at"))).alias("_cuts"))
    return df.sparkSession.createDataFrame(cuts.toArrow(), cuts.schema)  # drawn once: every use sees the same points


def _numbered_pieces(df: DataFrame, keys: Sequence[str], place: Column, cuts: DataFrame) -> DataFrame:
    """``df`` with the number of the piece a row is in, ``_seg``: the cut points of its key up to the row. ``_cut``: whether there are any.

    The cut points are a search tree. At each level a row meets the ``FAN - 1`` points that divide those left to it and is
    placed among them by halving, so its work grows with the logarithm of the number of cut points, and it never carries
    more than these few. Every comparison is a projection of its own: as one expression the code would double at each.
    """
    ids = [f"_k{i}" for i in range(len(keys))]
    points = cuts.select(*ids, F.posexplode("_cuts").alias("_i", "_seg_point")).withColumn("_i", F.col("_i") + 1)
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0
    large = cuts.select(*ids, F.lit(True).alias("_seg_large"))
    out = df.withColumn("_seg_at", place).join(F.broadcast(large), _same_keys(df, large, keys), "left").drop(*ids)
    out = out.withColumns({"_cut": F.col("_seg_large").isNotNull(), "_seg": F.lit(0)}).drop("_seg_large")
    stride = 1
    while stride * FAN <= most:
        stride *= FAN
    while stride:
        # a node holds every stride-th point after those before it, which the steps above have passed
        held = points.where((F.col("_i") % stride == 0) & (F.col("_i") % (stride * FAN) != 0))
        base = F.floor(F.col("_i") / (stride * FAN)).cast("int") * (stride * FAN)
        nodes = held.groupBy(*ids, base.alias("_seg_base")).agg(F.sort_array(F.collect_list("_seg_point")).alias("_seg_points"))
        met = _same_keys(out, nodes, keys) & (out["_seg"] == nodes["_seg_base"]) & out["_cut"]
        out = out.join(F.broadcast(nodes), met, "left").withColumn("_seg_in", F.lit(0))
        half = FAN // 2
        while half:
            reached = F.get("_seg_points", F.col("_seg_in") + (half - 1)) <= F.col("_seg_at")
            out = out.withColumn("_seg_in", F.col("_seg_in") + F.when(reached, half).otherwise(0))
            half //= 2
        out = out.withColumn("_seg", F.col("_seg") + F.col("_seg_in") * stride).drop("_seg_points", "_seg_base", "_seg_in", *ids)
        stride //= FAN
    return out.drop("_seg_at")


def _windowed(step: Step, up, down, whole) -> Column:
    before = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = step.column
    return {
        "down": lambda: F.last(c, ignorenulls=True).over(before),
        "up": lambda: F.last(c, ignorenulls=True).over(after),
        "next": lambda: F.lead(c).over(up),
        "prev": lambda: F.lag(c).over(up),
        "rank": lambda: F.row_number().over(up).cast("long"),
        "run": lambda: F.sum(c).over(before),
        "rest": lambda: F.sum(c).over(after),
        "prod": lambda: F.product(c).over(before),
        "max": lambda: F.max(c).over(whole),
    }[step.kind]()


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Step],
    *,
    floor: int = PIECE,
    bounded: bool = False,
    sizes: KeySizes | None = None,
) -> DataFrame:
    """Add one column per entry of ``outputs``, computed per key in ``order`` (ascending, nulls last).

    ``order`` must be total within a key, of any orderable types. A null key is a key like others.
    ``sizes`` hands over :func:`measure_keys` of these keys or of some of them; without it they are
    measured here, which reads ``df`` once more. ``bounded=True`` states that every key is known to
    stay small. Where a key is cut, ``df`` is read four times: keep it if it is dear.
    """
    keys = list(keys)
    if sizes is not None and sizes.hot is None and set(sizes.keys) <= set(keys) and (sizes.keys or not keys):
        bounded = True  # small by fewer keys is small by more
    if not bounded and (sizes is None or set(sizes.keys) != set(keys)):
        sizes = measure_keys(df, keys, floor)
    if not keys:
        df, keys = df.withColumn("_all", F.lit(1)), ["_all"]
    asc = [F.col(o).asc_nulls_last() for o in order]
    desc = [F.col(o).desc_nulls_first() for o in order]
    if bounded or sizes.hot is None:
        w = Window.partitionBy(*keys)
        out = df.withColumns({n: _windowed(s, w.orderBy(*asc), w.orderBy(*desc), w) for n, s in outputs.items()})
        return out.drop("_all")

    place = _cut_key(df, order)
    cuts = _cut_points(df, keys, place, sizes.hot.select(*keys), sizes.floor)
    columns = df.columns
    cut = _numbered_pieces(df, keys, place, cuts)
    key = _order_key(order)
    part: dict[str, Column] = {"_rows": F.count(F.lit(1))}
    for name, s in outputs.items():
        c = F.col(s.column) if s.column else None
        if s.kind == "down":
            part[f"_p_{name}"] = F.max_by(c, F.when(c.isNotNull(), key))
        elif s.kind == "up":
            part[f"_p_{name}"] = F.min_by(c, F.when(c.isNotNull(), key))
        elif s.kind == "next":
            part[f"_p_{name}"] = F.min_by(F.struct(c.alias("v")), key)
        elif s.kind == "prev":
            part[f"_p_{name}"] = F.max_by(F.struct(c.alias("v")), key)
        elif s.kind == "rank":
            part[f"_p_{name}"] = F.count(F.lit(1))
        elif s.kind == "prod":
            part[f"_p_{name}"] = F.product(c)
        elif s.kind == "max":
            part[f"_p_{name}"] = F.max(c)
        else:
            part[f"_p_{name}"] = F.sum(c)
    # a row per large key and piece: as few as there are cut points
    parts = cut.where("_cut").groupBy(*keys, "_seg").agg(*[e.alias(n) for n, e in part.items()])
    wk = Window.partitionBy(*keys)
    earlier = wk.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    later = wk.orderBy(F.desc("_seg")).rowsBetween(Window.unboundedPreceding, -1)
    carry: dict[str, Column] = {}
    for name, s in outputs.items():
        p = f"_p_{name}"
        carry[f"_c_{name}"] = {
            "down": lambda: F.last(p, ignorenulls=True).over(earlier),
            "up": lambda: F.last(p, ignorenulls=True).over(later),
            "next": lambda: F.lead(p).over(wk.orderBy("_seg")),
            "prev": lambda: F.lag(p).over(wk.orderBy("_seg")),
            "rank": lambda: F.sum(p).over(earlier),
            "run": lambda: F.sum(p).over(earlier),
            "rest": lambda: F.sum(p).over(later),
            "prod": lambda: F.product(p).over(earlier),
            "max": lambda: F.max(p).over(wk),
        }[s.kind]()
    carries = _renamed(parts.select(*keys, "_seg", *[e.alias(n) for n, e in carry.items()]).withColumnRenamed("_seg", "_at"), keys)
    joined = cut.join(F.broadcast(carries), _same_keys(cut, carries, keys) & (cut["_seg"] == carries["_at"]) & cut["_cut"], "left")
    w = Window.partitionBy(*keys, "_seg")
    up, down = w.orderBy(*asc), w.orderBy(*desc)
    result: dict[str, Column] = {}
    for name, s in outputs.items():
        local, c = _windowed(s, up, down, w), F.col(f"_c_{name}")
        if s.kind == "max":
            result[name] = F.coalesce(c, local)
        elif s.kind in ("down", "up"):
            result[name] = F.coalesce(local, c)
        elif s.kind == "next":
            result[name] = F.when(F.lead(F.lit(1)).over(up).isNull(), c["v"]).otherwise(local)
        elif s.kind == "prev":
            result[name] = F.when(F.lag(F.lit(1)).over(up).isNull(), c["v"]).otherwise(local)
        elif s.kind == "rank":
            result[name] = local + F.coalesce(c, F.lit(0))
        elif s.kind == "prod":
            result[name] = F.coalesce(local, F.lit(1.0)) * F.coalesce(c, F.lit(1.0))
        else:
            result[name] = F.when(local.isNull() & c.isNull(), None).otherwise(
                F.coalesce(local, F.lit(0)) + F.coalesce(c, F.lit(0))
            )
    keep = [c for c in columns if c != "_all"]
    return joined.withColumns(result).select(*keep, *outputs)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per key, the first in ``order`` (pairs of column and ``"asc"``/``"desc"``, nulls last).

    An aggregate, so rows are reduced before the shuffle and a hot key costs nothing extra. Mixed
    directions need numeric, date or timestamp columns for the descending ones.
    """
    rank: list[Column] = []
    for name, way in order:
        rank.append(F.col(name).isNull())
        if way == "desc":
            rank.append(-_place(df, name))
        else:
            rank.append(F.col(name))
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*rank)).alias("_r"))
        .select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns])
    )


def broadcast_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast only after counting; a larger table is left to a shuffled join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
