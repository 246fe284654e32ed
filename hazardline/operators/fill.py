"""Import split: carrying values along a patient's rows, and cutting the wide table by instrument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.operators.contracts import keep_numeric_ids
from hazardline.operators.scans import (
    KeySizes,
    fill_down,
    fill_up,
    first_per_key,
    key_max,
    measure_keys,
    ordered_scan,
    position,
)

# --- fixed values -----------------------------------------------------------------------------
THERAPY = "medical_treatment"
STATUS = "survival_status"
# ----------------------------------------------------------------------------------------------


def fill(
    df: DataFrame,
    down: Sequence[str] = (),
    up: Sequence[str] = (),
    *,
    key: str = "record_id",
    order: Sequence[str] = ("row_seq",),
    **scan,
) -> DataFrame:
    """Carry the named columns forward (``down``) or back (``up``) within a patient, in one pass."""
    steps = {f"_f_{c}": fill_down(c) for c in down} | {f"_f_{c}": fill_up(c) for c in up}
    out = ordered_scan(df, [key], order, steps, **scan)
    filled = {*down, *up}
    return out.select(*[F.col(f"_f_{c}").alias(c) if c in filled else F.col(c) for c in df.columns])


def fill_both_ways(
    df: DataFrame, columns: Sequence[str], *, key: str = "record_id", order: Sequence[str] = ("row_seq",), **scan
) -> DataFrame:
    """Carry forward, then fill what is left from below."""
    steps = {f"_d_{c}": fill_down(c) for c in columns} | {f"_u_{c}": fill_up(c) for c in columns}
    out = ordered_scan(df, [key], order, steps, **scan)
    return out.select(
        *[F.coalesce(f"_d_{c}", f"_u_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def split_registry(
    wide: DataFrame,
    cohort: Column,
    *,
    down: Sequence[str] = (),
    up: Sequence[str] = (),
    base_filter: Column | None = None,
    order: Sequence[str] = ("row_seq",),
    sizes: KeySizes | None = None,
) -> dict[str, DataFrame]:
    """``base``, ``thx`` and ``sv`` from the wide export.

    Values are filled before the cohort filter, because patient fields stand on one row only. The
    therapy and status rows keep patients that have a base row: a mark that is spread over the
    patient's rows after they are filled, on the same partitioning. ``sizes``: the patients' row
    counts in the export, where they are known; else they are counted here, once.
    """
    sizes = sizes or measure_keys(wide, ["record_id"])
    filled = fill(wide, down, up, order=order, sizes=sizes) if down or up else wide
    is_base = F.col("redcap_repeat_instance").isNull()
    if base_filter is not None:
        is_base = is_base & F.coalesce(base_filter, F.lit(False))
    rows = keep_numeric_ids(filled.where(cohort)).withColumn("_base", is_base)
    marked = ordered_scan(rows, ["record_id"], order, {"_has_base": key_max("_base")}, sizes=sizes)

    def instrument(name: str) -> DataFrame:
        part = marked.where((F.col("redcap_repeat_instrument") == name) & F.col("_has_base") & F.col("record_id").isNotNull())
        return part.drop("_base", "_has_base").withColumnRenamed("redcap_repeat_instance", "cycle")

    return {"base": marked.where("_base").drop("_base", "_has_base"), "thx": instrument(THERAPY), "sv": instrument(STATUS)}


def latest_per_key(df: DataFrame, key: str = "record_id", by: str = "cycle", tie: Sequence[str] = ()) -> DataFrame:
    """The row with the highest ``by`` per key; ties go to the first in ``tie`` order."""
    return first_per_key(df, [key], [(by, "desc"), *[(t, "asc") for t in tie]])


def first_after_fill(df: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """One row per key with ``value`` filled both ways: the first non-null value, if any.

    Filling down then up and keeping row 1 comes to the first non-null value, so no window runs.
    """
    ranked = F.struct(*[x for o in order for x in (F.col(o).isNull(), F.col(o))])
    return df.groupBy(key).agg(F.min_by(value, F.when(F.col(value).isNotNull(), ranked)).alias(value))


def rank_ids(df: DataFrame, id_column: str = "record_id", name: str = "pat_id", **scan) -> DataFrame:
    """A dense rank of the ids: 1, 2, 3 … in id order. Works on the distinct ids, cut when many."""
    return ordered_scan(df.select(id_column).distinct(), [], [id_column], {name: position()}, **scan)
