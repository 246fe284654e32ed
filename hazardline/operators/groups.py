"""Aggregates per patient or per patient and line, written so that rows combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.text import LIST_SEPARATOR, split_list

# --- fixed values -----------------------------------------------------------------------------
RESPONSE_ORDER = ["CR", "PR", "SD", "PD", "NE"]
YES_NO = ["yes", "no"]
YES_NO_NOT_DONE = ["yes", "no", "Not done"]
SITES = ["CNS, Periphery", "CNS", "Periphery"]
# ----------------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_struct(*columns: str) -> Column:
    """A comparable key over the columns, nulls last."""
    return F.struct(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def last_non_null(value: Column | str, order: Column) -> Column:
    """Aggregate: the last non-null value in ``order``."""
    v = _col(value)
    return F.max_by(v, F.when(v.isNotNull(), order))


def first_non_null(value: Column | str, order: Column) -> Column:
    v = _col(value)
    return F.min_by(v, F.when(v.isNotNull(), order))


def flag_at_extreme(date: Column | str, flag: Column | str, order: Column, which: str = "min") -> Column:
    """Aggregate: the flag on the row with the earliest (or latest) date.

    Ties go to the first row in ``order``; null when every date is null.
    """
    d, f = _col(date), _col(flag)
    if which not in ("min", "max"):
        raise ValueError("which must be 'min' or 'max'")
    distance = F.unix_date(d.cast("date"))
    rank = F.when(d.isNotNull(), F.struct(distance if which == "min" else -distance, order))
    return F.min_by(f, rank)


def priority_any(values: Column | str, priority: Sequence) -> Column:
    """Aggregate: the first entry of ``priority`` that occurs in the group, else null."""
    v = _col(values)
    rank = None
    for i, p in enumerate(priority):
        rank = F.when(v == F.lit(p), F.lit(i)) if rank is None else rank.when(v == F.lit(p), F.lit(i))
    labels = F.array(*[F.lit(str(p)) for p in priority])
    best = F.min(rank)
    return F.when(best.isNotNull(), F.get(labels, best))


def any_present(value: Column | str) -> Column:
    """Aggregate: ``yes`` when any value is non-null, else ``no``."""
    return F.when(F.max(_col(value).isNotNull()), "yes").otherwise("no")


def paste_without_null(value: Column | str, order: Column) -> Column:
    """Aggregate: non-null values in ``order``, joined; the empty string when there are none.

    The result holds every value of the group in one text cell, so it is only meant for short
    lists; :func:`line_union_text` bounds the cell by the vocabulary.
    """
    v = _col(value)
    items = F.collect_list(F.when(v.isNotNull(), F.struct(order.alias("o"), v.cast("string").alias("v"))))
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["v"]), LIST_SEPARATOR)


def best_response_parts(value: Column | str, order: Column) -> tuple[dict[str, Column], Column]:
    """Aggregates and the final expression for the best response of a group.

    The first of CR, PR, SD, PD, NE contained in any value; else ``Unknown`` when any value
    contains Unknown or Not done; else the values joined in order (which may be empty). Known
    responses are decided by a minimum; only values that hold none are joined as text.
    """
    v = _col(value)
    tests = [v.contains(r) for r in RESPONSE_ORDER] + [v.rlike("Unknown|Not done")]
    rank = None
    for i, t in enumerate(tests):
        rank = F.when(t, F.lit(i)) if rank is None else rank.when(t, F.lit(i))
    labels = F.array(*[F.lit(r) for r in [*RESPONSE_ORDER, "Unknown"]])
    parts = {"_best": F.min(rank), "_text": paste_without_null(F.when(rank.isNull(), v), order)}
    return parts, F.when(F.col("_best").isNotNull(), F.get(labels, F.col("_best"))).otherwise(F.col("_text"))


def best_response(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], out: str) -> DataFrame:
    """The best response per group."""
    parts, final = best_response_parts(value, order_struct(*order))
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in parts.items()]).select(*keys, final.alias(out))


def line_union_text(df: DataFrame, keys: Sequence[str], columns: Sequence[str], suffix: str = "_line") -> DataFrame:
    """Per group: the distinct trimmed list items of each column, sorted and joined.

    Items are made distinct per group before they are gathered, so a group costs its vocabulary,
    not its rows. A group without items gives the empty string.
    """
    items = df.select(
        *keys,
        F.posexplode_outer(F.array(*[F.col(c).cast("string") for c in columns])).alias("_which", "_list"),
    ).select(*keys, "_which", F.explode_outer(F.transform(split_list("_list"), lambda w: F.trim(w))).alias("_item"))
    distinct = items.groupBy(*keys, "_which", "_item").agg(F.lit(1).alias("_"))
    return distinct.groupBy(*keys).agg(
        *[
            F.array_join(F.array_sort(F.collect_list(F.when(F.col("_which") == i, F.col("_item")))), LIST_SEPARATOR).alias(
                f"{c}{suffix}"
            )
            for i, c in enumerate(columns)
        ]
    )


def attach(df: DataFrame, keys: Sequence[str], aggregates: DataFrame) -> DataFrame:
    """Repeat group values on every row. Keys may be null; the row side may be skewed (AQE splits it)."""
    right = aggregates.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = None
    for k in keys:
        test = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        on = test if on is None else on & test
    return df.join(right, on, "left").drop(*[f"_k_{k}" for k in keys])


def max_treat_line(df: DataFrame, key: str = "record_id", line: str = "treat_line") -> DataFrame:
    """``max_treat_line``: 1 on the patient's highest line, else 0 (0 for a null line)."""
    top = df.groupBy(key).agg(F.max(line).alias("_top"))
    return attach(df, [key], top).withColumn(
        "max_treat_line", F.coalesce(F.col(line) == F.col("_top"), F.lit(False)).cast("int")
    ).drop("_top")


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def share_within(df: DataFrame, group: Sequence[str], level: Sequence[str]) -> DataFrame:
    """Counts per group and level, with the share of the group."""
    counts = count_by(df, [*group, *level])
    totals = counts.groupBy(*group).agg(F.sum("n").alias("_all"))
    return attach(counts, group, totals).withColumn("share", F.col("n") / F.col("_all")).drop("_all")


def arm_counts(df: DataFrame, arm: str, event: str) -> DataFrame:
    """Rows and events per arm; a missing event counts as none."""
    return df.groupBy(arm).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(event) == 1, 1)).alias("events")
    )


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct list items of a column."""
    return df.select(F.explode(F.transform(split_list(column), lambda w: F.trim(w))).alias("item")).distinct()
