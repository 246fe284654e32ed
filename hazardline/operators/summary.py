"""Descriptive tables: exact quantiles, counts and shares, at any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.operators.scans import ordered_scan, running_sum


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], **scan
) -> DataFrame:
    """Exact quantiles (linear interpolation) per key: ``q1, q2, …`` in the order of ``probs``.

    Values are counted first and ranked by a running sum over the distinct values, so no task holds
    a group's values. NaN and null are left out.
    """
    keys = list(keys)
    if not keys:
        df, keys = df.withColumn("_g", F.lit(1)), ["_g"]
    v = F.col(value).cast("double")
    counts = df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.persist()
    ranked = ordered_scan(counts, keys, ["_v"], {"_to": running_sum("_n")}, **scan)
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    aggs = []
    joined = ranked.join(totals, keys)
    # the value at 0-based rank r is the smallest one whose running count exceeds r
    for i, p in enumerate(probs):
        h = (F.col("_total") - 1) * F.lit(float(p))
        lo = F.min(F.when(F.col("_to") > F.floor(h), F.col("_v")))
        hi = F.min(F.when(F.col("_to") > F.ceil(h), F.col("_v")))
        part = F.max(h - F.floor(h))
        aggs.append((lo + (hi - lo) * part).alias(f"q{i + 1}"))
    return joined.groupBy(*keys).agg(*aggs).drop("_g")


def stack(df: DataFrame, variables: Sequence[str], kind: str, keys: Sequence[str] = ()) -> DataFrame:
    """Columns to rows ``variable, value`` without a join."""
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast(kind).alias("value")) for v in variables])
    return df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.variable", "_p.value")


def summary_continuous(df: DataFrame, variables: Sequence[str], **scan) -> DataFrame:
    """``variable, n, n_missing, median, p25, p75``."""
    long = stack(df, variables, "double")
    size = long.groupBy("variable").agg(
        F.count("value").alias("n"), (F.count(F.lit(1)) - F.count("value")).alias("n_missing")
    )
    q = exact_quantiles(long, ["variable"], "value", [0.5, 0.25, 0.75], **scan)
    return size.join(q, "variable", "left").select(
        "variable", "n", "n_missing", F.col("q1").alias("median"), F.col("q2").alias("p25"), F.col("q3").alias("p75")
    )


def summary_categorical(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """``variable, level, n, percent`` of the non-missing rows."""
    counts = (
        stack(df, variables, "string")
        .where(F.col("value").isNotNull())
        .groupBy("variable", F.col("value").alias("level"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("variable").agg(F.sum("n").alias("_all"))
    return counts.join(totals, "variable").withColumn("percent", F.col("n") * 100.0 / F.col("_all")).drop("_all")


def summary_table(df: DataFrame, continuous: Sequence[str], categorical: Sequence[str], **scan) -> DataFrame:
    """The printed table: ``median (p25, p75)`` with one decimal, or ``n (p%)``."""
    num = summary_continuous(df, continuous, **scan).select(
        "variable",
        F.lit(None).cast("string").alias("level"),
        F.format_string("%.1f (%.1f, %.1f)", "median", "p25", "p75").alias("statistic"),
    )
    cat = summary_categorical(df, categorical).select(
        "variable", "level", F.format_string("%d (%.1f%%)", "n", "percent").alias("statistic")
    )
    return num.unionByName(cat)


def distribution(df: DataFrame, group: str, value: str, **scan) -> DataFrame:
    """Per level: n, quartiles, mean and the band mean ± 2 sd."""
    moments = df.groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )
    q = exact_quantiles(df, [group], value, [0.25, 0.5, 0.75], **scan)
    return (
        moments.join(q, group, "left")
        .withColumnsRenamed({"q1": "p25", "q2": "median", "q3": "p75"})
        .withColumns({"band_low": F.col("mean") - 2 * F.col("sd"), "band_high": F.col("mean") + 2 * F.col("sd")})
    )
