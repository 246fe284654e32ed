"""Kaplan–Meier curves, medians, survival at times, risk tables and log-rank tests.

Rows are counted per stratum and time first; everything after works on that table, which is bounded
by the number of distinct times. The ordered sums over it use :mod:`scans`, so strata with very many
distinct times are still spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.dates import time_scale
from hazardline.operators.scans import (
    PIECE,
    fill_up,
    following,
    measure_keys,
    ordered_scan,
    preceding,
    remaining_sum,
    running_product,
    running_sum,
)
from hazardline.operators.tiles import point_blocks, spread

# --- fixed values -----------------------------------------------------------------------------
Z95 = 1.959963984540054
FOLLOW_UP_YEARS = (1, 2, 5)
# ----------------------------------------------------------------------------------------------


def _alive_rows(df: DataFrame, time: str, event: str) -> DataFrame:
    return df.where(F.col(time).isNotNull() & ~F.isnan(F.col(time)) & F.col(event).isNotNull())


def time_counts(df: DataFrame, time: str, event: str, strata: Sequence[str] = ()) -> DataFrame:
    """Events ``d`` and censored ``c`` per stratum and time; rows with a missing part are left out."""
    return (
        _alive_rows(df, time, event)
        .groupBy(*strata, F.col(time).cast("double").alias("time"))
        .agg(
            F.count(F.when(F.col(event) == 1, 1)).alias("d"),
            F.count(F.when(F.col(event) != 1, 1)).alias("c"),
        )
    )


def kaplan_meier(df: DataFrame, time: str, event: str, strata: Sequence[str] = (), **scan) -> DataFrame:
    """One row per stratum and time: n at risk, events, censored, survival and its 95% interval.

    Greenwood variance on the log scale. At survival 0 the interval is null.
    """
    strata = list(strata)
    counts = time_counts(df, time, event, strata).withColumn("m", F.col("d") + F.col("c")).persist()
    if "sizes" not in scan and not scan.get("bounded"):
        scan["sizes"] = measure_keys(counts, strata, scan.pop("floor", PIECE))
    at_risk = ordered_scan(counts, strata, ["time"], {"n": remaining_sum("m")}, **scan)
    factors = at_risk.withColumns(
        {
            "_keep": F.lit(1.0) - F.col("d") / F.col("n"),
            "_v": F.when(F.col("n") > F.col("d"), F.col("d") / (F.col("n").cast("double") * (F.col("n") - F.col("d")))),
        }
    )
    run = ordered_scan(
        factors, strata, ["time"], {"survival": running_product("_keep"), "_var": running_sum("_v")}, **scan
    )
    s = F.col("survival")
    se = F.sqrt("_var")
    alive = s > 0
    return run.select(
        *strata,
        "time",
        F.col("n").alias("n_risk"),
        F.col("d").alias("n_event"),
        F.col("c").alias("n_censor"),
        s,
        F.when(alive, se).alias("std_err"),
        F.when(alive, s * F.exp(F.lit(-Z95) * se)).alias("lower"),
        F.when(alive, F.least(F.lit(1.0), s * F.exp(F.lit(Z95) * se))).alias("upper"),
    )


def quantile_columns(curve: str, name: str, at: float = 0.5, time: str = "time") -> tuple[list[Column], Column]:
    """Aggregates and the final expression for the time a curve falls to ``at``.

    When the curve lies exactly at ``at`` over an interval, its midpoint is taken.
    """
    tolerance = 1e-12
    s, t = F.col(curve), F.col(time)
    reached = F.when(s <= at + tolerance, t)
    parts = [
        F.min(reached).alias(f"_{name}_first"),
        F.min_by(s, reached).alias(f"_{name}_value"),
        F.min(F.when(s < at - tolerance, t)).alias(f"_{name}_below"),
    ]
    first, value, below = (F.col(f"_{name}_{k}") for k in ("first", "value", "below"))
    flat = (F.abs(value - at) <= tolerance) & below.isNotNull()
    return parts, F.when(flat, (first + below) / 2).otherwise(first).alias(name)


def median_survival(
    curve: DataFrame, strata: Sequence[str] = (), scale: str | None = None, time: str = "time", at: float = 0.5
) -> DataFrame:
    """Median and 95% interval per stratum with totals; null where the curve does not fall that far."""
    aggs, finals = [], []
    for column, name in (("survival", "median"), ("lower", "lower95"), ("upper", "upper95")):
        parts, value = quantile_columns(column, name, at, time)
        aggs += parts
        finals.append((name, value))
    k = time_scale(scale)
    return (
        curve.groupBy(*strata)
        .agg(
            F.max("n_risk").alias("records"),
            F.sum("n_event").alias("events"),
            *aggs,
        )
        .select(*strata, "records", "events", *[(v * F.lit(k)).alias(n) for n, v in finals])
    )


def median_text(medians: DataFrame, digits: int = 2, missing: str = "NR") -> DataFrame:
    """The printed form ``m (lo–hi)``; ``NR`` when not reached."""
    from hazardline.functions.text import estimate_text

    return medians.withColumn(
        "median_text", estimate_text(F.col("median"), F.col("lower95"), F.col("upper95"), digits, missing)
    )


def survival_at(
    curve: DataFrame,
    strata: Sequence[str] = (),
    *,
    times: Sequence[float] | None = None,
    years: Sequence[float] = FOLLOW_UP_YEARS,
    scale: str | None = "m_y",
) -> DataFrame:
    """Survival in percent with its interval at fixed times, from the last point at or before each.

    Times after the last point of a stratum are left out. Without ``times`` the years are turned
    into the unit named by the first letter of ``scale``.
    """
    origin = (scale or "y_y")[0]
    per_year = {"d": 365.25, "m": 12.0, "y": 1.0}
    if times is None:
        if origin not in per_year:
            raise ValueError("the scale must start with d, m or y")
        times = [y * per_year[origin] for y in years]
    asked = [float(t) for t in times]
    aggs: list[Column] = [F.max("time").alias("_last")]
    for i, t in enumerate(asked):
        point = F.struct("survival", "lower", "upper")
        aggs.append(F.max_by(point, F.when(F.col("time") <= t, F.col("time"))).alias(f"_p{i}"))
    points = F.explode(
        F.array(*[F.struct(F.lit(t).alias("time"), F.col(f"_p{i}").alias("p")) for i, t in enumerate(asked)])
    )
    k = time_scale(scale)
    flat = curve.groupBy(*strata).agg(*aggs).select(*strata, "_last", points.alias("x"))

    def percent(part: str) -> Column:
        value = F.when(F.col("x.p").isNull(), F.lit(1.0)).otherwise(F.col(f"x.p.{part}"))
        return F.bround(value * 100, 2).alias(part)

    return flat.where(F.col("x.time") <= F.col("_last")).select(
        *strata, F.col("x.time").alias("time"), (F.col("x.time") * F.lit(k)).alias("follow_up"),
        percent("survival"), percent("lower"), percent("upper"),
    )


def risk_table(
    curve: DataFrame, strata: Sequence[str] = (), *, step: float = 24.0, x_end: float | None = None, **scan
) -> DataFrame:
    """Number at risk and events so far at 0, step, 2·step … up to ``x_end`` (default: last time).

    Breaks and points of the curve are put in one order, a break before a point at its time, and one scan reads off both
    numbers; the work is that of sorting them, however fine the breaks.
    """
    strata = list(strata)
    end = F.lit(float(x_end)) if x_end is not None else curve.agg(F.max("time").alias("_end")).scalar()
    strata_rows = curve.select(*strata).distinct() if strata else curve.limit(1).select(F.lit(1).alias("_one"))
    count = F.floor(end / F.lit(float(step))).cast("int")
    breaks = strata_rows.select(*strata, F.explode(F.sequence(F.lit(0), count)).alias("k")).select(
        *strata, (F.col("k") * F.lit(float(step))).alias("time"), F.lit(True).alias("_break"),
        F.lit(None).cast("long").alias("n_risk"), F.lit(0).cast("long").alias("n_event"),
    )
    points = curve.select(*strata, "time", F.lit(False).alias("_break"), "n_risk", "n_event")
    steps = {
        "_risk": fill_up("n_risk"), "_so_far": running_sum("n_event"), "_next": following("time"), "_next_events": following("n_event"),
    }
    both = breaks.unionByName(points).withColumn("_place", F.when(F.col("_break"), 0).otherwise(1))
    seen = ordered_scan(both, strata, ["time", "_place"], steps, **scan)
    now = F.when(F.col("_next") == F.col("time"), F.col("_next_events")).otherwise(0)
    return seen.where("_break").select(
        *strata, "time", F.coalesce("_risk", F.lit(0)).alias("n_risk"), (F.col("_so_far") + now).alias("cum_events")
    )


def chi2_sf(x: float, df: int) -> float:
    """Upper tail of the chi-square distribution for whole degrees of freedom."""
    if df <= 0 or x != x:
        return math.nan
    if x <= 0:
        return 1.0
    h = x / 2
    if df % 2 == 0:
        total = sum(math.exp(i * math.log(h) - math.lgamma(i + 1)) for i in range(df // 2))
        return math.exp(-h) * total
    total = sum(math.exp((i + 0.5) * math.log(h) - math.lgamma(i + 1.5)) for i in range((df - 1) // 2))
    return math.erfc(math.sqrt(h)) + math.exp(-h) * total


def _pair_sums(counts: DataFrame, of_pair, **scan) -> list:
    """Sums over event times for every pair of groups (a group with itself included), from one aggregation.

    ``counts`` holds ``g, time, d, c``. The number at risk of a group holds from its time before up to its own, and meets the
    event times in between in tiles. A time's row is the list of groups still at risk; its pairs are summed map-side.
    ``of_pair(a, b, total)`` gives named sums from two members ``g, d, n`` and the time's totals ``d, n``. As many rows come
    back as there are pairs of groups.
    """
    cells = counts.withColumn("m", F.col("d") + F.col("c"))
    if not scan.get("bounded"):
        scan = {"sizes": measure_keys(cells.select("g"), ["g"], scan.get("floor", PIECE))}
    live = ordered_scan(cells, ["g"], ["time"], {"n": remaining_sum("m"), "_before": preceding("time")}, **scan)
    blocks = point_blocks(cells.where("d > 0").select("time").distinct())
    met = spread(live, blocks, "_before", "time")
    member = F.struct("g", F.when(F.col("at") == F.col("time"), F.col("d")).otherwise(0).cast("double").alias("d"), F.col("n").cast("double").alias("n"))
    lists = met.groupBy("at").agg(
        F.array_sort(F.collect_list(member)).alias("m"), F.struct(F.sum(member["d"]).alias("d"), F.sum(member["n"]).alias("n")).alias("total")
    )
    pairs = F.flatten(F.transform("m", lambda a, i: F.transform(F.slice("m", i + 1, F.size("m")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    rows = lists.select("total", F.explode(pairs).alias("p"))
    sums = of_pair(F.col("p.a"), F.col("p.b"), F.col("total"))
    out = rows.groupBy(F.col("p.a.g").alias("g1"), F.col("p.b.g").alias("g2")).agg(*[F.sum(c).alias(n) for n, c in sums.items()]).collect()
    blocks.release()
    return out


def _counted(df: DataFrame, time: str, event: str, group: str) -> tuple[DataFrame, dict[str, int]]:
    """Cells of the groups, kept, and the rows of each group."""
    counts = time_counts(df.withColumn("g", F.col(group).cast("string")), time, event, ["g"]).where("g IS NOT NULL").persist()
    rows = counts.groupBy("g").agg(F.sum(F.col("d") + F.col("c")).alias("n")).collect()
    if len(rows) < 2:
        raise ValueError("a log-rank test needs two groups")
    return counts, {r["g"]: r["n"] for r in sorted(rows, key=lambda r: r["g"])}


def _hypergeometric(d: Column, n: Column) -> Column:
    return F.when(n > 1, d * (n - d) / (n - 1)).otherwise(0.0)


def logrank(df: DataFrame, time: str, event: str, group: str, **scan) -> DataFrame:
    """k-sample log-rank test: one row per group with observed and expected events, and the test.

    Groups may be many: they are rows throughout, and the driver holds their covariances.
    """
    import numpy as np

    counts, sizes = _counted(df, time, event, group)

    def parts(a: Column, b: Column, total: Column) -> dict[str, Column]:
        same = a["g"] == b["g"]
        own = F.when(same, 1.0).otherwise(0.0)
        n = total["n"]
        return {
            "o": own * a["d"], "e": own * total["d"] * a["n"] / n,
            "v": _hypergeometric(total["d"], n) * a["n"] / n * (own - b["n"] / n),
        }

    sums = _pair_sums(counts, parts, **scan)
    counts.unpersist()
    at = {g: i for i, g in enumerate(sizes)}
    observed, expected, v = np.zeros(len(at)), np.zeros(len(at)), np.zeros((len(at), len(at)))
    for r in sums:
        i, j = at[r["g1"]], at[r["g2"]]
        v[i, j] = v[j, i] = r["v"]
        if i == j:
            observed[i], expected[i] = r["o"], r["e"]
    u = (observed - expected)[:-1]
    chi2, dof = float(u @ np.linalg.pinv(v[:-1, :-1]) @ u), len(at) - 1
    p = chi2_sf(chi2, dof)
    rows = [(g, int(n), float(observed[at[g]]), float(expected[at[g]]), chi2, dof, p) for g, n in sizes.items()]
    return df.sparkSession.createDataFrame(
        rows, f"`{group}` string, n long, observed double, expected double, chisq double, df int, p double"
    )


def pairwise_logrank(df: DataFrame, time: str, event: str, group: str, **scan) -> DataFrame:
    """Log-rank test of every pair of groups, all from one aggregation: ``group1, group2, chisq, df, p``.

    A pair without an event between them has a null statistic.
    """
    counts, _ = _counted(df, time, event, group)

    def parts(a: Column, b: Column, total: Column) -> dict[str, Column]:
        d, n = a["d"] + b["d"], a["n"] + b["n"]
        share = a["n"] / n
        return {"u": a["d"] - d * share, "v": _hypergeometric(d, n) * share * (1 - share)}

    rows = []
    for r in _pair_sums(counts, parts, **scan):
        if r["g1"] != r["g2"]:
            chi2 = r["u"] ** 2 / r["v"] if r["v"] else None
            rows.append((r["g1"], r["g2"], chi2, 1, None if chi2 is None else chi2_sf(chi2, 1)))
    counts.unpersist()
    return df.sparkSession.createDataFrame(sorted(rows, key=lambda r: r[:2]), "group1 string, group2 string, chisq double, df int, p double")
