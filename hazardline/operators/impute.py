"""Missing days drawn from the observed lag between diagnosis and first therapy.

The lag density is a table of at most ``max_delta`` counts per stratum, whatever the cohort size.
A draw inverts the cumulative density on the feasible interval with a hash of the patient id, so
it is the same on every run, needs no rejection loop and obeys the date rules by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.dates import effective_end, first_of_month, parse_partial_date
from hazardline.operators.fill import fill_both_ways
from hazardline.operators.therapy import rchop_flag

# --- fixed values -----------------------------------------------------------------------------
GRID = 2048
MAX_DELTA = 365
MIN_ROWS = 5
PLANNED_DAYS = (100, 150)
PLANNED_END = "Planned end"
STRATA = ["rchop_high", "rchop_low", "other_high", "other_low"]
OVERALL = "all"
# ----------------------------------------------------------------------------------------------


def ldh_group(ratio: Column | str) -> Column:
    r = F.col(ratio) if isinstance(ratio, str) else ratio
    return F.when(r <= 1, "low").when(r > 1, "high")


def stratum() -> Column:
    """One of four strata by R-CHOP and LDH group; overall when the LDH group is unknown."""
    treated = F.when(F.col("rchop_flag"), "rchop_").otherwise("other_")
    return F.when(F.col("ldh_group").isNotNull(), F.concat(treated, F.col("ldh_group"))).otherwise(OVERALL)


def add_lag_columns(df: DataFrame) -> DataFrame:
    """R-CHOP flag, LDH group, parsed dates and the lag from diagnosis to therapy start."""
    types = dict(df.dtypes)

    def as_date(c: str) -> Column:
        return F.col(c) if types[c] == "date" else parse_partial_date(c)

    out = df.withColumns(
        {
            "rchop_flag": rchop_flag("drug_med_all"),
            "ldh_group": ldh_group("diag_ldh_ratio"),
            "therapy_start_date_": as_date("therapy_start_date"),
            "diagnosis_date_": as_date("diagnosis_date"),
            "therapy_end_date_": as_date("therapy_end_date"),
        }
    )
    return out.withColumns(
        {
            "Time_diag_to_txstart": F.datediff("therapy_start_date_", "diagnosis_date_").cast("double"),
            "therapy_end_date_month": F.when(F.col("therapy_end_date_").isNull(), F.col("therapy_end_date_month")),
        }
    )


def lag_sample(
    df: DataFrame, *, ldh: str | None = None, rchop: str = "any", max_delta: int = MAX_DELTA, check: bool = True
) -> DataFrame:
    """Observed lags in ``[0, max_delta)`` as counts per day. Fewer than five rows is an error."""
    lag = F.col("Time_diag_to_txstart")
    out = df.where((lag >= 0) & (lag < max_delta))
    if ldh is not None:
        out = out.where(F.col("ldh_group") == ldh)
    if rchop == "include":
        out = out.where(F.col("rchop_flag"))
    elif rchop == "exclude":
        out = out.where(~F.col("rchop_flag"))
    elif rchop != "any":
        raise ValueError("rchop must be 'any', 'include' or 'exclude'")
    counts = out.groupBy(lag.alias("lag")).agg(F.count(F.lit(1)).alias("n"))
    if check:
        total = counts.agg(F.sum("n")).first()[0] or 0
        if total == 0:
            raise ValueError("no lag to build a density from")
        if total < MIN_ROWS:
            raise ValueError("too few lags to build a density")
    return counts


def strata_counts(df: DataFrame, max_delta: int = MAX_DELTA, use_groups: bool = True) -> DataFrame:
    """Counts per stratum and lag, with the overall stratum; at most ``5 * max_delta`` rows."""
    lag = F.col("Time_diag_to_txstart")
    part = df.where((lag >= 0) & (lag < max_delta))
    names = F.array(F.lit(OVERALL), F.when(F.col("ldh_group").isNotNull(), stratum())) if use_groups else F.array(F.lit(OVERALL))
    by = part.groupBy("rchop_flag", "ldh_group", lag.alias("lag")).agg(F.count(F.lit(1)).alias("n"))
    return (
        by.select(F.explode(F.array_compact(names)).alias("stratum"), "lag", "n")
        .groupBy("stratum", "lag")
        .agg(F.sum("n").alias("n"))
    )


def fit_density(counts: DataFrame, max_delta: int = MAX_DELTA, points: int = GRID) -> DataFrame:
    """Gaussian kernel density on ``points`` places in ``[0, max_delta]`` per stratum.

    Bandwidth by the usual rule: 0.9 * min(sd, IQR/1.34) * n^(-1/5). Strata under five rows are left
    out. Output: ``stratum, bw, n, step, x, y``.
    """
    lag, n = F.col("lag"), F.col("n")
    stats = counts.groupBy("stratum").agg(
        F.sum(n).alias("total"),
        F.sum(lag * n).alias("s1"),
        F.sum(lag * lag * n).alias("s2"),
        F.expr("percentile(lag, array(0.25, 0.75), n)").alias("q"),
        F.sort_array(F.collect_list(F.struct(lag.alias("lag"), n.cast("double").alias("n")))).alias("mass"),
    )
    sd = F.sqrt((F.col("s2") - F.col("s1") * F.col("s1") / F.col("total")) / (F.col("total") - 1))
    iqr = (F.col("q")[1] - F.col("q")[0]) / F.lit(1.34)
    spread = F.when(iqr > 0, F.least(sd, iqr)).when(sd > 0, sd).otherwise(F.lit(1.0))
    wide = stats.where(F.col("total") >= MIN_ROWS).withColumn(
        "bw", F.lit(0.9) * spread * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    )
    step = max_delta / (points - 1)
    grid = wide.select(
        "stratum", "bw", "total", "mass", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("step")
    ).withColumn("x", F.col("step") * F.lit(step))
    norm = F.col("total") * F.col("bw") * F.lit((2 * 3.141592653589793) ** 0.5)
    kernel = F.aggregate(
        "mass",
        F.lit(0.0),
        lambda acc, m: acc + m["n"] * F.exp(F.lit(-0.5) * F.pow((F.col("x") - m["lag"]) / F.col("bw"), F.lit(2.0))),
    )
    return grid.select("stratum", "bw", F.col("total").alias("n"), "step", "x", (kernel / norm).alias("y"))


def cumulative(density: DataFrame) -> DataFrame:
    """Per stratum the cumulative mass as one array of ``GRID`` values."""
    ys = density.groupBy("stratum").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("step", "y"))), lambda p: p["y"]).alias("ys")
    )
    # entry i is the mass below grid point i, so the array has one entry more than the grid
    run = F.aggregate(
        "ys", F.array(F.lit(0.0)), lambda acc, y: F.concat(acc, F.array(F.element_at(acc, -1) + y))
    )
    return ys.select("stratum", run.alias("cum"))


def uniform(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) fixed by the keys and the seed: 52 bits of a digest, so any engine can repeat it."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def impute_dates_empirical(
    df: DataFrame,
    *,
    seed: int,
    max_delta: int = MAX_DELTA,
    use_groups: bool = True,
    strict: bool = False,
    order: Sequence[str] = ("treat_line", "cycle"),
    seed_keys: Sequence[str] = ("record_id",),
    **scan,
) -> DataFrame:
    """Impute the missing day of diagnosis or therapy start on first-line rows.

    Adds ``diagnosis_date_density_imp`` (carried to all rows of the patient),
    ``therapy_start_date_density_imp``, ``delta_imp`` and ``imp_status``: null where nothing was to
    be imputed, ``imputed``, or why no date fits. ``strict`` makes such rows an error.
    """
    base = add_lag_columns(df)
    first = F.col("treat_line").cast("string") == "1"
    counts = strata_counts(base.where(first), max_delta, use_groups)
    densities = cumulative(fit_density(counts, max_delta)).withColumnRenamed("stratum", "_stratum")
    found = {r[0] for r in densities.select("_stratum").collect()}  # at most five names
    if OVERALL not in found:
        raise ValueError("too few first-line lags to build a density")

    start, diagnosis, end = F.col("therapy_start_date_"), F.col("diagnosis_date_"), F.col("therapy_end_date_")
    d_month, d_year = F.col("diagnosis_date_month"), F.col("diagnosis_date_year")
    s_month, s_year = F.col("therapy_start_date_month"), F.col("therapy_start_date_year")
    d_first, s_first = first_of_month(d_year, d_month), first_of_month(s_year, s_month)
    end_eff = effective_end(end, F.col("therapy_end_date_month"), F.col("therapy_end_date_year"))
    case1 = first & start.isNotNull() & diagnosis.isNull() & d_first.isNotNull()
    case2 = first & diagnosis.isNotNull() & start.isNull() & s_first.isNotNull()
    name = stratum() if use_groups else F.lit(OVERALL)
    prepared = base.withColumns(
        {
            "_case": F.when(case1, 1).when(case2, 2),
            "_end": end_eff,
            "_stratum": F.when(name.isin(sorted(found)), name).otherwise(F.lit(OVERALL)),
            # feasible days: the month, after diagnosis, up to the effective end
            "_lo": F.when(case1, d_first).when(case2, F.greatest(s_first, diagnosis)),
            "_hi": F.when(case1, F.last_day(d_first)).when(case2, F.least(F.last_day(s_first), end_eff)),
        }
    )
    planned = (
        (F.col("_case") == 2)
        & F.col("rchop_flag")
        & F.coalesce(F.col("drug1_end_reason") == PLANNED_END, F.lit(False))
        & F.col("_end").isNotNull()
    )
    p_lo = F.greatest(F.col("_lo"), F.date_sub("_end", PLANNED_DAYS[1]))
    p_hi = F.least(F.col("_hi"), F.date_sub("_end", PLANNED_DAYS[0]))
    narrow = planned & (p_lo <= p_hi)
    prepared = prepared.withColumns(
        {
            "_lo": F.when(narrow, p_lo).otherwise(F.col("_lo")),
            "_hi": F.when(narrow, p_hi).otherwise(F.col("_hi")),
        }
    )
    lo_lag = F.when(F.col("_case") == 1, F.datediff(start, "_hi")).otherwise(F.datediff("_lo", diagnosis))
    hi_lag = F.when(F.col("_case") == 1, F.datediff(start, "_lo")).otherwise(F.datediff("_hi", diagnosis))
    per_day = (GRID - 1) / max_delta
    prepared = prepared.withColumns(
        {
            "_i": F.greatest(F.ceil(lo_lag * F.lit(per_day)).cast("int"), F.lit(0)),
            "_j": F.least(F.floor(hi_lag * F.lit(per_day)).cast("int"), F.lit(GRID - 1)),
            "_u": F.when(F.col("_case").isNotNull(), uniform(seed_keys, seed)),
        }
    )
    # five rows of 2049 doubles
    joined = prepared.join(F.broadcast(densities), "_stratum", "left")
    cum = F.col("cum")
    sound = (F.col("_lo") <= F.col("_hi")) & (F.col("_i") <= F.col("_j"))
    below = F.when(sound, F.get(cum, F.col("_i")))
    mass = F.when(sound, F.get(cum, F.col("_j") + 1)) - below
    joined = joined.withColumns({"_below": below, "_mass": mass}).withColumn(
        "_status",
        F.when(F.col("_case").isNull(), None)
        .when((F.col("_case") == 1) & (start > F.col("_end")), "start_after_end")
        .when(F.col("_lo") > F.col("_hi"), "no_feasible_day")
        .when(F.coalesce(F.col("_mass"), F.lit(0.0)) <= 0, "no_density_mass")
        .otherwise("imputed"),
    )
    target = F.col("_below") + F.col("_u") * F.col("_mass")
    window = F.slice(cum, F.col("_i") + 2, F.col("_j") - F.col("_i") + 1)
    steps = F.size(F.filter(window, lambda c: c <= target))
    drawn = F.bround((F.col("_i") + F.least(steps, F.col("_j") - F.col("_i"))) / F.lit(per_day)).cast("int")
    raw = F.when(F.col("_case") == 1, F.date_sub(start, F.col("_draw"))).otherwise(
        F.date_add(diagnosis, F.col("_draw"))
    )
    joined = joined.withColumn("_draw", F.when(F.col("_status") == "imputed", drawn)).withColumn(
        "_day", F.when(F.col("_draw").isNotNull(), F.greatest(F.least(raw, F.col("_hi")), F.col("_lo")))
    )
    out = joined.withColumns(
        {
            "diagnosis_date_density_imp": F.when(F.col("_case") == 1, F.col("_day")).otherwise(diagnosis),
            "therapy_start_date_density_imp": F.when(F.col("_case") == 2, F.col("_day")).otherwise(start),
            "imp_status": F.col("_status"),
        }
    ).withColumn(
        "delta_imp",
        F.when(
            F.col("_day").isNotNull(), F.datediff("therapy_start_date_density_imp", "diagnosis_date_density_imp")
        ),
    )
    keep = [*base.columns, "diagnosis_date_density_imp", "therapy_start_date_density_imp", "delta_imp", "imp_status"]
    out = out.select(*keep)
    if strict:
        bad = out.where(F.col("imp_status") != "imputed").groupBy("imp_status").count().collect()
        if bad:
            raise ValueError("; ".join(f"{r['imp_status']}: {r['count']} rows" for r in bad))
    return fill_both_ways(out, ["diagnosis_date_density_imp"], order=order, **scan)
