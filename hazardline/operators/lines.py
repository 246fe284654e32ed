"""Therapy records to lines, and progression-free and overall survival per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.dates import DAYS, base_name, parse_imputed_date, time_between
from hazardline.operators.groups import flag_at_extreme, last_non_null, order_struct
from hazardline.operators.scans import following, key_max, measure_keys, ordered_scan

# --- fixed values -----------------------------------------------------------------------------
LINE_DATES = [
    "diagnosis_date",
    "therapy_start_date",
    "therapy_end_date",
    "status_date",
    "progression_date",
    "progression_before_date",
    "therapy_relapse_date",
    "progression_sv_last_date",
]
LATEST_DATES = ["status_date", "therapy_end_date", "progression_sv_last_date"]
LAST_TEXTS = ["drug_med_all", "drug_med_all_line", "treat_best_response", "surv_stat"]
DENSITY_DATES = ["diagnosis_date_density_imp", "therapy_start_date_density_imp"]
DECEASED = "deceased"
CENSORED = ["alive", "Lost2FU"]
# ----------------------------------------------------------------------------------------------


def _takes_max(column: str) -> bool:
    return any(part in column for part in ("status_date", "_end_date", "progression_sv_last_date"))


def parse_line_dates(df: DataFrame) -> DataFrame:
    """Text dates of the line columns to dates; date columns stay as they are."""
    types = dict(df.dtypes)
    targets = [f"{b}_{d}" for b in LINE_DATES for d in DAYS] + DENSITY_DATES
    new = {}
    for c in targets:
        if types.get(c) == "string":
            day = c[-2:] if c[-2:] in DAYS else "15"
            new[c] = parse_imputed_date(c, day)
    return df.withColumns(new) if new else df


def collapse_lines(
    df: DataFrame, order_col: str = "therapy_start_date_15", tie: Sequence[str] = ("cycle",)
) -> DataFrame:
    """One row per ``record_id`` and ``treat_line``.

    Dates take the group minimum, or maximum for status, end and last-progression dates. Four text
    columns take the last non-null value, ``_imputed_day`` flags follow the date they describe, and
    every other column comes from the first row in ``order_col`` (nulls last, then ``tie``). All of
    it is one aggregate that combines before the shuffle.
    """
    keys = ["record_id", "treat_line"]
    order = order_struct(order_col, *tie)
    dates = [c for c in df.columns if base_name(c) in LINE_DATES and base_name(c) != c]
    texts = [c for c in df.columns if c in LAST_TEXTS]
    flags: dict[str, str] = {}
    for c in df.columns:
        if c.endswith("_imputed_day"):
            base = c[: -len("_imputed_day")]
            found = [d for d in (f"{base}_15", base, f"{base}_01", f"{base}_28") if d in df.columns]
            if found and dict(df.dtypes)[found[0]] in ("date", "timestamp"):
                flags[c] = found[0]
    rest = [c for c in df.columns if c not in {*keys, *dates, *texts, *flags}]
    aggs: list[Column] = [F.max(c).alias(c) if _takes_max(c) else F.min(c).alias(c) for c in dates]
    aggs += [last_non_null(c, order).alias(c) for c in texts]
    aggs += [
        flag_at_extreme(d, c, order, "max" if _takes_max(d) else "min").alias(c) for c, d in flags.items()
    ]
    if rest:
        aggs.append(F.min_by(F.struct(*rest), order).alias("_first"))
    grouped = df.groupBy(*keys).agg(*aggs)
    return grouped.select(*[F.col("_first")[c].alias(c) if c in rest else F.col(c) for c in df.columns])


def last_line(lines: DataFrame, **scan) -> DataFrame:
    """``max_treat_line_num`` of the patient and ``is_last_line``."""
    top = ordered_scan(lines, ["record_id"], ["treat_line"], {"max_treat_line_num": key_max("treat_line")}, **scan)
    return top.withColumn(
        "is_last_line",
        F.col("max_treat_line_num").isNotNull() & (F.col("treat_line") == F.col("max_treat_line_num")),
    )


def progression_events(lines: DataFrame, days: Sequence[str] = DAYS, **scan) -> DataFrame:
    """``progression_event_date_<day>``: own progression, else the next line's earlier-progression
    date, else its relapse date. The next line must have a line number.
    """
    steps = {"_n_line": following("treat_line")}
    for d in days:
        steps[f"_n_before_{d}"] = following(f"progression_before_date_{d}")
        steps[f"_n_relapse_{d}"] = following(f"therapy_relapse_date_{d}")
    out = ordered_scan(lines, ["record_id"], ["treat_line"], steps, **scan)
    events = {
        f"progression_event_date_{d}": F.coalesce(
            F.col(f"progression_date_{d}"),
            F.when(F.col("_n_line").isNotNull(), F.coalesce(f"_n_before_{d}", f"_n_relapse_{d}")),
        )
        for d in days
    }
    return out.withColumns(events).drop(*steps)


def pfs_line(lines: DataFrame, days: Sequence[str] = DAYS) -> DataFrame:
    """The grid ``PFS_<progression day>_<start day>`` in months, with ``PFS_event``.

    Without an event the last line is censored at its last known progression date when that lies
    at or after the start, else at the status date; both in the variant of the start day.
    """
    last = F.col("is_last_line")
    new: dict[str, Column] = {}
    for s in days:
        start = F.col(f"therapy_start_date_{s}")
        known, status = F.col(f"progression_sv_last_date_{s}"), F.col(f"status_date_{s}")
        end = F.when(last & (known >= start), known).when(last, status)
        for p in days:
            event = F.col(f"progression_event_date_{p}")
            new[f"PFS_{p}_{s}"] = time_between(F.coalesce(event, end), start)
    dated = [F.col(f"progression_event_date_{d}").isNotNull() for d in days]
    some = dated[0]
    for t in dated[1:]:
        some = some | t
    new["progression_event_date_imputed_day"] = some
    new["PFS_event"] = (
        F.when(F.col("progression_event_date_15").isNotNull(), 1)
        .when(last & (F.col("surv_stat") == DECEASED), 1)
        .when(last & F.col("surv_stat").isin(CENSORED), 0)
    )
    return lines.withColumns(new)


def os_event() -> Column:
    return F.when(F.col("surv_stat") == DECEASED, 1).when(F.col("surv_stat").isin(CENSORED), 0)


def os_line(lines: DataFrame, days: Sequence[str] = DAYS) -> DataFrame:
    """The grid ``OS_<status day>_<diagnosis day>`` on the last line, and ``OS_event`` on all."""
    new: dict[str, Column] = {
        f"OS_{s}_{d}": F.when(F.col("is_last_line"), time_between(f"status_date_{s}", f"diagnosis_date_{d}"))
        for s in days
        for d in days
    }
    return lines.withColumns({**new, "OS_event": os_event()})


def os_patient(df: DataFrame, order: Sequence[str], days: Sequence[str] = DAYS) -> DataFrame:
    """The OS grid on the patient grain: first row per patient in ``order``."""
    from hazardline.operators.scans import first_per_key

    new = {
        f"OS_{s}_{d}": time_between(f"status_date_{s}", f"diagnosis_date_{d}") for s in days for d in days
    }
    return first_per_key(df, ["record_id"], [(o, "asc") for o in order]).withColumns({**new, "OS_event": os_event()})


def density_times(lines: DataFrame) -> DataFrame:
    """``PFS_density`` and ``OS_density``, from the empirically imputed anchors."""
    start, last = F.col("therapy_start_date_density_imp"), F.col("is_last_line")
    known = F.col("progression_sv_last_date_15")
    end = F.coalesce(
        F.col("progression_event_date_15"),
        F.when(last & (known >= start), known).when(last, F.col("status_date_15")),
    )
    return lines.withColumns(
        {
            "PFS_density": time_between(end, start),
            "OS_density": time_between("status_date_15", "diagnosis_date_density_imp"),
        }
    )


def calc_pfs_os(df: DataFrame, tie: Sequence[str] = ("cycle",), **scan) -> DataFrame:
    """Records to lines with every survival time. Without ``sizes`` a patient's records are counted here, once."""
    if not scan:
        scan = {"sizes": measure_keys(df, ["record_id"])}
    lines = collapse_lines(parse_line_dates(df), tie=tie)
    lines = os_line(pfs_line(progression_events(last_line(lines, **scan), **scan)))
    if all(c in lines.columns for c in (*DENSITY_DATES, "status_date_15")):
        lines = density_times(lines)
    return lines
