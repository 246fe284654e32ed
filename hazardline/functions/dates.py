"""Dates, partial dates and elapsed time as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
DAYS = ("01", "15", "28")
DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 365.25 / 12
UNKNOWN_DAY = "nk"
NULL_TOKENS = ["", "NA", "N/A", "na", "n/a", "NULL", "null"]
# strict forms of: year-month-day, day-month-year, day/month/year, day.month.year, year/month/day
PARSE_FORMATS = ["yyyy-M-d", "d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "yyyy/M/d"]
SERIAL_ORIGIN = "1899-12-30"
# ----------------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partial_date_text(date: Column | str, month: Column | str, year: Column | str) -> Column:
    """``dd/MM/yyyy``; ``nk/m/yyyy`` when only month and year are known; else null."""
    date, month, year = _col(date), _col(month), _col(year)
    return F.when(date.isNotNull(), F.date_format(date, "dd/MM/yyyy")).when(
        month.isNotNull() & year.isNotNull(),
        F.concat_ws("/", F.lit(UNKNOWN_DAY), month.cast("string"), year.cast("string")),
    )


def day_in_month(year: Column, month: Column, day: int | Column) -> Column:
    """A date, or null for a month outside 1..12 (never an error)."""
    ok = month.between(1, 12) & year.between(1, 9999)
    day = F.lit(day) if isinstance(day, int) else day
    return F.when(ok, F.make_date(year.cast("int"), month.cast("int"), day))


def raw_date(df: DataFrame, date: str, month: str, year: str, condition: Column | None = None) -> DataFrame:
    """``<date>_raw``: the date as ISO text, or ``nk/m/y``; null where the condition does not hold."""
    ok = F.lit(True) if condition is None else condition
    text = F.when(F.col(date).isNotNull(), F.col(date).cast("string")).when(
        F.col(month).isNotNull() & F.col(year).isNotNull(),
        F.concat_ws("/", F.lit(UNKNOWN_DAY), F.col(month).cast("string"), F.col(year).cast("string")),
    )
    return df.withColumn(f"{date}_raw", F.when(ok, text))


def impute_missing_day(df: DataFrame, raw: str, day: str = "15") -> DataFrame:
    """``<raw>_imputed_<day>`` from ``dd/MM/yyyy`` or ``nk/m/yyyy`` text."""
    text = F.regexp_replace(F.col(raw), "^(.*?)nk", f"$1{day}")
    return df.withColumn(f"{raw}_imputed_{day}", F.try_to_date(text, "d/M/yyyy"))


def reformat_dates(df: DataFrame, bases: Iterable[str]) -> DataFrame:
    """Replace each date by its partial-date text."""
    return df.withColumns({b: partial_date_text(b, f"{b}_month", f"{b}_year") for b in bases})


def impute_dates(
    df: DataFrame,
    specs: Sequence[str] | Mapping[str, Column | None],
    days: Sequence[str] = DAYS,
) -> DataFrame:
    """For each date prefix: its text, ``_imputed_day`` flag and one dated variant per day.

    ``specs`` maps a prefix to a predicate (or None for all rows). Where the predicate is false or
    null every output is null. All prefixes are added in one projection.
    """
    plan = dict.fromkeys(specs) if not isinstance(specs, Mapping) else dict(specs)
    new: dict[str, Column] = {}
    for prefix, condition in plan.items():
        if condition is not None and not isinstance(condition, Column):
            raise TypeError("a date condition must be a Column")
        date, month, year = F.col(prefix), F.col(f"{prefix}_month"), F.col(f"{prefix}_year")
        partial = date.isNull() & month.isNotNull() & year.isNotNull()
        known = date.isNotNull() | partial
        if condition is not None:
            known = F.coalesce(condition, F.lit(False)) & known
        new[f"{prefix}_imputed_day"] = F.when(known, partial)
        for d in days:
            new[f"{prefix}_{d}"] = F.when(known, F.coalesce(date, day_in_month(year, month, int(d))))
        new[prefix] = F.when(known, partial_date_text(date, month, year))
    return df.withColumns(new)


def parse_partial_date(x: Column | str) -> Column:
    """The first format that fits; null tokens and unknown days give null."""
    t = F.trim(_col(x).cast("string"))
    t = F.when(t.isin(NULL_TOKENS) | t.startswith("nk/"), None).otherwise(t)
    return F.coalesce(*[F.try_to_date(t, f) for f in PARSE_FORMATS])


def parse_imputed_date(x: Column | str, day: str = "15") -> Column:
    """ISO, ``dd/MM/yyyy``, or ``nk/m/yyyy`` with the day put in."""
    if day not in DAYS:
        raise ValueError(f"day must be one of {DAYS}")
    t = F.regexp_replace(_col(x).cast("string"), "^nk/", f"{day}/")
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd")).otherwise(
        F.try_to_date(t, "d/M/yyyy")
    )


def time_between(later: Column | str, earlier: Column | str, unit: str = "months") -> Column:
    """Elapsed time as a double in days, months (365.25/12 days) or years."""
    factor = {"days": 1.0, "months": DAYS_PER_MONTH, "years": DAYS_PER_YEAR}.get(unit.lower())
    if factor is None:
        raise ValueError("unit must be 'days', 'months' or 'years'")
    days = F.datediff(_col(later), _col(earlier)).cast("double")
    return days if factor == 1.0 else days / F.lit(factor)


def time_between_instants(later: Column | str, earlier: Column | str, unit: str = "months") -> Column:
    """As :func:`time_between`, for timestamps: the fraction of a day counts."""
    factor = {"days": 1.0, "months": DAYS_PER_MONTH, "years": DAYS_PER_YEAR}.get(unit.lower())
    if factor is None:
        raise ValueError("unit must be 'days', 'months' or 'years'")
    seconds = _col(later).cast("timestamp").cast("double") - _col(earlier).cast("timestamp").cast("double")
    return seconds / F.lit(86_400.0 * factor)


def time_scale(pair: str | None) -> float:
    """Factor from one unit to another, ``"d_m"`` = days to months; 1 for none."""
    if pair is None or pair in ("", "none"):
        return 1.0
    days = {"d": 1.0, "m": DAYS_PER_MONTH, "y": DAYS_PER_YEAR}
    parts = pair.lower().split("_")
    if len(parts) != 2 or any(p not in days for p in parts):
        raise ValueError("a time scale has the form 'd_m', 'm_y', …")
    return days[parts[0]] / days[parts[1]]


def first_of_month(year: Column, month: Column) -> Column:
    return day_in_month(year, month, 1)


def month_days(year: Column, month: Column) -> Column:
    """All days of a month as an array of dates."""
    first = first_of_month(year, month)
    return F.when(first.isNotNull(), F.sequence(first, F.last_day(first)))


def in_month_year(date: Column, month: Column, year: Column) -> Column:
    """True when the date lies in the month; false when anything is missing."""
    return F.coalesce((F.month(date) == month) & (F.year(date) == year), F.lit(False))


def year_of_birth(birth: Column | str) -> Column:
    return F.year(_col(birth))


def age_at(date: Column | str, year: Column | str, birth: Column | str) -> Column:
    """Difference of calendar years; the year field stands in for a missing date."""
    return F.coalesce(F.year(_col(date)), _col(year).cast("int")) - F.year(_col(birth))


def mixed_serial_date(x: Column | str) -> Column:
    """``dd.MM.yyyy`` text or a five-digit day number; anything else is null."""
    t = _col(x)
    return F.when(t.rlike(r"^\d{2}\.\d{2}\.\d{4}$"), F.try_to_date(t, "dd.MM.yyyy")).when(
        t.rlike(r"^\d{5}$"), F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), t.try_cast("int"))
    )


def effective_end(end: Column, end_month: Column, end_year: Column) -> Column:
    """The end date, or the first of its month."""
    return F.coalesce(end, first_of_month(end_year, end_month))


def dates_in_order(diagnosis: Column, start: Column, end: Column) -> Column:
    """diagnosis ≤ start ≤ end, as far as the dates are known."""
    return F.coalesce(diagnosis <= start, F.lit(True)) & F.coalesce(start <= end, F.lit(True))


def base_name(column: str) -> str:
    """A dated column without its day suffix."""
    for d in DAYS:
        if column.endswith(f"_{d}"):
            return column[: -len(d) - 1]
    return column
