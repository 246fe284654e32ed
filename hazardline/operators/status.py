"""Survival status: harmonised state, status date, and one row per patient."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.dates import impute_dates
from hazardline.operators.fill import latest_per_key

# --- fixed values -----------------------------------------------------------------------------
LOST = "Lost2FU"
UNKNOWN_STATES = ["nd", "unknown"]
# ----------------------------------------------------------------------------------------------


def harmonised_state(state: str = "surv_stat", lost: str = "surv_lost2fu_y_n") -> Column:
    """Unknown states and the lost flag become ``Lost2FU``."""
    return F.when(F.col(state).isin(UNKNOWN_STATES) | F.coalesce(F.col(lost) == 1, F.lit(False)), LOST).otherwise(
        F.col(state)
    )


def survival_status(sv: DataFrame, by: str = "cycle", tie: Sequence[str] = ()) -> DataFrame:
    """The latest status per patient with its dated variants.

    The month and year of a death noted with the patient also stand in for a missing month and
    year of last progression, as in the source; ``progression_sv_last_from_death`` marks those rows.
    """
    out = sv.withColumn(
        "progression_sv_last_from_death",
        (F.col("progression_sv_last_date_month").isNull() & F.col("dod_ic_date_month").isNotNull())
        | (F.col("progression_sv_last_date_year").isNull() & F.col("dod_ic_date_year").isNotNull()),
    ).withColumns(
        {
            "surv_dod_date": F.coalesce("surv_dod_date", "dod_ic_date"),
            "progression_sv_last_date_month": F.coalesce("progression_sv_last_date_month", "dod_ic_date_month"),
            "progression_sv_last_date_year": F.coalesce("progression_sv_last_date_year", "dod_ic_date_year"),
            "surv_stat": harmonised_state(),
        }
    )
    living = F.col("surv_stat").isin("alive", LOST)
    dead = F.col("surv_stat") == "deceased"

    def partial(base: str, part: str) -> Column:
        usable = F.col(base).isNull() & F.col(f"{base}_month").isNotNull() & F.col(f"{base}_year").isNotNull()
        return F.when(usable, F.col(f"{base}_{part}"))

    out = out.withColumns(
        {
            "status_date": F.when(living, F.col("last_contact_date")).when(dead, F.col("surv_dod_date")),
            **{
                f"status_date_{part}": F.when(living, partial("last_contact_date", part)).when(
                    dead, partial("surv_dod_date", part)
                )
                for part in ("month", "year")
            },
        }
    )
    latest = latest_per_key(out, by=by, tie=tie)
    return impute_dates(latest, ["status_date", "progression_sv_last_date"]).withColumn(
        "record_id", F.col("record_id").try_cast("double")
    )


def os_event(alive: str, lost: str) -> Column:
    """0 when alive or lost, else 1."""
    return F.when((F.col(alive) == 1) | (F.col(lost) == 1), 0).otherwise(1)


def pfs_event(progression: str, end: str) -> Column:
    """0 without progression, null without an end date, 1 when progression came before the end."""
    return (
        F.when(F.col(progression).isNull(), 0)
        .when(F.col(end).isNull(), None)
        .when(F.col(progression) < F.col(end), 1)
        .otherwise(0)
    )
