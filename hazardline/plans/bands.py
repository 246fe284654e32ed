"""Derived columns of the analysis sheet: bands, groups, dates and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.dates import mixed_serial_date, time_between
from hazardline.functions.text import factor
from hazardline.operators.status import os_event, pfs_event

# --- fixed values -----------------------------------------------------------------------------
BMI_LEVELS = ["<18.5", "18.5-24.9", "25-29.9", ">=30"]
BMI_MODEL_LEVELS = ["18.5-24.9", "25-29.9", ">=30", "<18.5"]
KI67_LEVELS = ["<20", ">=20"]
SITE_LEVELS = ["1", "2-3", ">3"]
DFI_LEVELS = ["de_novo", "DFI_<=24", "DFI_>24"]
DFI_LABELS = ["De novo", "DFI <=24 months", "DFI >24 months"]
FIRST_LINE_LABELS = ["ET mono/target", "ET + CDK4/6i", "Ctx +/- Bev"]
NO_YES = ["No", "Yes"]
END_DATE = "Date of death or Lost to FU or data cut off  31.12.2025"
# ----------------------------------------------------------------------------------------------


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bmi_band(x: Column | str, contiguous: bool = False) -> Column:
    """BMI classes. As in the source, values between 24.9 and 25 or 29.9 and 30 belong to none;
    ``contiguous`` closes the gaps.
    """
    x = _c(x)
    normal, over = (x < 25, x < 30) if contiguous else (x <= 24.9, x <= 29.9)
    return (
        F.when(x < 18.5, "<18.5")
        .when((x >= 18.5) & normal, "18.5-24.9")
        .when((x >= 25) & over, "25-29.9")
        .when(x >= 30, ">=30")
    )


def ki67_band(x: Column | str) -> Column:
    x = _c(x)
    return F.when(x < 20, "<20").when(x >= 20, ">=20")


def site_band(x: Column | str, two_in_first: bool = True) -> Column:
    """Bands of the number of metastatic sites; as in the source, two sites fall in the first."""
    x = _c(x)
    first = [0, 1, 2] if two_in_first else [0, 1]
    return F.when(x.isin(first), "1").when(x.isin(2, 3), "2-3").when(x.isin(4, 5, 6), ">3")


def first_line_group(x: Column | str) -> Column:
    x = _c(x)
    return F.when(x.isin(0, 2), 0).when(x == 1, 1).when(x == 3, 2)


def dfi_group(de_novo: Column | str, dfi: Column | str) -> Column:
    n, d = _c(de_novo), _c(dfi)
    return F.when(n == 1, "de_novo").when((n == 0) & (d == 0), "DFI_<=24").when((n == 0) & (d == 1), "DFI_>24")


def menopause(x: Column | str) -> Column:
    x = _c(x)
    return F.when(x.isin(0, 1), "pre_peri").when(x == 2, "post").when(x == 3, "unknown")


def prepare_sheet(
    sheet: DataFrame, *, censor_at_end: bool = False, contiguous_bmi: bool = False, two_in_first: bool = True
) -> DataFrame:
    """The derived columns of the sheet in one projection.

    Patients without progression have PFS event 0 and no time, as in the source;
    ``censor_at_end`` gives them the time to the end date.
    """
    diagnosis = mixed_serial_date("`mBC diagnosis`")
    end, progression = F.col(f"`{END_DATE}`"), F.col("`date of PD`")
    until = F.coalesce(progression, end) if censor_at_end else progression
    return sheet.withColumns(
        {
            "OS_event": os_event("`Alive`", "`Lost to FU`"),
            "BMI_cat": bmi_band("BMI", contiguous_bmi),
            "ki_67_cat": ki67_band("`Ki-67`"),
            "num_met_sites": site_band("`Number of metastatic sites`", two_in_first),
            "firstline_hr": factor(first_line_group("`1st line HR+`"), [0, 1, 2], FIRST_LINE_LABELS),
            "Menopausal_status": menopause("`Menopausal status`"),
            "DFI_combined": dfi_group("`De novo`", "DFI"),
            "DFI & De Novo": factor(dfi_group("`De novo`", "DFI"), DFI_LEVELS, DFI_LABELS),
            "Visc. disease": factor("`Visceral disease`", [0, 1], NO_YES),
            "Arm": factor("Sarcopenia", [0, 1], NO_YES),
            "mBC_diagnosis_date": diagnosis,
            "OS_time": time_between(end, diagnosis),
            "PFS_time": time_between(until, diagnosis),
            "PFS_event": pfs_event("`date of PD`", f"`{END_DATE}`"),
        }
    )
