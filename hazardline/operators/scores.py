"""Prognostic scores from baseline fields."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
STANDARD = {0: "Low (0-1)", 1: "Low (0-1)", 2: "Low-intermediate (2)", 3: "High-intermediate (3)", 4: "High (4-5)", 5: "High (4-5)"}
REVISED = {0: "Very good (0)", 1: "Good (1-2)", 2: "Good (1-2)", 3: "Poor (3-5)", 4: "Poor (3-5)", 5: "Poor (3-5)"}
AGE_ADJUSTED = {0: "Low (0)", 1: "Intermediate (1)", 2: "High (2-3)", 3: "High (2-3)"}
CNS = {
    0: "Low (0-1)", 1: "Low (0-1)", 2: "Low-intermediate (2-3)", 3: "Low-intermediate (2-3)",
    4: "High (4-6)", 5: "High (4-6)", 6: "High (4-6)",
}
NCCN = {
    0: "Low (0-1)", 1: "Low (0-1)", 2: "Low-intermediate (2-3)", 3: "Low-intermediate (2-3)",
    4: "High-intermediate (4-5)", 5: "High-intermediate (4-5)", 6: "High (6-8)", 7: "High (6-8)", 8: "High (6-8)",
}
FLIPI_POINTS = ["diag_flipi_age", "diag_flipi_stage", "diag_flipi_hemo", "diag_flipi_ldh", "diag_flipi_site"]
FLIPI2_POINTS = ["diag_flipi_age", "diag_flipi2_node", "diag_flipi_hemo", "diag_flipi_b2mg", "diag_flipi2_marrow"]
OTHER_SITES = ["diag_extranodal_site_other", "diag_extranodal_site_other_2", "diag_extranodal_site_other_3"]
# FLIPI and FLIPI2 risk groups as published (Blood 2004;104:1258, JCO 2009;27:4555)
FLIPI = {0: "Low", 1: "Low", 2: "Intermediate", 3: "High", 4: "High", 5: "High"}
FLIPI2 = {0: "Low", 1: "Intermediate", 2: "Intermediate", 3: "High", 4: "High", 5: "High"}
# ----------------------------------------------------------------------------------------------


def row_sum(columns: Sequence[str | Column]) -> Column:
    """Sum across columns; null when any part is null."""
    return reduce(lambda a, b: a + b, [F.col(c) if isinstance(c, str) else c for c in columns])


def _point(test: Column) -> Column:
    """1 or 0, null when the test is null."""
    return test.cast("int")


def score_label(score: Column | str, bands: dict[int, str]) -> Column:
    """``<band> score: <n>``."""
    s = F.col(score) if isinstance(score, str) else score
    out = None
    for n, band in bands.items():
        text = F.lit(f"{band} score: {n}")
        out = F.when(s == n, text) if out is None else out.when(s == n, text)
    return out


def ldh_point(rule: str = "intended") -> Column:
    """LDH part of the score.

    ``intended``: 1 when the value exceeds the upper normal value, or it was marked elevated, or the
    ratio exceeds 1; 0 when any of these is known and none holds. ``literal``: the presence test of
    the source, never null.
    """
    value, normal = F.col("diag_ldh_diag"), F.col("diag_ldh_baseline")
    marked, ratio = F.col("diag_ldh_elevated_y_n"), F.col("diag_ldh_ratio")
    if rule == "literal":
        # presence of either value scores 1; only when both are missing do the other two decide
        either = value.isNotNull() | normal.isNotNull()
        return F.when(either | (marked == "yes") | (ratio > 1), 1).otherwise(0)
    if rule != "intended":
        raise ValueError("ldh rule must be 'intended' or 'literal'")
    known = (value.isNotNull() & normal.isNotNull()) | marked.isin("yes", "no", "unk") | ratio.isNotNull()
    return F.when((value > normal) | (marked == "yes") | (ratio > 1), 1).when(known, 0)


def score_components(df: DataFrame, ldh_rule: str = "intended") -> DataFrame:
    """The parts of the IPI and NCCN-IPI."""
    age, ratio = F.col("diagnosis_age"), F.col("diag_ldh_ratio")
    sites = [c for c in df.columns if c.startswith("diag_extranodal_site___")]
    others = [F.col(c).isNotNull().cast("int") for c in OTHER_SITES if c in df.columns]
    out = df.withColumns(
        {
            "diag_ipi_age": _point(age > 60),
            "diag_ipi_stage": F.when(F.col("diag_stage").isin("3", "4"), 1).when(F.col("diag_stage").isin("1", "2"), 0),
            "diag_ipi_ecog": F.when(F.col("diag_ecog").isin("2", "3", "4"), 1).when(F.col("diag_ecog").isin("0", "1"), 0),
            "diag_ipi_ldh": ldh_point(ldh_rule),
            "diag_ipi_site_n": row_sum([*sites, *others]),
            "diag_ipi_site_cns": _point(
                (F.col("diag_extranodal_site___adrenal") == 1) | (F.col("diag_extranodal_site___kidney") == 1)
            ),
            "diag_nccn_age": F.when(age <= 40, 0).when(age <= 60, 1).when(age <= 75, 2).when(age > 75, 3),
            "diag_nccn_ldh": F.when(ratio > 3, 2).when(ratio > 1, 1).when(ratio.isNotNull(), 0),
        }
    )
    return out.withColumn("diag_ipi_site", _point(F.col("diag_ipi_site_n") > 1)).withColumns(
        {
            "diag_nccn_stage": F.col("diag_ipi_stage"),
            "diag_nccn_ecog": F.col("diag_ipi_ecog"),
            "diag_nccn_site": F.col("diag_ipi_site"),
        }
    )


def scores(df: DataFrame) -> DataFrame:
    """Totals (null when a part is null) and their labels."""
    ipi = ["diag_ipi_age", "diag_ipi_stage", "diag_ipi_ecog", "diag_ipi_ldh", "diag_ipi_site"]
    out = df.withColumns(
        {
            "diag_ipi_n": row_sum(ipi),
            "diag_ipi_n_aa": row_sum(ipi[1:4]),
            "diag_ipi_n_cns": row_sum([*ipi, "diag_ipi_site_cns"]),
            "diag_nccn_n": row_sum(
                ["diag_nccn_age", "diag_ipi_stage", "diag_ipi_ecog", "diag_nccn_ldh", "diag_ipi_site"]
            ),
        }
    )
    return out.withColumns(
        {
            "diag_ipi_score_standard": score_label("diag_ipi_n", STANDARD),
            "diag_ipi_score_revised": score_label("diag_ipi_n", REVISED),
            "diag_ipi_score_aa": score_label("diag_ipi_n_aa", AGE_ADJUSTED),
            "diag_ipi_score_cns": score_label("diag_ipi_n_cns", CNS),
            "diag_nccn_score": score_label("diag_nccn_n", NCCN),
        }
    )


def flipi(
    df: DataFrame,
    *,
    age: Column,
    stage: Column,
    hemoglobin: Column,
    ldh_elevated: Column,
    nodal_areas: Column,
    node_cm: Column,
    b2m_elevated: Column,
    marrow: Column,
) -> DataFrame:
    """FLIPI and FLIPI2: their points (1, 0, or null when unknown), counts and risk groups (null when a point is).

    Parts are conditions or values of the caller's columns; ``stage`` is the number 1 to 4.
    """
    tests = dict(zip(FLIPI_POINTS, [age > 60, stage >= 3, hemoglobin < 12, ldh_elevated, nodal_areas > 4], strict=True))
    tests |= dict(zip(FLIPI2_POINTS, [age > 60, node_cm > 6, hemoglobin < 12, b2m_elevated, marrow], strict=True))
    out = df.withColumns({name: _point(test) for name, test in tests.items()}).withColumns(
        {"diag_flipi_n": row_sum(FLIPI_POINTS), "diag_flipi2_n": row_sum(FLIPI2_POINTS)}
    )

    def grade(column: str, bands: dict[int, str]) -> Column:
        return F.get(F.array(*[F.lit(bands[i]) for i in sorted(bands)]), F.col(column))

    return out.withColumns(
        {
            "diag_flipi_risk_grade": grade("diag_flipi_n", FLIPI),
            "diag_flipi2_risk_grade": grade("diag_flipi2_n", FLIPI2),
        }
    )
