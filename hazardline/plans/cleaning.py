"""The two registry runs end to end: import parts in, line and patient tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.dates import age_at, impute_dates, year_of_birth
from hazardline.functions.dictionary import decode
from hazardline.functions.text import empty_to_null, onehot_label, other_with_text, prefixed, recode, unite
from hazardline.operators.contracts import assert_schema, require_columns, require_tables
from hazardline.operators.groups import max_treat_line
from hazardline.operators.impute import impute_dates_empirical
from hazardline.operators.lines import calc_pfs_os
from hazardline.operators.scans import first_per_key
from hazardline.operators.scores import OTHER_SITES, score_components, scores
from hazardline.operators.status import survival_status
from hazardline.operators.therapy import (
    clean_therapy,
    combine_drugs,
    impute_therapy_dates,
    label_treatment,
    progression_labels,
    treatment_flags,
)

# --- fixed values -----------------------------------------------------------------------------
COO = {"gcb": "GCB", "abc": "nonGCB", "nongcb": "nonGCB"}
STAGES = {"1": "1", "2": "2", "3": "3", "4": "4"}
ECOG = {"0": "0", "1": "1", "2": "2", "3": "3", "4": "4"}
PET = {"n": "no", "y": "yes", "unk": "unknown"}
DECODED = [
    "diagnosis", "diag_ecog", "diag_stage", "diagnosis_subtype_test", "diagnosis_subtype",
    "diagnosis_transformation_before", "diag_extranodal", "registry_ic",
]
FREE_TEXT = {
    "diagnosis": "diagnosis_other",
    "diagnosis_subtype": "diagnosis_subtype_other",
    "diagnosis_transformation_before": "diagnosis_subtype_other",
}
DIAGNOSIS_DATES = ["diagnosis_date", "diagnosis_transformation_date"]
KEPT_START_REASONS = [
    "First diagnosis", "Progression", "No Reponse / stable disease", "Not done", "Patient's decision", "Toxicity",
]
# ----------------------------------------------------------------------------------------------


def clean_patients(base: DataFrame, dd: DataFrame, ldh_rule: str = "intended") -> DataFrame:
    """Age, scores, recoded and decoded fields, site text and dated variants of the diagnosis.

    Age comes first, so that the scores see it.
    """
    require_columns(base, [f"{d}{s}" for d in DIAGNOSIS_DATES for s in ("", "_month", "_year")], "patient table")
    aged = base.withColumns(
        {
            "yob": year_of_birth("datum_geb"),
            "diagnosis_age": age_at("diagnosis_date", "diagnosis_date_year", "datum_geb"),
        }
    )
    scored = scores(score_components(aged, ldh_rule))
    coded = scored.withColumns(
        {
            "diagnosis_subtype_coo": recode("diagnosis_subtype_coo", COO),
            "diag_stage": recode("diag_stage", STAGES),
            "diag_ecog": recode("diag_ecog", ECOG),
            "diag_stage_pet": recode("diag_stage_pet", PET),
        }
    )
    named = decode(coded, dd, [c for c in DECODED if c in coded.columns])
    sites = [c for c in named.columns if c.startswith("diag_extranodal_site___")]
    free = {c: other_with_text(c, t) for c, t in FREE_TEXT.items() if c in named.columns}
    others = {c: prefixed(c, f"Other{i} - ") for i, c in enumerate(OTHER_SITES, 1)}
    out = named.withColumns({**free, **{c: onehot_label(c) for c in sites}, **others})
    shown = [c for c in sites if "other" not in c]
    return impute_dates(
        out.withColumns(
            {
                "diag_site": empty_to_null(unite([*shown, *OTHER_SITES])),
                "record_id": F.col("record_id").try_cast("double"),
            }
        ),
        DIAGNOSIS_DATES,
    )


def clean_records(thx: DataFrame, dd: DataFrame) -> DataFrame:
    """Therapy records: drugs, labels and dated variants."""
    cleaned, drugs = clean_therapy(thx)
    return impute_therapy_dates(label_treatment(combine_drugs(cleaned, dd, drugs), dd))


def build_cohort(diag: DataFrame, thx: DataFrame, sv: DataFrame, *more: DataFrame, key: str = "record_id") -> DataFrame:
    """Left joins on the patient id; columns a table shares with an earlier one are taken from the earlier."""
    def add(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right.drop(*[c for c in right.columns if c in left.columns and c != key]), key, "left")

    return reduce(add, [thx, sv, *more], diag)


def run_registry(
    parts: Mapping[str, DataFrame],
    *,
    seed: int,
    line_columns: Sequence[str] | None = None,
    patient_columns: Sequence[str] | None = None,
    tie: Sequence[str] = ("cycle",),
    ldh_rule: str = "intended",
    max_delta: int = 365,
    use_groups: bool = True,
) -> dict[str, DataFrame]:
    """``base``, ``thx``, ``sv`` and ``dd`` to the line table ``tot`` and the patient table ``pat``.

    With column lists the outputs must have exactly those columns, in that order.
    """
    require_tables(parts, ["base", "thx", "sv", "dd"])
    dd = parts["dd"]
    diag = clean_patients(parts["base"], dd, ldh_rule)
    thx = clean_records(parts["thx"], dd)
    sv = survival_status(parts["sv"])
    # kept where several later steps read the same rows: the joined records and the labelled records
    cohort = build_cohort(diag.drop("cycle"), thx, sv.drop("cycle")).persist()
    union = [c for c in ("drug_med_comb", "treat_trans_type", "drug_car_type") if c in cohort.columns]
    labelled = progression_labels(cohort, order=tie, union_columns=union).persist()
    marks = max_treat_line(labelled).select("record_id", "cycle", "max_treat_line").distinct()
    imputed = impute_dates_empirical(
        labelled, seed=seed, max_delta=max_delta, use_groups=use_groups, order=("treat_line", *tie)
    )
    flagged = treatment_flags(calc_pfs_os(imputed, tie=tie))
    tot = flagged.where(F.col("record_id").isNotNull()).join(marks, ["record_id", "cycle"], "left")
    pat = first_per_key(tot, ["record_id"], [("treat_line", "asc"), *[(t, "asc") for t in tie]])
    if line_columns is not None:
        tot = assert_schema(tot.select(*[c for c in tot.columns if c in set(line_columns)]), line_columns)
    if patient_columns is not None:
        pat = assert_schema(pat.select(*[c for c in pat.columns if c in set(patient_columns)]), patient_columns)
    return {"tot": tot, "pat": pat, "diag": diag, "thx": thx, "sv": sv}


def second_cohort_lines(final: DataFrame, line: DataFrame, patient: Sequence[str], id_test: Column) -> DataFrame:
    """Patients that pass the id and start-reason filters, joined to their lines by patient only."""
    kept = final.where(id_test & (F.col("drug1_start_reason").isin(KEPT_START_REASONS) | F.col("drug1_start_reason").isNull()))
    people = first_per_key(kept.select("record_id", *patient, "cycle"), ["record_id"], [("cycle", "asc")]).drop("cycle")
    return people.join(line, "record_id", "left")
