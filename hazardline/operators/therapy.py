"""Treatment cleaning, regimen flags, therapy classes and line-level progression labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.functions.dates import impute_dates
from hazardline.functions.dictionary import decode
from hazardline.functions.text import (
    BRAND_GENERIC,
    BRAND_PATTERN,
    capitalize_words,
    checkbox_text,
    drop_other,
    drop_parenthesis,
    empty_to_null,
    fix_spelling,
    grade_label,
    normalise_regimen,
    recode,
    replace_first,
    two_site_label,
    unite,
)
from hazardline.operators.contracts import select_names
from hazardline.operators.groups import (
    SITES,
    YES_NO,
    YES_NO_NOT_DONE,
    any_present,
    attach,
    best_response_parts,
    line_union_text,
    paste_without_null,
    order_struct,
    priority_any,
)

# --- fixed values -----------------------------------------------------------------------------
DRUG_CLASSES = ["chemo", "immune", "target", "other"]
RESPONSE_CODES = {"99": "Unknown", "nd": "Not done", "3": "CR", "2": "PR", "1": "SD", "4": "PD", "5": "NE"}
NO_TREATMENT_REASON = {
    "no_sympt": "No symptoms",
    "pat_dec": "Patient decision",
    "inv_dec": "Doctor's decision",
    "other": "Other",
}
LABELLED = ["drug1_start_reason", "drug1_end_reason", "therapy_status", "treat_rebiopsy"]
PLAIN_DATES = [
    "progression_before_date",
    "treat_best_response_date",
    "treat_trans_date",
    "progression_date",
    "treat_best_response_petct_date",
]
# whole words in the upper-cased cleaned text, any case
FLAG_WORDS = {
    "bsc_any_flag": ["BEST SUPPORTIVE CARE", "BSC"],
    "rt_flag": ["RADIOTHERAPY"],
    "intrathecal_flag": ["INTRATHECAL THERAPY"],
    "rcomp_flag": ["R-COMP"],
    "repoch_flag": ["DA-R-EPOCH", "R-DA-EPOCH", "R-EPOCH", "EPOCH"],
    "pola_rchp_flag": ["POLA-R-CHP", "POLA-R-CHOP"],
    "chop_flag": ["CHOP"],
    "asct_flag": ["AUTOLOGOUS-HCT", "AUTOLOGOUS HCT", "HDT", "ASCT"],
    "allo_flag": ["ALLOGENEIC-HCT", "ALLOGENEIC HCT"],
    "beam_flag": ["BEAM"],
    "salvage_gdp_flag": ["GDP", "R-GDP"],
    "salvage_dhap_flag": ["DHAP", "R-DHAP"],
    "salvage_ice_flag": ["ICE", "R-ICE", "ESHAP"],
    "matrix_flag": ["MATRIX"],
    "gemox_flag": ["GEMOX", "R-GEMOX"],
    "benda_flag": ["BENDAMUSTINE", "R-BENDAMUSTIN", "R-BENDAMUSTINE", "BR"],
    "gemcitabine_flag": ["GEMCITABINE"],
    "pixantrone_flag": ["PIXANTRONE"],
    "paclitaxel_flag": ["PACLITAXEL"],
    "pola_flag": ["POLATUZUMAB", "POLA"],
    "tafa_flag": ["TAFASITAMAB"],
    "glofi_flag": ["GLOFITAMAB"],
    "epco_flag": ["EPCORITAMAB"],
    "mosun_flag": ["MOSUNETUZUMAB"],
    "cart_flag": ["AXI-CEL", "TISA-CEL", "LISO-CEL", "BREXU-CEL", "CAR-T", "CAR T"],
    "acala_flag": ["ACALABRUTINIB"],
    "ibrutinib_flag": ["IBRUTINIB"],
    "veneto_flag": ["VENETOCLAX"],
    "len_flag": ["LENALIDOMIDE", "R-LENALIDOMIDE", "POMALIDOMID"],
    "checkpoint_flag": ["PEMBROLIZUMAB", "NIVOLUMAB", "DURVALUMAB", "SPARTALIZUMAB", "TAMINADENANT"],
    "other_targeted_flag": ["SELINEXOR", "IBRITUMOMAB", "ZEVALIN", "EVUSHELD"],
}
# whole words in the raw list, any case
ANTHRACYCLINE_WORDS = [
    "Doxorubicin",
    "Epirubicin",
    "Idarubicin",
    "Non-pegylated liposomal(?:em)? Doxorubicin",
    "Liposomal Doxorubicin",
    "R-?CHOP",
    "CHOP",
    "R-?CHP",
    "CHP",
    "R-?EPOCH",
    "DA-?R-?EPOCH",
    "R-?COMP",
    "COMP",
    "POLA-?R-?CHP",
    "POLA-?R-?CMP",
]
RCHOP_PATTERN = r"\bR-CHOP\b"
RITUXIMAB_ONLY = r"(?i)^\s*RITUXIMAB\s*$"
ANTIBODY_ONLY = r"(?i)^\s*(RITUXIMAB|OBINUTUZUMAB|OFATUMUMAB)\s*$"
INTENSIVE = ["salvage_gdp_flag", "salvage_dhap_flag", "salvage_ice_flag", "matrix_flag", "repoch_flag"]
NON_INTENSIVE = ["benda_flag", "gemox_flag", "pixantrone_flag", "gemcitabine_flag", "paclitaxel_flag"]
BISPECIFIC = ["glofi_flag", "epco_flag", "mosun_flag"]
BTK = ["acala_flag", "ibrutinib_flag"]
TARGETED = [
    "cart_flag", "pola_flag", "tafa_flag", "bispecific_flag", "btk_flag",
    "veneto_flag", "len_flag", "checkpoint_flag", "other_targeted_flag",
]
SYSTEMIC = [
    "rchop_flag", "rcomp_flag", "repoch_flag", "pola_rchp_flag", "asct_flag", "allo_flag", "intensive_chemo_flag",
    "nonintensive_chemo_flag", "targeted_flag", "ritux_only_flag", "antibody_only_flag", "chop_flag",
]
NONE = "No treatment/BSC"
GROUP_FIRST = ["rchop_flag", "rcomp_flag", "repoch_flag", "pola_rchp_flag", "asct_flag", "chop_flag"]
GROUP_LATER = ["asct_flag", "intensive_chemo_flag", "nonintensive_chemo_flag", "targeted_flag", "ritux_only_flag"]
SUBGROUP_FIRST = {
    "pola_rchp_flag": "Pola-R-CHP",
    "repoch_flag": "R-DA-EPOCH/EPOCH",
    "rchop_flag": "R-CHOP",
    "rcomp_flag": "R-COMP",
    "asct_flag": "HDT + ASCT consolidation",
    "chop_flag": "CHOP",
}
SUBGROUP_LATER = {
    "asct_flag": "HDT + ASCT consolidation",
    "salvage_gdp_flag": "GDP/R-GDP",
    "salvage_dhap_flag": "DHAP/R-DHAP",
    "salvage_ice_flag": "ICE/R-ICE/ESHAP",
    "matrix_flag": "MATRIX-based intensive chemotherapy",
    "repoch_flag": "R-DA-EPOCH/EPOCH",
    "benda_flag": "R-Bendamustine/BR",
    "gemox_flag": "GEMOX/R-GEMOX",
    "pixantrone_flag": "Pixantrone-based",
    "gemcitabine_flag": "Gemcitabine-based",
    "paclitaxel_flag": "Paclitaxel-based",
    "cart_flag": "CAR T-cell therapy",
    "tafa_flag": "Tafasitamab-based",
    "glofi_flag": "Glofitamab-based",
    "epco_flag": "Epcoritamab-based",
    "mosun_flag": "Mosunetuzumab-based",
    "pola_flag": "Polatuzumab-based",
    "btk_flag": "BTK inhibitor-based",
    "veneto_flag": "Venetoclax-based",
    "len_flag": "IMiD-based",
    "checkpoint_flag": "Checkpoint inhibitor-based",
    "other_targeted_flag": "Other targeted/novel therapy",
    "ritux_only_flag": "Rituximab only",
    "antibody_only_flag": "Antibody only",
}
CATEGORY_LATER = {
    "asct_flag": "Intensive chemotherapy (curative)",
    "intensive_chemo_flag": "Intensive chemotherapy (curative)",
    "nonintensive_chemo_flag": "Non-intensive chemotherapy (palliative)",
    "targeted_flag": "Targeted / novel therapy",
    "ritux_only_flag": "Antibody / low-intensity therapy",
}
FRONTLINE = "Frontline treatment"
INTENTION = {
    "Intensive chemotherapy (curative)": "Curative",
    "Non-intensive chemotherapy (palliative)": "Palliative",
    "Targeted / novel therapy": "Palliative",
}
# ----------------------------------------------------------------------------------------------


def words_pattern(words: Sequence[str]) -> str:
    """Any of the words, whole, ignoring case."""
    return "(?i)" + "|".join(rf"\b{w}\b" for w in words)


def _any(flags: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f) for f in flags])


def rchop_flag(x: Column | str) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(x.rlike(RCHOP_PATTERN), F.lit(False))


def treatment_flags(
    df: DataFrame, drugs: str = "drug_med_all_line", treated: str = "treat_y_n", line: str = "treat_line"
) -> DataFrame:
    """Regimen flags and the four therapy classes of a line.

    ``rchop_flag`` is taken from the table when present (it is set on the record's own drug list
    before lines are formed), else computed from ``drugs``.
    """
    out = df.withColumn(drugs, F.coalesce(F.col(drugs), F.lit("")))
    if "rchop_flag" not in out.columns:
        out = out.withColumn("rchop_flag", rchop_flag(drugs))
    out = out.withColumn("drug_clean", normalise_regimen(drugs)).withColumn("drug_upper", F.upper("drug_clean"))
    text = F.col("drug_upper")
    single: dict[str, Column] = {name: text.rlike(words_pattern(words)) for name, words in FLAG_WORDS.items()}
    single["chop_flag"] = single["chop_flag"] & ~F.col("rchop_flag")
    single["benda_flag"] = single["benda_flag"] & ~single["pola_rchp_flag"]
    single["empty_flag"] = text == ""
    single["anthracyclin_flag"] = F.col(drugs).rlike(words_pattern(ANTHRACYCLINE_WORDS))
    single["ritux_only_flag"] = text.rlike(RITUXIMAB_ONLY)
    single["antibody_only_flag"] = text.rlike(ANTIBODY_ONLY)
    out = (
        out.withColumns(single)
        .withColumns(
            {
                "intensive_chemo_flag": _any(INTENSIVE),
                "nonintensive_chemo_flag": _any(NON_INTENSIVE),
                "bispecific_flag": _any(BISPECIFIC),
                "btk_flag": _any(BTK),
            }
        )
        .withColumn("targeted_flag", _any(TARGETED))
        .withColumn("any_systemic_flag", _any(SYSTEMIC))
    )
    out = out.withColumn(
        "no_treatment_bsc_flag",
        F.col("empty_flag") | ((F.col("bsc_any_flag") | (F.col(treated) == "no")) & ~F.col("any_systemic_flag")),
    )
    return therapy_classes(out, line)


def therapy_classes(df: DataFrame, line: str = "treat_line") -> DataFrame:
    """Group, subgroup, category and intention from the flags; the first match wins."""
    none, first, later = F.col("no_treatment_bsc_flag"), F.col(line) == 1, F.col(line) >= 2

    def chain(start: Column, test: Column, labels: dict[str, str]) -> Column:
        for flag, label in labels.items():
            start = start.when(test & F.col(flag), F.lit(label))
        return start

    group = (
        F.when(none, NONE)
        .when(first & _any(GROUP_FIRST), "Any treatment")
        .when(later & _any(GROUP_LATER), "Any treatment")
        .otherwise("Other")
    )
    subgroup = chain(F.when(none, NONE), first, SUBGROUP_FIRST).when(first, "Other")
    subgroup = chain(subgroup, later, SUBGROUP_LATER).otherwise("Other")
    category = chain(F.when(none, NONE).when(first, FRONTLINE), later, CATEGORY_LATER).otherwise("Other")
    out = df.withColumns({"therapy_group": group, "therapy_subgroup": subgroup, "therapy_category": category})
    intention = F.when(first, "-")
    for label, aim in INTENTION.items():
        intention = intention.when(F.col("therapy_category") == label, aim)
    return out.withColumn("treatment_intention", intention.when(none, "Palliative"))


def drug_columns(df: DataFrame) -> list[str]:
    """The drug name columns, in table order, with cell therapy and transplant type last."""
    found = select_names(df, starts_with="drug_med", without=["check", "cycle", "end"])
    return found + [c for c in ("drug_car_type", "treat_trans_type") if c in df.columns]


def clean_therapy(thx: DataFrame) -> tuple[DataFrame, list[str]]:
    """Spelling, checkboxes and grades; also the list of columns that name a drug."""
    drugs = drug_columns(thx)
    spelled = thx.withColumns({c: fix_spelling(c) for c in drugs})
    out = spelled.withColumns(
        {
            "drug_med_comb": F.upper("drug_med_comb"),
            "drug_intrathecal": checkbox_text("drug_intrathecal_check___1", "Intrathecal therapy"),
            "drug_radiotherapy": checkbox_text("drug_med_check_radio___1", "Radiotherapy"),
            "drug_bsc": checkbox_text("drug_best_supportive_check___1", "Best supportive care"),
            "progression_before_type": two_site_label(
                "progression_before_type___cns", "progression_before_type___periphery"
            ),
            "progression_type": two_site_label("progression_type___cns", "progression_type___periphery"),
            "treat_line_ecog": grade_label("treat_line_ecog"),
        }
    )
    return out, [*drugs, "drug_intrathecal", "drug_radiotherapy", "drug_bsc"]


def combine_drugs(thx: DataFrame, dd: DataFrame, drugs: Sequence[str]) -> DataFrame:
    """Decode the drug columns and join them: all drugs, and one list per drug class."""
    other = [f"drug_medother{i}" for i in (1, 2, 3)]
    coded = [
        c for c in drugs if c.startswith("drug_med") and c != "drug_med_comb" and not c.endswith("_other") and c not in other
    ]
    out = decode(thx, dd, [*coded, *other])
    out = out.withColumns({c: drop_parenthesis(c) for c in select_names(out, starts_with="drug_medother")})
    lists = {"drug_med_all": capitalize_words(drop_other(unite(drugs)))}
    for k in DRUG_CLASSES:
        lists[f"drug_med_{k}"] = unite([f"drug_med{k}{i}" for i in (1, 2, 3)] + [f"drug_med{k}_other"])
    out = out.withColumns(lists)
    return out.withColumns(
        {c: replace_first(c, BRAND_PATTERN, BRAND_GENERIC) for c in ("drug_med_all", "drug_med_chemo")}
    )


def label_treatment(thx: DataFrame, dd: DataFrame) -> DataFrame:
    """Reasons, responses and drug lists in readable form; line number as integer."""
    reason = recode("treat_no_reason", NO_TREATMENT_REASON)
    lists = ["drug_med_all", "drug_med_comb", *[f"drug_med_{k}" for k in DRUG_CLASSES]]
    out = thx.withColumn(
        "treat_no_reason", F.when(reason == "Other", F.col("treat_no_reason_other")).otherwise(reason)
    )
    out = decode(out, dd, LABELLED)
    return out.withColumns(
        {
            "treat_best_response": recode("treat_best_response", RESPONSE_CODES, keep_rest=True),
            "treat_line": F.col("treat_line").try_cast("int"),
            "record_id": F.col("record_id").try_cast("double"),
            **{c: replace_first(empty_to_null(c), "other, ", "other - ") for c in lists},
        }
    )


def impute_therapy_dates(thx: DataFrame) -> DataFrame:
    """Dated variants of the eight therapy dates."""
    specs: dict[str, Column | None] = {
        "therapy_start_date": F.col("treat_y_n") == 1,
        "therapy_end_date": F.col("treat_y_n") == 1,
        "therapy_relapse_date": F.col("therapy_relapse_y_n") == "yes",
    }
    return impute_dates(thx, {**specs, **dict.fromkeys(PLAIN_DATES)})


def progression_labels(
    df: DataFrame,
    *,
    order: Sequence[str] = ("cycle",),
    union_columns: Sequence[str] = (),
    per_line_progression: bool = True,
) -> DataFrame:
    """Line-level values repeated on every record of the line.

    Aggregates per line, joined back once: no window over the records. ``per_line_progression=False``
    keeps the row's own progression flag instead of the line's.
    """
    keys = ["record_id", "treat_line"]
    rows = df.where(F.col("record_id").isNotNull()).withColumn(
        "treat_y_n", recode(F.col("treat_y_n").cast("string"), {"1": "yes", "0": "no"})
    )
    by = order_struct(*order)
    best, best_text = best_response_parts("treat_best_response", by)
    values = rows.groupBy(*keys).agg(
        *[c.alias(n) for n, c in best.items()],
        F.when(F.max(F.when(F.col("treat_study") == 1, 1)) == 1, "yes")
        .when(F.max(F.when(F.col("treat_study") == 0, 1)) == 1, "no")
        .alias("treat_study_line"),
        priority_any("therapy_relapse_y_n", YES_NO_NOT_DONE).alias("therapy_relapse_y_n_line"),
        any_present("progression_before_date").alias("progression_before_y_n_line"),
        priority_any("progression_before_type", SITES).alias("progression_before_type_line"),
        priority_any("progression_type", SITES).alias("progression_type_line"),
        any_present("progression_type").alias("_progression"),
        paste_without_null("treat_best_response", by).alias("treat_best_response_all"),
        priority_any(recode("treat_best_response_petct", {"ja": "yes", "nein": "no"}), YES_NO).alias("_petct"),
        priority_any("treat_rebiopsy", YES_NO_NOT_DONE).alias("treat_rebiopsy_line"),
    )
    union = ["drug_med_all", *[c for c in union_columns if c != "drug_med_all"]]
    values = attach(
        values.withColumn("treat_best_response_line", best_text).drop(*best), keys, line_union_text(rows, keys, union)
    )
    out = attach(rows, keys, values)
    own = F.when(F.col("progression_type").isNotNull(), "yes").otherwise("no")
    return out.withColumns(
        {
            "progression_y_n_line": F.col("_progression") if per_line_progression else own,
            "treat_best_response_petct": F.col("_petct"),
        }
    ).drop("_progression", "_petct")
