"""Quality rules over a patient's records, and repair of records out of line order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.operators.groups import attach
from hazardline.operators.scans import following, measure_keys, ordered_scan, position, preceding

# --- fixed values -----------------------------------------------------------------------------
MAINTENANCE = "Maintenance therapy"
STABLE_OR_PROGRESSIVE = ["SD", "PD"]
# ----------------------------------------------------------------------------------------------


def sequence_rules(df: DataFrame, order: Sequence[str] = ("cycle", "treat_line"), **scan) -> DataFrame:
    """Rows that break a rule, one row per rule broken, with the name of the rule.

    One ordered pass supplies the neighbours all six rules need; the rules are then filters on the
    row, so nothing is read or shuffled more than once.
    """
    steps = {
        "_next_line": following("treat_line"),
        "_prev_line": preceding("treat_line"),
        "_next_reason": following("drug1_start_reason"),
        "_next_drugs": following("drug_med_all"),
        "_next_before": following("progression_before_date_15"),
    }
    seen = ordered_scan(df, ["record_id"], order, steps, **scan)
    line, response = F.col("treat_line"), F.col("treat_best_response")
    own, before, relapse = (
        F.col("progression_date_15"),
        F.col("progression_before_date_15"),
        F.col("therapy_relapse_date_15"),
    )
    no_maintenance = F.col("_next_reason") != MAINTENANCE
    noted = F.col("progression_before_date_01").isNotNull() | relapse.isNotNull()
    not_sd_pd = ~F.coalesce(response.isin(STABLE_OR_PROGRESSIVE), F.lit(False))
    rules: dict[str, Column] = {
        "progress_same_line": response.isin(STABLE_OR_PROGRESSIVE)
        & noted
        & (line == F.col("_next_line"))
        & no_maintenance,
        "stable_same_drugs": (response == "SD")
        & (F.col("drug_med_all") == F.col("_next_drugs"))
        & no_maintenance,
        "line_change_without_progression": own.isNull() & before.isNotNull() & (line != F.col("_next_line")),
        "progression_without_line_change": (before.isNotNull() | relapse.isNotNull())
        & (line == F.col("_prev_line")),
        "line_change_without_response": (line != F.col("_prev_line"))
        & own.isNotNull()
        & relapse.isNotNull()
        & not_sd_pd,
        "progression_dates_differ": (F.col("_next_line") > line) & (own != F.col("_next_before")),
    }
    return _tag(seen, rules).drop(*steps)


def _tag(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return df.withColumn("rule", F.explode(broken))


def row_rules(df: DataFrame) -> DataFrame:
    """Rows that break a rule on their own values; rules whose columns are absent are skipped."""
    have = set(df.columns)
    rules: dict[str, Column] = {}
    if {"surv_stat", "surv_lost2fu_y_n"} <= have:
        rules["deceased_and_lost"] = (F.col("surv_stat") == "deceased") & (F.col("surv_lost2fu_y_n") == 1)
    if {"treat_line", "w_and_w_y_n"} <= have:
        rules["no_line_no_watch"] = F.col("treat_line").isNull() & F.col("w_and_w_y_n").isNull()
    if "progression_sv_last_date" in have:
        rules["has_last_progression"] = F.col("progression_sv_last_date").isNotNull()
    if not rules:
        raise ValueError("no rule applies to these columns")
    return _tag(df, rules)


def line_differences(df: DataFrame, order: Sequence[str] = ("cycle", "treat_line"), **scan) -> DataFrame:
    """All records of patients whose progression date differs from the next line's earlier one."""
    bad = sequence_rules(df, order, **scan).where(F.col("rule") == "progression_dates_differ")
    return df.join(bad.select("record_id").distinct(), "record_id", "left_semi")


def resort_unsorted(
    df: DataFrame, order: Sequence[str] = ("row_seq",), by: Sequence[str] = ("treat_line", "cycle"), **scan
) -> DataFrame:
    """``sort_seq`` per patient: by ``by`` where the lines are out of order, else by ``order``.

    ``resorted`` tells which patients changed. A patient with a missing line number is left alone.
    """
    if not scan:
        scan = {"sizes": measure_keys(df, ["record_id"])}
    seen = ordered_scan(df, ["record_id"], order, {"_prev_line": preceding("treat_line")}, **scan)
    per_patient = seen.groupBy("record_id").agg(
        (
            F.max(F.coalesce(F.col("_prev_line") > F.col("treat_line"), F.lit(False)))
            & ~F.max(F.col("treat_line").isNull())
        ).alias("resorted")
    )
    marked = attach(df, ["record_id"], per_patient)
    moved = F.col("resorted")
    keys = {f"_s{i}": F.when(moved, F.col(c)) for i, c in enumerate(by)}  # null where the patient keeps its order
    ranked = ordered_scan(
        marked.withColumns(keys), ["record_id"], [*keys, *order], {"sort_seq": position()}, **scan
    )
    return ranked.drop(*keys)


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
