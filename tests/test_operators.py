import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardline.functions.dates import DAYS
from hazardline.operators import fill, groups, impute, lines, quality, scores, status, summary, therapy

D = dt.date


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# --- fill ---------------------------------------------------------------------------------------


def test_fill_golden(spark):
    df = spark.createDataFrame([("p", 1, "x"), ("p", 2, None), ("p", 3, None), ("p", 4, "y")], "record_id string, row_seq int, v string")
    assert [r[0] for r in rows(fill.fill(df, down=["v"]).orderBy("row_seq"), "v")] == ["x", "x", "x", "y"]
    assert [r[0] for r in rows(fill.fill(df, up=["v"]).orderBy("row_seq"), "v")] == ["x", "y", "y", "y"]
    once = fill.fill(df, down=["v"])
    assert sorted(rows(fill.fill(once, down=["v"]), "row_seq", "v")) == sorted(rows(once, "row_seq", "v"))


def test_fill_precedes_the_cohort_filter(spark):
    df = spark.createDataFrame(
        [
            ("1", 1, None, None, "dlbcl"), ("1", 2, "medical_treatment", 1, None), ("1", 3, "survival_status", 1, None),
            ("x9", 4, None, None, "dlbcl"), ("2", 5, None, None, "fl"), ("2", 6, "medical_treatment", 1, None),
            ("3", 7, "medical_treatment", 1, "dlbcl"),
        ],
        "record_id string, row_seq int, redcap_repeat_instrument string, redcap_repeat_instance int, diagnosis string",
    )
    parts = fill.split_registry(df, F.col("diagnosis") == "dlbcl", down=["diagnosis"])
    assert [rows(parts[k], "record_id") for k in ("base", "thx", "sv")] == [[("1",)]] * 3


def test_latest_by_cycle(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, None, "c"), (2, None, "d")], "record_id int, cycle int, v string")
    assert sorted(rows(fill.latest_per_key(df), "record_id", "v")) == [(1, "b"), (2, "d")]


# --- lines --------------------------------------------------------------------------------------

LINE_SCHEMA = (
    "record_id double, treat_line int, cycle int, "
    + ", ".join(f"{b}_{d} date" for b in lines.LINE_DATES for d in DAYS)
    + ", therapy_start_date_imputed_day boolean, surv_stat string, note string"
)


def line_row(record, line, cycle, flag=None, surv=None, note=None, **dates):
    values = [dates.get(b) for b in lines.LINE_DATES for _ in DAYS]
    return (float(record), line, cycle, *values, flag, surv, note)


def make(spark, *r):
    return spark.createDataFrame(list(r), LINE_SCHEMA)


def test_collapse_and_flag_per_line(spark):
    df = make(
        spark,
        line_row(1, 1, 2, True, "alive", "b", therapy_start_date=D(2020, 2, 1), therapy_end_date=D(2020, 5, 1)),
        line_row(1, 1, 1, False, None, "a", therapy_start_date=D(2020, 1, 1), therapy_end_date=D(2020, 3, 1)),
        line_row(1, 2, 3, True, "alive", "c", therapy_start_date=D(2021, 1, 1)),
        line_row(2, None, 1, None, None, "d"),
    )
    got = {(r["record_id"], r["treat_line"]): r for r in lines.last_line(lines.collapse_lines(df)).collect()}
    first = got[(1.0, 1)]
    assert (first["therapy_start_date_15"], first["therapy_end_date_15"]) == (D(2020, 1, 1), D(2020, 5, 1))
    assert (first["therapy_start_date_imputed_day"], first["surv_stat"], first["note"], first["cycle"]) == (False, "alive", "a", 1)
    assert got[(1.0, 2)]["therapy_start_date_imputed_day"] is True  # each line keeps its own flag
    assert (first["is_last_line"], got[(1.0, 2)]["is_last_line"]) == (False, True)
    assert (got[(2.0, None)]["max_treat_line_num"], got[(2.0, None)]["is_last_line"]) == (None, False)


def survival_of(spark, *r):
    return {(x["record_id"], x["treat_line"]): x for x in lines.calc_pfs_os(make(spark, *r)).collect()}


def test_next_line_progression_prefers_progression_before(spark):
    got = survival_of(
        spark,
        line_row(1, 1, 1, therapy_start_date=D(2020, 1, 1)),
        line_row(1, 2, 2, therapy_start_date=D(2020, 7, 1), progression_before_date=D(2020, 6, 1), therapy_relapse_date=D(2020, 6, 9)),
        line_row(1, None, 3, progression_before_date=D(2022, 1, 1)),
    )
    assert got[(1.0, 1)]["progression_event_date_15"] == D(2020, 6, 1)
    assert got[(1.0, 1)]["PFS_event"] == 1 and got[(1.0, 1)]["progression_event_date_imputed_day"]
    assert got[(1.0, 2)]["progression_event_date_15"] is None  # the next row has no line number


def test_censoring_on_the_last_line(spark):
    start = D(2020, 1, 1)
    got = survival_of(
        spark,
        line_row(1, 1, 1, surv="alive", therapy_start_date=start, status_date=D(2020, 3, 1), diagnosis_date=D(2019, 12, 2)),
        line_row(2, 1, 1, surv="deceased", therapy_start_date=start, status_date=D(2020, 3, 1), progression_sv_last_date=D(2020, 2, 1)),
        line_row(3, 1, 1, surv="Lost2FU", therapy_start_date=start, status_date=D(2020, 3, 1), progression_sv_last_date=D(2019, 2, 1)),
        line_row(4, 1, 1, surv="other", therapy_start_date=start),
    )
    month = 365.25 / 12
    assert got[(1.0, 1)]["PFS_15_15"] == pytest.approx(60 / month) and got[(1.0, 1)]["PFS_event"] == 0
    assert got[(1.0, 1)]["OS_15_15"] == pytest.approx(90 / month) and got[(1.0, 1)]["OS_event"] == 0
    assert got[(2.0, 1)]["PFS_01_28"] == pytest.approx(31 / month) and got[(2.0, 1)]["PFS_event"] == 1
    assert got[(3.0, 1)]["PFS_15_15"] == pytest.approx(60 / month)  # last known date before the start is ignored
    assert (got[(4.0, 1)]["PFS_15_15"], got[(4.0, 1)]["PFS_event"], got[(4.0, 1)]["OS_event"]) == (None, None, None)


def test_text_dates_are_parsed(spark):
    df = spark.createDataFrame([("nk/3/2020", "2020-03-09")], "status_date_28 string, diagnosis_date_density_imp string")
    assert rows(lines.parse_line_dates(df), "*") == [(D(2020, 3, 28), D(2020, 3, 9))]


# --- groups -------------------------------------------------------------------------------------


def test_priority_and_best_response(spark):
    df = spark.createDataFrame(
        [(1, 1, "CNS", "PD"), (1, 2, None, "CR"), (1, 3, "Periphery", None), (2, 1, None, None), (3, 1, "x", "0"), (3, 2, None, "zz"), (4, 1, None, "Not done")],
        "g int, o int, t string, r string",
    )
    got = dict(rows(df.groupBy("g").agg(groups.priority_any("t", groups.SITES).alias("p")), "g", "p"))
    assert got == {1: "CNS", 2: None, 3: None, 4: None}
    best = dict(rows(groups.best_response(df, ["g"], "r", ["o"], "b"), "g", "b"))
    assert best == {1: "CR", 2: "", 3: "0, zz", 4: "Unknown"}


def test_extreme_flag_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 1, D(2020, 1, 1), True), (1, 2, D(2020, 1, 1), False), (2, 1, None, True)], "g int, o int, d date, f boolean")
    for which in ("min", "max"):
        got = dict(rows(df.groupBy("g").agg(groups.flag_at_extreme("d", "f", groups.order_struct("o"), which).alias("f")), "g", "f"))
        assert got == {1: True, 2: None}
    with pytest.raises(ValueError):
        groups.flag_at_extreme("d", "f", groups.order_struct("o"), "mid")
    last = df.groupBy("g").agg(groups.last_non_null("d", groups.order_struct("o")).alias("d"))
    assert dict(rows(last, "g", "d")) == {1: D(2020, 1, 1), 2: None}


def test_union_text_keeps_null_groups(spark):
    df = spark.createDataFrame([(1, None, "b, a"), (1, None, "a"), (2, 5, None)], "r int, l int, d string")
    got = groups.attach(df, ["r", "l"], groups.line_union_text(df, ["r", "l"], ["d"]))
    assert sorted(rows(got, "r", "d_line")) == [(1, "a, b"), (1, "a, b"), (2, "")]


def test_max_treat_line_null_is_zero(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, None), (2, None)], "record_id int, treat_line int")
    got = rows(groups.max_treat_line(df), "record_id", "treat_line", "max_treat_line")
    assert set(got) == {(1, 1, 0), (1, 2, 1), (1, None, 0), (2, None, 0)}


# --- scores and therapy -------------------------------------------------------------------------


def test_null_part_gives_null_score(spark):
    df = spark.createDataFrame(
        [(61, "3", "2", 5.0, 4.0, None, None, 0, 0, None, None, None), (61, None, "2", 5.0, 4.0, None, None, 0, 0, None, None, None)],
        "diagnosis_age int, diag_stage string, diag_ecog string, diag_ldh_diag double, diag_ldh_baseline double, diag_ldh_elevated_y_n string, "
        "diag_ldh_ratio double, diag_extranodal_site___adrenal int, diag_extranodal_site___kidney int, diag_extranodal_site_other string, "
        "diag_extranodal_site_other_2 string, diag_extranodal_site_other_3 string",
    )
    got = rows(scores.scores(scores.score_components(df)), "diag_ipi_n", "diag_ipi_score_standard", "diag_nccn_n")
    assert got == [(4, "High (4-5) score: 4", None), (None, None, None)]


def test_ldh_rules(spark):
    df = spark.createDataFrame(
        [(3.0, 4.0, None, None), (None, None, None, None), (None, 4.0, "unk", None), (None, None, "yes", None)],
        "diag_ldh_diag double, diag_ldh_baseline double, diag_ldh_elevated_y_n string, diag_ldh_ratio double",
    )
    assert [r[0] for r in rows(df, scores.ldh_point())] == [0, None, 0, 1]
    assert [r[0] for r in rows(df, scores.ldh_point("literal"))] == [1, 0, 1, 1]
    with pytest.raises(ValueError):
        scores.ldh_point("other")


def test_chop_and_rchop(spark):
    df = spark.createDataFrame([(1, "R-CHOP", "yes"), (1, "CHOP", "yes"), (2, None, "yes"), (2, "Rituximab", "no")], "treat_line int, drug_med_all_line string, treat_y_n string")
    got = rows(therapy.treatment_flags(df), "rchop_flag", "chop_flag", "therapy_subgroup", "therapy_category", "treatment_intention")
    assert got == [
        (True, False, "R-CHOP", "Frontline treatment", "-"),
        (False, True, "CHOP", "Frontline treatment", "-"),
        (False, False, "No treatment/BSC", "No treatment/BSC", "Palliative"),
        (False, False, "Rituximab only", "Antibody / low-intensity therapy", None),
    ]


# --- status -------------------------------------------------------------------------------------

SV = (
    "record_id string, cycle int, surv_stat string, surv_lost2fu_y_n int, last_contact_date date, last_contact_date_month int, last_contact_date_year int, "
    "surv_dod_date date, surv_dod_date_month int, surv_dod_date_year int, dod_ic_date date, dod_ic_date_month int, dod_ic_date_year int, "
    "progression_sv_last_date date, progression_sv_last_date_month int, progression_sv_last_date_year int"
)


def test_status(spark):
    df = spark.createDataFrame(
        [
            ("1", 1, "alive", 0, D(2020, 1, 1), None, None, *[None] * 9),
            ("1", 2, "deceased", 0, None, None, None, None, 5, 2021, None, None, None, None, None, None),
            ("2", 1, "alive", 1, None, 4, 2020, *[None] * 9),
            ("3", 1, "nd", None, D(2020, 2, 2), None, None, None, None, None, None, 6, 2021, None, None, None),
        ],
        SV,
    )
    got = {r["record_id"]: r for r in status.survival_status(df).collect()}
    assert (got[1.0]["surv_stat"], got[1.0]["status_date"], got[1.0]["status_date_28"]) == ("deceased", "nk/5/2021", D(2021, 5, 28))
    assert (got[2.0]["surv_stat"], got[2.0]["status_date_15"]) == ("Lost2FU", D(2020, 4, 15))
    assert (got[3.0]["surv_stat"], got[3.0]["progression_sv_last_date_15"], got[3.0]["progression_sv_last_from_death"]) == (
        "Lost2FU", D(2021, 6, 15), True,
    )


# --- imputation ---------------------------------------------------------------------------------

IMP = (
    "record_id int, treat_line int, cycle int, diagnosis_date date, diagnosis_date_month int, diagnosis_date_year int, "
    "therapy_start_date date, therapy_start_date_month int, therapy_start_date_year int, therapy_end_date date, therapy_end_date_month int, "
    "therapy_end_date_year int, drug1_end_reason string, drug_med_all string, diag_ldh_ratio double"
)


def known(i, lag, ratio=2.0, drug="R-CHOP"):
    d = D(2020, 1, 1)
    return (i, 1, 1, d, 1, 2020, d + dt.timedelta(lag), None, None, None, None, None, None, drug, ratio)


def test_lag_bounds_and_fallback(spark):
    df = spark.createDataFrame([known(i, lag) for i, lag in enumerate([0, 5, 9, 20, 365, 364])] + [known(99, 3, ratio=0.5)], IMP)
    base = impute.add_lag_columns(df)
    assert sorted(r[0] for r in rows(impute.lag_sample(base), "lag")) == [0, 3, 5, 9, 20, 364]
    with pytest.raises(ValueError):
        impute.lag_sample(base, ldh="low")
    with pytest.raises(ValueError):
        impute.lag_sample(base, rchop="exclude")
    fitted = impute.fit_density(impute.strata_counts(base))
    assert {r[0] for r in rows(fitted.select("stratum").distinct(), "stratum")} == {"all", "rchop_high"}  # one low row: overall is used
    mass = dict(rows(fitted.groupBy("stratum").agg(F.sum(F.col("y") * F.lit(365 / 2047)).alias("m")), "stratum", "m"))
    assert 0.3 < mass["all"] <= 1.01
    with pytest.raises(ValueError):
        impute.impute_dates_empirical(spark.createDataFrame([known(1, 3)], IMP), seed=1)


def test_imputed_days_are_feasible(spark):
    seen = [known(i, (i * 7) % 50) for i in range(60)]
    start = D(2020, 3, 10)
    missing = [
        (100, 1, 1, None, 3, 2020, start, None, None, None, None, None, None, "CHOP", None),
        (100, 2, 2, None, 3, 2020, D(2020, 9, 1), None, None, None, None, None, None, "CHOP", None),
        (101, 1, 1, D(2020, 3, 20), 3, 2020, None, 3, 2020, None, None, None, None, "CHOP", None),
        (102, 1, 1, D(2020, 4, 2), 4, 2020, None, 3, 2020, None, None, None, None, "CHOP", None),
        (103, 1, 1, None, 5, 2020, start, None, None, None, None, None, None, "CHOP", None),
        (104, 1, 1, None, 3, 2020, start, None, None, D(2020, 3, 1), None, None, None, "CHOP", None),
        (105, 1, 1, D(2020, 3, 1), 3, 2020, None, 3, 2020, D(2020, 7, 1), None, None, "Planned end", "R-CHOP", 2.0),
        (106, 1, 1, D(2020, 3, 1), 3, 2020, None, 3, 2020, D(2020, 8, 25), None, None, "Planned end", "R-CHOP", 2.0),
    ]
    df = spark.createDataFrame(seen + missing, IMP)
    out = impute.impute_dates_empirical(df, seed=5)
    got = {(r["record_id"], r["treat_line"]): r for r in out.collect()}
    d = got[(100, 1)]["diagnosis_date_density_imp"]
    assert D(2020, 3, 1) <= d <= start and got[(100, 1)]["delta_imp"] == (start - d).days
    assert got[(100, 2)]["diagnosis_date_density_imp"] == d and got[(100, 2)]["imp_status"] is None
    assert D(2020, 3, 20) <= got[(101, 1)]["therapy_start_date_density_imp"] <= D(2020, 3, 31)
    assert [got[(i, 1)]["imp_status"] for i in (102, 103, 104)] == ["no_feasible_day", "no_density_mass", "start_after_end"]
    assert 100 <= (D(2020, 7, 1) - got[(105, 1)]["therapy_start_date_density_imp"]).days <= 150
    assert D(2020, 3, 28) <= got[(106, 1)]["therapy_start_date_density_imp"] <= D(2020, 3, 31)
    again = impute.impute_dates_empirical(df.repartition(7), seed=5)
    key = ("record_id", "treat_line", "diagnosis_date_density_imp", "therapy_start_date_density_imp")
    assert sorted(map(str, rows(again, *key))) == sorted(map(str, rows(out, *key)))
    with pytest.raises(ValueError):
        impute.impute_dates_empirical(df, seed=5, strict=True)


# --- quality and summary ------------------------------------------------------------------------


def test_resort_leaves_patients_with_missing_lines(spark):
    df = spark.createDataFrame([(1, 1, 2, 1), (1, 2, 1, 2), (2, 3, 1, 1), (2, 4, 2, 2), (3, 5, 2, 1), (3, 6, None, 2)], "record_id int, row_seq int, treat_line int, cycle int")
    got = rows(quality.resort_unsorted(df).orderBy("row_seq"), "resorted", "sort_seq")
    assert got == [(True, 2), (True, 1), (False, 1), (False, 2), (False, 1), (False, 2)]
    hot = rows(quality.resort_unsorted(df, floor=1).orderBy("row_seq"), "resorted", "sort_seq")
    assert hot == got


def test_quantiles_match_the_definition(spark):
    import numpy as np

    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0), ("b", None), ("b", float("nan"))], "g string, v double")
    for kw in ({}, {"floor": 2}):
        got = {r["g"]: r for r in summary.exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.75], **kw).collect()}
        assert [got["a"][f"q{i}"] for i in (1, 2, 3)] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.75])))
        assert got["b"]["q2"] == 7.0
