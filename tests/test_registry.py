import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from hazardline.plans import cleaning
from hazardline.sources import exports, registry

D = dt.date
DATES = [
    "therapy_start_date", "therapy_end_date", "therapy_relapse_date", "progression_before_date", "progression_date",
    "treat_best_response_date", "treat_best_response_petct_date", "treat_trans_date",
]
DRUGS = [f"drug_med{k}{i}" for k in ("chemo", "immune", "target", "other") for i in ("1", "2", "3", "_other")]


def test_guess_and_override(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_text('record_id,redcap_repeat_instance,albumin,day,name,none\n1,,"3,5",2020-01-02,"a, b",\n1,2,999,2020-02-03,,\nx2,1,n/a,,c,\n')
    out = registry.read_registry(spark, str(path))
    assert dict(out.dtypes) == {
        "record_id": "string", "redcap_repeat_instance": "int", "albumin": "string", "day": "date", "name": "string", "none": "string", "row_seq": "bigint",
    }
    assert [r["name"] for r in out.orderBy("row_seq").collect()] == ["a, b", None, "c"]
    fixed = registry.text_override(out.drop("row_seq").schema)
    again = registry.read_registry(spark, str(path), schema=fixed)
    assert again.drop("row_seq").collect() == out.drop("row_seq").collect()


@pytest.mark.parametrize("sep", [";", ","])
def test_dictionary_delimiter(spark, tmp_path, sep):
    path = tmp_path / "dd.csv"
    quoted = '"1, Yes | 2, No; never"'
    path.write_text(sep.join(["Variable / Field Name", '"Choices, Calculations, OR Slider Labels"']) + "\n" + sep.join(["q", quoted]) + "\n")
    dd = registry.read_dictionary(spark, str(path))
    assert dd.columns == ["field_name", "choices_calculations_or_slider_labels"]
    assert dd.first()[1] == "1, Yes | 2, No; never"


def test_latest_file(spark, tmp_path):
    for d in ("2024-12-01", "2025-07-29", "2025-01-31"):
        (tmp_path / f"DataDictionary_{d}.csv").write_text("a\n")
    assert registry.latest_file(spark, str(tmp_path / "DataDictionary_*.csv")).endswith("DataDictionary_2025-07-29.csv")
    (tmp_path / "other_x.csv").write_text("a\n")
    with pytest.raises(FileNotFoundError):
        registry.latest_file(spark, str(tmp_path / "other_*.csv"))


def test_save_and_read_latest(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.5, "a;b"), (2, None, None)], "id int, x double, t string")
    day = D(2025, 1, 2)
    paths = exports.save_cleaned(df, "lines", str(tmp_path), csv2=True, day=day)
    assert re.search(r"/lines_2025-01-02_[0-9a-f]{12}_data\.parquet$", paths["parquet"]) and paths["csv"].endswith("lines_2025-01-02_data.csv")
    text = [r[0] for r in spark.read.text(paths["csv"]).collect()]
    assert "id;x;t" in text and any(t.startswith("1;1,5;") for t in text)
    assert exports.read_latest(spark, str(tmp_path))["lines"].orderBy("id").collect() == df.collect()
    exports.save_cleaned(df.limit(1), "lines", str(tmp_path), day=day)
    assert exports.read_latest(spark, str(tmp_path))["lines"].count() == 1
    with pytest.warns(UserWarning):
        assert exports.read_latest(spark, str(tmp_path / "none")) == {}
    assert exports.results_path("km", day=day) == "results/2025-01-02_km"


def test_sheet_and_pseudonyms(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("Ki-67,SMI (cm2/m2)\n20,41.5\n,\n")
    sheet = registry.read_sheet(spark, str(path))
    assert dict(sheet.dtypes) == {"Ki-67": "int", "SMI (cm2/m2)": "double"}
    assert dict(registry.read_sheet(spark, str(path), types={"Ki-67": "double"}).dtypes)["Ki-67"] == "double"
    ids = spark.createDataFrame([(1,), (1,), (2,)], "record_id int")
    mapped = registry.id_mapping(registry.pseudonymise(ids, "salt")).collect()
    assert len(mapped) == 2 and all(len(r["record_id_new"]) == 12 for r in mapped)
    with pytest.raises(ValueError):
        registry.id_mapping(ids.withColumn("record_id_new", F.lit("same")))


# --- end to end ---------------------------------------------------------------------------------


def patient(i, diagnosis, **kw):
    base = {
        "record_id": str(i), "datum_geb": D(1950, 5, 1), "diagnosis": "dlbcl", "diagnosis_other": None, "diag_stage": "3", "diag_ecog": "1",
        "diag_stage_pet": "y", "diagnosis_subtype_coo": "abc", "diagnosis_subtype": "2", "diagnosis_subtype_other": "rare",
        "diagnosis_transformation_before": None, "diag_ldh_diag": 300.0, "diag_ldh_baseline": 250.0, "diag_ldh_ratio": 1.2,
        "diag_ldh_elevated_y_n": None, "diag_extranodal_site___adrenal": 0, "diag_extranodal_site___kidney": 1, "diag_extranodal_site___cns": 1,
        "diag_extranodal_site_other": "skin", "diag_extranodal_site_other_2": None, "diag_extranodal_site_other_3": None,
        "diagnosis_date": diagnosis, "diagnosis_date_month": 1, "diagnosis_date_year": 2020,
        "diagnosis_transformation_date": None, "diagnosis_transformation_date_month": None, "diagnosis_transformation_date_year": None,
    }
    return {**base, **kw}


def record(i, cycle, line, start, **kw):
    base = {"record_id": str(i), "cycle": cycle, "treat_y_n": 1, "treat_line": str(line), "treat_study": 0, "treat_line_ecog": "1"}
    for d in DATES:
        base |= {d: None, f"{d}_month": None, f"{d}_year": None}
    base |= {"therapy_start_date": start, "therapy_start_date_month": start.month if start else None, "therapy_start_date_year": 2020 if start else None}
    base |= {d: None for d in DRUGS}
    base |= {
        "therapy_relapse_y_n": "no", "treat_rebiopsy": "n", "treat_best_response": "3", "treat_best_response_petct": "ja",
        "progression_before_type___cns": 0, "progression_before_type___periphery": 0, "progression_type___cns": 0, "progression_type___periphery": 0,
        "drug_med_comb": None, "drug_car_type": None, "treat_trans_type": None, "drug_intrathecal_check___1": 0, "drug_med_check_radio___1": 0,
        "drug_best_supportive_check___1": 0, "drug1_start_reason": "1", "drug1_end_reason": "1", "therapy_status": "1", "treat_no_reason": None,
        "treat_no_reason_other": None,
    }
    return {**base, **kw}


def frame(spark, rows, strings=()):
    kinds = {}
    for c in rows[0]:
        sample = next((r[c] for r in rows if r[c] is not None), None)
        if c.endswith(("_month", "_year")) or isinstance(sample, int):
            kinds[c] = "int"
        elif isinstance(sample, float):
            kinds[c] = "double"
        elif isinstance(sample, D) or c.endswith("_date"):
            kinds[c] = "date"
        else:
            kinds[c] = "string"
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} {t}" for c, t in kinds.items()))


@pytest.fixture(scope="module")
def result(spark):
    starts = {i: D(2020, 1, 10) + dt.timedelta(i * 2) for i in range(1, 9)}
    base = [patient(i, D(2020, 1, 5)) for i in range(1, 8)] + [patient(8, None, diag_stage="nd")]
    thx = [record(i, 1, 1, starts[i], drug_med_comb="r-chop", drug_medchemo1="1") for i in range(1, 9)]
    thx += [
        record(1, 2, 1, D(2020, 3, 1), drug_med_comb="r-chop", drug_medimmune_other="rituximab", treat_best_response="4"),
        record(1, 3, 2, D(2020, 9, 1), drug_med_comb="R-GDP", progression_before_date=D(2020, 8, 20), progression_before_type___cns=1),
        record(2, 2, 2, None, treat_y_n=0, therapy_start_date_month=9, therapy_start_date_year=2020, drug_best_supportive_check___1=1),
    ]
    sv = [
        {
            "record_id": str(i), "cycle": c, "surv_stat": s, "surv_lost2fu_y_n": 0, "last_contact_date": D(2021, c, 1), "last_contact_date_month": None,
            "last_contact_date_year": None, "surv_dod_date": D(2021, 6, 1) if s == "deceased" else None, "surv_dod_date_month": None, "surv_dod_date_year": None,
            "dod_ic_date": None, "dod_ic_date_month": None, "dod_ic_date_year": None, "progression_sv_last_date": None,
            "progression_sv_last_date_month": None, "progression_sv_last_date_year": None,
        }
        for i, c, s in [(1, 1, "alive"), (1, 2, "deceased"), (2, 1, "alive"), (3, 1, "alive"), (8, 1, "unknown")]
    ]
    fields = {
        "diagnosis": "dlbcl, DLBCL", "diag_ecog": "0, Grade 0 | 1, Grade 1", "diag_stage": "1, I | 2, II | 3, III | 4, IV", "diagnosis_subtype": "1, NOS | 2, Other",
        "diagnosis_transformation_before": "1, FL", "drug1_start_reason": "1, First diagnosis", "drug1_end_reason": "1, Planned end", "therapy_status": "1, Ended",
        "treat_rebiopsy": "y, yes | n, no", **{d: "1, Cyclophosphamide (x)" for d in DRUGS if not d.endswith("_other")},
    }
    dd = spark.createDataFrame([(k, k, v) for k, v in fields.items()], "field_name string, field_label string, choices_calculations_or_slider_labels string")
    return cleaning.run_registry({"base": frame(spark, base), "thx": frame(spark, thx), "sv": frame(spark, sv), "dd": dd}, seed=3)


def test_patients(result):
    got = {r["record_id"]: r for r in result["diag"].collect()}
    p = got[1.0]
    assert (p["diagnosis_age"], p["yob"], p["diagnosis_subtype"], p["diag_stage"], p["diagnosis_subtype_coo"]) == (70, 1950, "Other - rare", "III", "nonGCB")
    assert p["diag_site"] == "Kidney, Central nervous system, Other1 - skin"
    assert (p["diag_ipi_n"], p["diag_ipi_score_cns"]) == (4, "High (4-6) score: 5")
    assert got[8.0]["diag_ipi_n"] is None and got[8.0]["diagnosis_date"] == "nk/1/2020"


def test_line_table(result):
    got = {(r["record_id"], r["treat_line"]): r for r in result["tot"].collect()}
    assert len(got) == 10
    first, second = got[(1.0, 1)], got[(1.0, 2)]
    assert first["drug_med_all_line"] == "Cyclophosphamide (x), R-CHOP, Rituximab"
    assert (first["treat_best_response_line"], first["treat_best_response"]) == ("CR", "PD")
    assert first["progression_event_date_15"] == D(2020, 8, 20) and first["PFS_event"] == 1
    assert second["progression_before_type_line"] == "CNS" and second["therapy_subgroup"] == "GDP/R-GDP"
    assert second["PFS_event"] == 1 and second["OS_event"] == 1 and second["max_treat_line"] == 1 and first["max_treat_line"] == 0
    assert first["therapy_subgroup"] == "R-CHOP" and first["rchop_flag"]
    assert got[(2.0, 2)]["therapy_start_date_15"] is None and got[(2.0, 2)]["therapy_group"] == "No treatment/BSC"
    assert got[(8.0, 1)]["diagnosis_date_density_imp"] <= D(2020, 1, 26) and got[(8.0, 1)]["imp_status"] == "imputed"
    assert got[(8.0, 1)]["surv_stat"] == "Lost2FU" and got[(8.0, 1)]["OS_density"] is not None


def test_patient_table_and_contract(result):
    assert sorted(r["record_id"] for r in result["pat"].collect()) == [float(i) for i in range(1, 9)]
    with pytest.raises(ValueError):
        cleaning.run_registry({"base": None, "thx": None, "sv": None, "dd": None}, seed=1)


def test_second_cohort_join(spark, result):
    final = result["tot"].select("record_id", "drug1_start_reason", "cycle", "yob")
    line = result["tot"].select("record_id", "treat_line")
    out = cleaning.second_cohort_lines(final, line, ["yob"], F.col("record_id").cast("int").cast("string").rlike("^1"))
    assert sorted(tuple(r) for r in out.select("record_id", "treat_line").collect()) == [(1.0, 1), (1.0, 2)]


def test_late_odd_values_and_line_breaks(spark, tmp_path):
    rows = [f'{k},00{k},{k}' for k in range(12_000)] + ['3000000001,x,1.5', '5,"two\nlines",2']
    (tmp_path / "r.csv").write_text("id,code,value\n" + "\n".join(rows) + "\n")
    out = registry.read_registry(spark, str(tmp_path / "r.csv"))
    assert dict(out.dtypes) == {"id": "bigint", "code": "string", "value": "double", "row_seq": "bigint"}
    assert out.count() == 12_002 and out.where("id is null or code is null or value is null").isEmpty()
    assert out.where("id = 3000000001").first()["value"] == 1.5 and out.where("code = 'two\nlines'").count() == 1


def test_first_row_of_a_repeated_field(spark, tmp_path):
    from hazardline.functions import dictionary

    (tmp_path / "d.csv").write_text('field_name,choices_calculations_or_slider_labels\nf,"1, Zeta"\nf,"1, Alpha"\n')
    codes = dictionary.dictionary_codes(registry.read_dictionary(spark, str(tmp_path / "d.csv"), sequence="row_seq"))
    assert [r["label"] for r in codes.where("code = '1'").collect()] == ["Zeta"]


def test_order_over_files_of_uneven_size(spark, tmp_path):
    sizes = {"a": 2, "b": 400, "c": 5, "d": 90}
    for name, n in sizes.items():
        (tmp_path / f"{name}.csv").write_text("id,v\n" + "".join(f'{name}{k},"x\ny"\n' for k in range(n)))
        (tmp_path / f"{name}.json").write_text("".join(f'{{"id": "{name}{k}"}}\n' for k in range(n)))
    want = [f"{name}{k}" for name, n in sizes.items() for k in range(n)]
    for fmt in ("csv", "json"):
        out = registry.read_registry(spark, f"{tmp_path}/*.{fmt}", fmt=fmt)
        assert [(r["row_seq"], r["id"]) for r in out.orderBy("row_seq").collect()] == list(enumerate(want))
    spark.range(1000).repartition(7).write.parquet(f"{tmp_path}/p")
    out = registry.read_registry(spark, f"{tmp_path}/p", fmt="parquet")
    assert sorted(r["row_seq"] for r in out.collect()) == list(range(1000))
    assert "row_seq" not in registry.read_registry(spark, f"{tmp_path}/a.csv", sequence=None).columns


def test_order_over_blocks_of_one_file(spark, tmp_path):
    (tmp_path / "x.json").write_text("".join(f'{{"id": {k}}}\n' for k in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        out = registry.read_registry(spark, f"{tmp_path}/x.json", fmt="json")
        assert out.rdd.getNumPartitions() > 4
        assert out.where("id <> row_seq").isEmpty() and out.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_file_of_plain_lines_is_read_in_blocks(spark, tmp_path):
    """Quoted separators and quotes, empty values; every row once and in order. One block a file before."""
    lines = [f'{i},"a ""{i}"", b",,"x",""' for i in range(3000)]
    (tmp_path / "x.csv").write_text("id,t,e,q,n\n" + "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        out = registry.read_registry(spark, f"{tmp_path}/x.csv")
        got = sorted(map(tuple, out.select("row_seq", "id", "t", "e", "q", "n").collect()))
        assert out.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, i, f'a "{i}", b', None, "x", None) for i in range(3000)]


@pytest.mark.parametrize("text, records", [
    ("a,b\n1,2\n", True), ('a,b\n"1","x, y"\n"""",""', True), ('a,b\n1,"x\ny"\n', False), ('a,b\n1,5" x\n', False), ('a,b\n"a",x"y,"open\nend",z"w\n', False),
    ("a,b\r\n1,2\r\n", False), ("a,b\n\n1,2\n", False), ("a,b\n \t\n1,2\n", False), ('a,b\n1, "x"\n', False), ('a,b\n1,"x"y\n', False),
])
def test_lines_that_are_records(spark, tmp_path, text, records):
    (tmp_path / "x.csv").write_bytes(text.encode())
    assert registry.lines_are_records(spark, f"{tmp_path}/x.csv") is records


def test_a_date_that_is_none_is_text(spark, tmp_path):
    (tmp_path / "d.csv").write_text("a,b\n2021-02-28,2021-02-28\n2021-02-30,2021-03-01\n")
    out = registry.read_registry(spark, str(tmp_path / "d.csv"))
    assert dict(out.dtypes)["a"] == "string" and dict(out.dtypes)["b"] == "date" and out.count() == 2


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit_are_errors(spark, tmp_path, ansi):
    (tmp_path / "v.csv").write_text("n,day\n1,2020-01-01\nx,2020-01-02\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        schema = registry.T.StructType.fromDDL("n int, day date")
        with pytest.raises(Exception, match="column n: not of type int: x"):
            registry.read_registry(spark, str(tmp_path / "v.csv"), schema=schema).collect()
        with pytest.raises(Exception, match="column n: not of type int: x"):
            registry.read_sheet(spark, str(tmp_path / "v.csv"), types={"n": "int"}).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_failed_run_leaves_the_latest_copy(spark, tmp_path):
    first = spark.range(10).withColumn("v", F.lit("one"))
    exports.save_cleaned(first, "t", str(tmp_path))
    reading = exports.read_latest(spark, str(tmp_path))["t"]
    broken = spark.range(10).withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("stop"))).otherwise("two"))
    with pytest.raises(Exception, match="stop"):
        exports.save_cleaned(broken, "t", str(tmp_path))
    assert exports.read_latest(spark, str(tmp_path))["t"].where("v = 'one'").count() == 10
    exports.save_cleaned(spark.range(3).withColumn("v", F.lit("three")), "t", str(tmp_path))
    exports.save_cleaned(spark.range(4).withColumn("v", F.lit("u")), "u", str(tmp_path))
    assert reading.where("v = 'one'").count() == 10  # who reads the earlier copy keeps it
    now = exports.read_latest(spark, str(tmp_path))
    assert now["t"].where("v = 'three'").count() == 3 and set(now) == {"t", "u"}
