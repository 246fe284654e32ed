import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardline.functions import dates as D
from hazardline.functions import dictionary as dic
from hazardline.functions import text as X
from hazardline.operators import contracts as ct
from hazardline.plans import bands


def one(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.fixture(scope="module")
def partial(spark):
    rows = [
        (1, None, 3, 2020, True),
        (2, dt.date(2020, 3, 9), None, None, True),
        (3, None, 3, None, True),
        (4, dt.date(2020, 3, 9), 3, 2020, False),
        (5, dt.date(2020, 3, 9), 3, 2020, None),
        (6, None, 13, 2020, True),
    ]
    return spark.createDataFrame(rows, "id int, x date, x_month int, x_year int, ok boolean").orderBy("id")


def test_partial_text(partial):
    got = one(partial, D.partial_date_text("x", "x_month", "x_year"))
    assert [g[0] for g in got] == ["nk/3/2020", "09/03/2020", None, "09/03/2020", "09/03/2020", "nk/13/2020"]


def test_impute_dates(partial):
    out = one(D.impute_dates(partial, {"x": F.col("ok")}).orderBy("id"), "x", "x_imputed_day", "x_01", "x_15", "x_28")
    assert out[0] == ("nk/3/2020", True, dt.date(2020, 3, 1), dt.date(2020, 3, 15), dt.date(2020, 3, 28))
    day = dt.date(2020, 3, 9)
    assert out[1] == ("09/03/2020", False, day, day, day)
    assert out[2] == out[3] == out[4] == (None,) * 5
    assert out[5] == ("nk/13/2020", True, None, None, None)
    whole = one(D.impute_dates(partial, ["x"]).orderBy("id"), "x_15")
    assert whole[3] == (day,)
    with pytest.raises(TypeError):
        D.impute_dates(partial, {"x": "ok"})


def test_raw_date_then_day(partial):
    raw = D.impute_missing_day(D.raw_date(partial, "x", "x_month", "x_year", F.col("ok")), "x_raw")
    got = one(raw.orderBy("id"), "x_raw", "x_raw_imputed_15")
    assert got[0] == ("nk/3/2020", dt.date(2020, 3, 15))
    assert got[1] == ("2020-03-09", None)
    assert got[3] == (None, None)


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2020-03-09", dt.date(2020, 3, 9)),
        ("9-3-2020", dt.date(2020, 3, 9)),
        (" 09.03.2020 ", dt.date(2020, 3, 9)),
        ("2020/3/9", dt.date(2020, 3, 9)),
        ("12-03-2020", dt.date(2020, 3, 12)),  # strict: never the year 12
        ("nk/3/2020", None),
        ("N/A", None),
        ("soon", None),
    ],
)
def test_parse_partial(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert one(df, D.parse_partial_date("x"))[0][0] == expected


def test_parse_imputed_and_serial(spark):
    df = spark.createDataFrame([("nk/3/2020", "44561"), ("2020-03-09", "31.12.2021"), ("09/03/2020", "4456")], "a string, b string")
    assert one(df, D.parse_imputed_date("a", "28"), D.mixed_serial_date("b")) == [
        (dt.date(2020, 3, 28), dt.date(2021, 12, 31)),
        (dt.date(2020, 3, 9), dt.date(2021, 12, 31)),
        (dt.date(2020, 3, 9), None),
    ]
    with pytest.raises(ValueError):
        D.parse_imputed_date("a", "02")


def test_elapsed(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1), dt.date(2020, 1, 1))], "a date, b date")
    (months, years, days) = one(df, *[D.time_between("a", "b", u) for u in ("months", "years", "days")])[0]
    assert months == pytest.approx(12.024641, abs=1e-6)
    assert (years, days) == (pytest.approx(366 / 365.25), 366)
    with pytest.raises(ValueError):
        D.time_between("a", "b", "weeks")
    stamps = spark.createDataFrame([(dt.datetime(2020, 1, 2, 12), dt.datetime(2020, 1, 1))], "a timestamp, b timestamp")
    assert one(stamps, D.time_between_instants("a", "b", "days"))[0][0] == 1.5
    with pytest.raises(ValueError):
        D.time_between_instants("a", "b", "weeks")


def test_scale():
    assert D.time_scale(None) == D.time_scale("") == D.time_scale("none") == D.time_scale("m_m") == 1
    assert D.time_scale("d_m") == pytest.approx(12 / 365.25)
    assert D.time_scale("M_Y") == pytest.approx(1 / 12)
    for bad in ("m", "m_w", "months_years"):
        with pytest.raises(ValueError):
            D.time_scale(bad)
    assert D.base_name("status_date_15") == "status_date" and D.base_name("status_date") == "status_date"


def test_month_rules(spark):
    df = spark.createDataFrame([(2020, 2, dt.date(2020, 2, 29))], "y int, m int, d date")
    n, inside, end, order = one(
        df,
        F.size(D.month_days(F.col("y"), F.col("m"))),
        D.in_month_year(F.col("d"), F.lit(None).cast("int"), F.col("y")),
        D.effective_end(F.lit(None).cast("date"), F.col("m"), F.col("y")),
        D.dates_in_order(F.col("d"), F.lit(None).cast("date"), F.col("d")),
    )[0]
    assert (n, inside, end, order) == (29, False, dt.date(2020, 2, 1), True)


def test_text(spark):
    df = spark.createDataFrame([("b, a,b", "1,5", "999", "x", "Cladribin and Interferon alpha, lenalidomid")], "l string, n string, s string, j string, d string")
    got = one(
        df,
        X.sort_unique_values("l"),
        X.capitalize_words("l"),
        X.to_numeric("n"),
        X.drop_sentinel(X.to_numeric("s")),
        X.to_numeric("j"),
        X.fix_spelling("d"),
    )[0]
    assert got == ("a, b", "B, A, B", 1.5, None, None, "Cladribine and Interferone-alpha, Lenalidomide")


def test_small_text(spark):
    df = spark.createDataFrame([(None, "")], "a string, b string")
    got = one(df, X.unite(["a", "a"]), X.empty_to_null("b"), X.sort_unique_values("b"), X.other_with_text(F.lit("Other"), "a"))[0]
    assert got == ("", None, "", "Other")
    assert one(df, X.drop_parenthesis(F.lit("Drug  (x) (y)")), X.replace_first(F.lit("other, other, z"), "other, ", "other - "))[0] == (
        "Drug", "other - other, z",
    )
    texts = one(
        df,
        X.estimate_text(F.lit(1.125), F.lit(1.0), F.lit(2.5)),
        X.estimate_text(F.lit(None).cast("double"), F.lit(1.0), F.lit(2.0)),
        X.estimate_text(F.lit(1.5), F.lit(None).cast("double"), F.lit(2.0)),
    )[0]
    assert texts == ("1.12 (1.0–2.5)", "not reached", "1.5")


def test_dictionary(spark, monkeypatch):
    dd = spark.createDataFrame(
        [("q", "<b>Quest</b>", "1, Yes | 2, No, never"), ("q", "later", "1, Ja"), ("e", "none", None)],
        f"{dic.FIELD} string, {dic.LABEL} string, {dic.CHOICES} string",
    ).withColumn("row", F.monotonically_increasing_id())
    df = spark.createDataFrame([(1, "1"), (2, "2"), (3, "nd"), (4, "7"), (5, None)], "i int, q string")
    got = one(dic.decode(df, dd, "q", order="row").orderBy("i"), "q")
    assert [g[0] for g in got] == ["Yes", "No, never", "Not done", None, None]
    monkeypatch.setattr(dic, "MAP_CODES", 1)  # the joined form
    assert one(dic.decode(df, dd, "q", order="row").orderBy("i"), "q") == got
    with pytest.raises(ValueError):
        dic.decode(df.withColumn("e", F.lit("1")), dd, "e")
    labelled = dic.add_labels(df, dd.where(F.col(dic.LABEL) != "later"))
    assert dic.var_label(labelled, "q") == "Quest" and dic.var_label(labelled, "i") is None


def test_contracts(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert ct.assert_schema(df, ["b", "a"]).columns == ["b", "a"]
    for names in (["a"], ["a", "b", "c"], ["a", "b", "b"]):
        with pytest.raises(ValueError):
            ct.assert_schema(df, names)
    with pytest.raises(ValueError):
        ct.require_columns(df, ["z"])
    with pytest.raises(ValueError):
        ct.require_tables({"base": df, "dd": None}, ["base", "dd"])
    assert ct.clean_names(df.toDF("A b-c", "Ü(x)")).columns == ["a_bc", "üx"]
    assert ct.column_range(df.withColumn("c", F.lit(1)), "b", "c") == ["b", "c"]
    assert ct.select_names(df.withColumn("drug_a_end", F.lit(1)), starts_with="drug", without=["end"]) == []
    assert ct.select_names(df, matches="^a$") == ["a"] and ct.select_names(df, contains="b") == ["b"]
    ids = spark.createDataFrame([("12",), ("x1",)], "record_id string")
    assert one(ct.keep_numeric_ids(ids), "record_id_num") == [(12.0,)]


def test_bands(spark):
    df = spark.createDataFrame([(24.95, 2), (18.5, 3), (30.0, 7)], "bmi double, n int")
    assert [r[0] for r in one(df, bands.bmi_band("bmi"))] == [None, "18.5-24.9", ">=30"]
    assert [r[0] for r in one(df, bands.bmi_band("bmi", contiguous=True))] == ["18.5-24.9", "18.5-24.9", ">=30"]
    assert [r[0] for r in one(df, bands.site_band("n"))] == ["1", "2-3", None]
    assert [r[0] for r in one(df, bands.site_band("n", two_in_first=False))] == ["2-3", "2-3", None]


def test_sheet(spark):
    row = {
        "Alive": 0, "Lost to FU": 0, "Sarcopenia": 1, "De novo": 0, "DFI": 1, "Visceral disease": 1, "BMI": 22.0, "Ki-67": 20.0,
        "Number of metastatic sites": 5, "1st line HR+": 1, "Menopausal status": 2, "mBC diagnosis": "44561",
        "date of PD": None, bands.END_DATE: dt.date(2022, 12, 31),
    }
    schema = ", ".join(
        f"`{k}` " + ("double" if isinstance(v, float) else "string" if isinstance(v, str) else "date" if k in ("date of PD", bands.END_DATE) else "int")
        for k, v in row.items()
    )
    df = spark.createDataFrame([tuple(row.values())], schema)
    got = bands.prepare_sheet(df).first()
    assert (got["OS_event"], got["PFS_event"], got["PFS_time"], got["Arm"]) == (1, 0, None, "Yes")
    assert got["firstline_hr"] == "ET + CDK4/6i" and got["DFI & De Novo"] == "DFI >24 months" and got["num_met_sites"] == ">3"
    assert got["OS_time"] == pytest.approx(365 / (365.25 / 12))
    assert bands.prepare_sheet(df, censor_at_end=True).first()["PFS_time"] == pytest.approx(got["OS_time"])
