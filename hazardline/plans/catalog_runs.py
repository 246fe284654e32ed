"""Catalogue of composed runs: reading files, the cleaning and survival runs, the second cohort, the analysis sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.functions import dictionary as dic
from hazardline.operators import cox as C
from hazardline.operators import impute, lines, scores, therapy
from hazardline.operators import kaplan_meier as K
from hazardline.plans import bands, cleaning, views
from hazardline.plans.catalog_survival import _r, _z, cox_sql, km_sql, median_sql
from hazardline.plans.views import table
from hazardline.session import shared_folder
from hazardline.sources import exports, registry

Q: dict[str, tuple] = {}


def query(sql: str | None):
    def add(fn):
        Q[fn.__name__] = (fn, sql)
        return fn

    return add


def _choice(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _sql_choice(values: list, index: str) -> str:
    listed = ", ".join("NULL" if v is None else repr(v) for v in values)
    return f"list_extract([{listed}], CAST({index} AS INTEGER) + 1)"


# --- files --------------------------------------------------------------------------------------


@query("""
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_seq, CAST(o_orderkey AS INTEGER) AS id, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price,
  CASE WHEN o_orderkey % 11 = 0 THEN '2021-02-30' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS no_day, '00' || o_custkey AS code,
  o_orderpriority AS text, 'int,date,double,string,string,string' AS types FROM orders
""")
def read_registry_types(spark, folder):
    """An export in several files of uneven sizes: types that fit all rows, and the rows in source order."""
    o = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    rows = o.select(
        key.alias("id"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").alias("price"),
        F.when(key % 11 == 0, "2021-02-30").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("no_day"),
        F.concat(F.lit("00"), F.col("o_custkey")).alias("code"), F.col("o_orderpriority").alias("text"),
    )
    where = f"{shared_folder(spark, 'export')}/export"
    # each file holds about twice the one before, up to a million rows
    sized = rows.withColumns({"_size": F.floor(F.log2(F.col("id") + 1)), "_slice": F.floor(F.col("id") / 2**20)})
    files = sized.repartitionByRange(6 + rows.count() // 2**20, "_size", "_slice")
    files.sortWithinPartitions("id").drop("_size", "_slice").write.option("header", True).option("escape", '"').csv(where)
    out = registry.read_registry(spark, where)
    types = ",".join(t for c, t in out.dtypes if c != "row_seq")
    return out.withColumn("types", F.lit(types)).withColumn("row_seq", F.col("row_seq").cast("long"))


@query("""
SELECT 'nation_' || n_nationkey AS field, 'Nation of ' || r_name AS label, CAST(n_nationkey AS VARCHAR) AS code, n_name AS decoded
FROM nation JOIN region ON r_regionkey = n_regionkey
""")
def dictionary_labels(spark, folder):
    """A data dictionary read from its file, its labels put on the columns of a table, and its codes."""
    n = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    rows = n.select(
        F.concat(F.lit("nation_"), "n_nationkey").alias("Variable / Field Name"), F.concat(F.lit("<b>Nation of</b> "), "r_name").alias("Field Label"),
        F.concat_ws(", ", F.col("n_nationkey").cast("string"), "n_name").alias("Choices, Calculations, OR Slider Labels"),
    )
    where = f"{shared_folder(spark, 'dictionary')}/dictionary"
    rows.coalesce(1).write.options(header=True, sep=";", escape='"', quoteAll=True).csv(where)
    dd = registry.read_dictionary(spark, where, sequence="row_seq")
    fields = [f"nation_{k}" for k in range(dd.count())]
    wide = dic.add_labels(table(spark, folder, "customer").select(*[F.lit(None).cast("string").alias(f) for f in fields]), dd)
    labels = spark.createDataFrame([(f, dic.var_label(wide, f)) for f in fields], "field string, label string")
    codes = dic.dictionary_codes(dd).where("code <> 'nd'")
    return labels.join(codes.select(F.col(dic.FIELD).alias("field"), "code", F.col("label").alias("decoded")), "field")


# --- cleaning runs ------------------------------------------------------------------------------

_COO = ["gcb", "abc", "nongcb", "other", None]
_PET = ["n", "y", "unk", "nd"]
_SUBTYPE_TEXT = "a rare one"


def _patients(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    day = F.date_add(F.lit("2010-01-01").cast("date"), (k % 3000).cast("int"))
    no = F.lit(None)
    return table(spark, folder, "customer").select(
        k.cast("string").alias("record_id"), F.date_add(F.lit("1930-01-01").cast("date"), (k % 20_000).cast("int")).alias("datum_geb"),
        F.lit("dlbcl").alias("diagnosis"), no.cast("string").alias("diagnosis_other"), _choice(["1", "2", "3", "4", "nd"], k % 5).alias("diag_stage"),
        _choice(["0", "1", "2", "3", "4", "nd"], k % 6).alias("diag_ecog"), _choice(_PET, k % 4).alias("diag_stage_pet"),
        _choice(_COO, k % 5).alias("diagnosis_subtype_coo"), _choice(["1", "2"], k % 2).alias("diagnosis_subtype"),
        F.when(k % 4 == 1, _SUBTYPE_TEXT).alias("diagnosis_subtype_other"), no.cast("string").alias("diagnosis_transformation_before"),
        (k % 400).cast("double").alias("diag_ldh_diag"), F.lit(250.0).alias("diag_ldh_baseline"), ((k % 40) / 10).alias("diag_ldh_ratio"),
        no.cast("string").alias("diag_ldh_elevated_y_n"), (k % 2).cast("int").alias("diag_extranodal_site___adrenal"),
        (k % 3 == 0).cast("int").alias("diag_extranodal_site___kidney"), F.when(k % 7 == 0, "skin").alias("diag_extranodal_site_other"),
        no.cast("string").alias("diag_extranodal_site_other_2"), no.cast("string").alias("diag_extranodal_site_other_3"),
        F.when(k % 3 != 0, day).alias("diagnosis_date"), F.month(day).alias("diagnosis_date_month"), F.year(day).alias("diagnosis_date_year"),
        no.cast("date").alias("diagnosis_transformation_date"), no.cast("int").alias("diagnosis_transformation_date_month"),
        no.cast("int").alias("diagnosis_transformation_date_year"),
    )


def _fields(spark: SparkSession, fields: dict[str, str]) -> DataFrame:
    rows = [(k, k, v) for k, v in fields.items()]
    return spark.createDataFrame(rows, f"{dic.FIELD} string, {dic.LABEL} string, {dic.CHOICES} string")


@query(f"""
WITH p AS (SELECT c_custkey AS k, DATE '2010-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS d, DATE '1930-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS b FROM customer),
s AS (SELECT *, year(d) - year(b) AS age, {_sql_choice(["I", "II", "III", "IV", None], "k % 5")} AS stage, k % 6 AS ecog,
  CASE WHEN k % 2 = 1 THEN 1 ELSE 0 END + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS sites FROM p),
n AS (SELECT *, CASE WHEN age > 60 THEN 1 ELSE 0 END + CASE WHEN k % 5 IN (2, 3) THEN 1 WHEN k % 5 < 2 THEN 0 END + CASE WHEN ecog IN (2, 3, 4) THEN 1 WHEN ecog < 2 THEN 0 END
  + CASE WHEN k % 400 > 250 OR k % 40 > 10 THEN 1 ELSE 0 END + CASE WHEN sites > 1 THEN 1 ELSE 0 END AS ipi FROM s)
SELECT CAST(k AS DOUBLE) AS record_id, CAST(age AS INTEGER) AS diagnosis_age, CAST(year(b) AS INTEGER) AS yob, stage AS diag_stage,
  CASE WHEN ecog < 5 THEN 'Grade ' || ecog END AS diag_ecog, {_sql_choice(["no", "yes", "unknown", None], "k % 4")} AS diag_stage_pet,
  {_sql_choice(["GCB", "nonGCB", "nonGCB", None, None], "k % 5")} AS diagnosis_subtype_coo,
  CASE WHEN k % 2 = 0 THEN 'NOS' WHEN k % 4 = 1 THEN 'Other - {_SUBTYPE_TEXT}' ELSE 'Other' END AS diagnosis_subtype,
  nullif(concat_ws(', ', CASE WHEN k % 2 = 1 THEN 'Adrenal' END, CASE WHEN k % 3 = 0 THEN 'Kidney' END, CASE WHEN k % 7 = 0 THEN 'Other1 - skin' END), '') AS diag_site,
  CAST(ipi AS INTEGER) AS diag_ipi_n, CASE WHEN k % 3 <> 0 THEN strftime(d, '%d/%m/%Y') ELSE 'nk/' || month(d) || '/' || year(d) END AS diagnosis_date,
  CASE WHEN k % 3 <> 0 THEN d ELSE make_date(year(d), month(d), 15) END AS diagnosis_date_15, CAST(NULL AS DATE) AS diagnosis_transformation_date_15 FROM n
""")
def clean_patients(spark, folder):
    """The patient run: age, recodes (subtype, stage, performance, PET), decoding, scores, sites and dated variants."""
    dd = _fields(spark, {
        "diagnosis": "dlbcl, DLBCL", "diag_ecog": " | ".join(f"{i}, Grade {i}" for i in range(5)), "diag_stage": "1, I | 2, II | 3, III | 4, IV",
        "diagnosis_subtype": "1, NOS | 2, Other", "diagnosis_transformation_before": "1, FL",
    })
    base = _patients(spark, folder).withColumn("diagnosis_subtype", F.when(F.col("diagnosis_subtype") == "1", "1").otherwise("2"))
    return cleaning.clean_patients(base, dd).select(
        "record_id", "diagnosis_age", "yob", "diag_stage", "diag_ecog", "diag_stage_pet", "diagnosis_subtype_coo", "diagnosis_subtype", "diag_site",
        "diag_ipi_n", "diagnosis_date", "diagnosis_date_15", "diagnosis_transformation_date_15",
    )


_THERAPY_DATES = ["therapy_start_date", "therapy_end_date", "therapy_relapse_date", *therapy.PLAIN_DATES]


def _therapy_dates_sql() -> str:
    out = []
    for i, name in enumerate(_THERAPY_DATES):
        d, known = f"(d + {i})", f"k % {i + 2} <> 0"
        only = {"therapy_relapse_date": "k % 5 < 3"}.get(name, "k % 4 <> 1" if i < 2 else "true")
        month = f"k % {i + 3} <> 1"
        out.append(f"CASE WHEN {only} AND {known} THEN {d} WHEN {only} AND {month} THEN make_date(year({d}), month({d}), 28) END AS {name}_28")
        out.append(f"CASE WHEN {only} AND ({known} OR {month}) THEN NOT ({known}) END AS {name}_imputed_day")
        text = f"CASE WHEN {known} THEN strftime({d}, '%d/%m/%Y') WHEN {month} THEN 'nk/' || month({d}) || '/' || year({d}) END"
        out.append(f"CASE WHEN {only} THEN {text} END AS {name}")
    return "SELECT k AS order_key, " + ", ".join(out) + " FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders)"


@query(_therapy_dates_sql())
def therapy_dates(spark, folder):
    """The eight dates of a therapy record, two of them only for treated patients and one only after a relapse."""
    o, k = table(spark, folder, "orders"), F.col("o_orderkey")
    columns = [k.alias("order_key"), F.when(k % 4 != 1, 1).otherwise(0).alias("treat_y_n"), F.when(k % 5 < 3, "yes").otherwise("no").alias("therapy_relapse_y_n")]
    for i, name in enumerate(_THERAPY_DATES):
        d = F.date_add(F.col("o_orderdate").cast("date"), i)
        columns += [F.when(k % (i + 2) != 0, d).alias(name), F.when(k % (i + 3) != 1, F.month(d)).alias(f"{name}_month"), F.year(d).alias(f"{name}_year")]
    out = therapy.impute_therapy_dates(o.select(*columns))
    return out.select("order_key", *[c for n in _THERAPY_DATES for c in (f"{n}_28", f"{n}_imputed_day", n)])


_STUDY_CODES = [1, 0, None, None]
_RESPONSES = ["CR", "PR", "SD", "PD", "NE", "Unknown", "Not done", None]
_KINDS = ["CNS, Periphery", "CNS", "Periphery", None, None]


def _first_of(values: list[str], column: str) -> str:
    return "CASE " + " ".join(f"WHEN bool_or({column} = '{v}') THEN '{v}'" for v in values) + " END"


@query(f"""
WITH x AS (SELECT l_orderkey AS record_id, CAST(l_linenumber % 2 + 1 AS INTEGER) AS treat_line, l_linenumber AS cycle, l_partkey AS part, l_suppkey AS supplier,
  (l_partkey + l_suppkey) AS k, CAST(l_shipdate AS DATE) AS d FROM lineitem),
y AS (SELECT *, {_sql_choice(_RESPONSES, "k % 8")} AS resp, {_sql_choice(_STUDY_CODES, "k % 4")} AS study, {_sql_choice(["yes", "no", "Not done", None], "k % 4")} AS relapse,
  CASE WHEN k % 3 = 0 THEN d END AS before, {_sql_choice(_KINDS, "k % 5")} AS kind, {_sql_choice(_KINDS, "part % 5")} AS kind2,
  {_sql_choice(["ja", "nein", "weg"], "k % 3")} AS pet, {_sql_choice(["no", "Not done", None], "part % 3")} AS biopsy FROM x),
g AS (SELECT record_id, treat_line, CASE WHEN bool_or(study = 1) THEN 'yes' WHEN bool_or(study = 0) THEN 'no' END AS study_line,
  {_first_of(["yes", "no", "Not done"], "relapse")} AS relapse_line, CASE WHEN bool_or(before IS NOT NULL) THEN 'yes' ELSE 'no' END AS before_line,
  {_first_of(_KINDS[:3], "kind")} AS kind_line, {_first_of(_KINDS[:3], "kind2")} AS kind2_line, CASE WHEN bool_or(kind2 IS NOT NULL) THEN 'yes' ELSE 'no' END AS prog,
  {_first_of(["ja", "nein"], "pet")} AS pet_line, {_first_of(["yes", "no", "Not done"], "biopsy")} AS biopsy_line,
  coalesce(string_agg(resp, ', ' ORDER BY cycle, part, supplier), '') AS resp_all,
  coalesce({_first_of(["CR", "PR", "SD", "PD", "NE"], "resp")}, CASE WHEN bool_or(resp IN ('Unknown', 'Not done')) THEN 'Unknown' ELSE '' END) AS best,
  array_to_string(list_sort(list_distinct(list(drug))), ', ') AS drugs
  FROM (SELECT *, 'Drug' || part % 6 AS drug FROM y) GROUP BY 1, 2)
SELECT y.record_id, y.treat_line, cycle, part, supplier, CASE WHEN k % 2 = 1 THEN 'yes' ELSE 'no' END AS treat_y_n, study_line AS treat_study_line,
  relapse_line AS therapy_relapse_y_n_line, before_line AS progression_before_y_n_line, kind_line AS progression_before_type_line,
  kind2_line AS progression_type_line, prog AS progression_y_n_line, CASE pet_line WHEN 'ja' THEN 'yes' WHEN 'nein' THEN 'no' END AS treat_best_response_petct,
  biopsy_line AS treat_rebiopsy_line, resp_all AS treat_best_response_all, best AS treat_best_response_line, drugs AS drug_med_all_line
FROM y JOIN g ON g.record_id = y.record_id AND g.treat_line = y.treat_line
""")
def progression_labels(spark, folder):
    """The values of a therapy line on every record of the line."""
    k = F.col("l_partkey") + F.col("l_suppkey")
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("record_id"), (F.col("l_linenumber") % 2 + 1).cast("int").alias("treat_line"), F.col("l_linenumber").alias("cycle"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), (k % 2).cast("int").alias("treat_y_n"),
        _choice(_RESPONSES, k % 8).alias("treat_best_response"), _choice(_STUDY_CODES, k % 4).alias("treat_study"),
        _choice(["yes", "no", "Not done", None], k % 4).alias("therapy_relapse_y_n"), F.when(k % 3 == 0, F.col("l_shipdate").cast("date")).alias("progression_before_date"),
        _choice(_KINDS, k % 5).alias("progression_before_type"), _choice(_KINDS, F.col("l_partkey") % 5).alias("progression_type"),
        _choice(["ja", "nein", "weg"], k % 3).alias("treat_best_response_petct"), _choice(["no", "Not done", None], F.col("l_partkey") % 3).alias("treat_rebiopsy"),
        F.concat(F.lit("Drug"), F.col("l_partkey") % 6).alias("drug_med_all"),
    )
    out = therapy.progression_labels(rows, order=("cycle", "part", "supplier"))
    return out.select(
        "record_id", "treat_line", "cycle", "part", "supplier", "treat_y_n", "treat_study_line", "therapy_relapse_y_n_line", "progression_before_y_n_line",
        "progression_before_type_line", "progression_type_line", "progression_y_n_line", "treat_best_response_petct", "treat_rebiopsy_line",
        "treat_best_response_all", "treat_best_response_line", "drug_med_all_line",
    )


# --- survival runs ------------------------------------------------------------------------------

_MONTH = "CAST(30.4375 AS DOUBLE)"


@query(
    f"""WITH {views.SURVIVAL.strip()},
z AS (SELECT *, therapy_start_date_15 + CAST(record_id % 20 AS INTEGER) AS ts, diagnosis_date_15 - CAST(record_id % 30 AS INTEGER) AS dg FROM survival),
e AS (SELECT *, CASE WHEN progression_event_date_15 IS NOT NULL THEN progression_event_date_15 WHEN is_last_line AND progression_sv_last_date_15 >= ts THEN progression_sv_last_date_15
  WHEN is_last_line THEN status_date_15 END AS stop FROM z)
SELECT record_id, treat_line, PFS_event, OS_event, round(PFS_15_15, 6) AS PFS_15_15, round(OS_28_01, 6) AS OS_28_01,
  round(date_diff('day', ts, stop) / {_MONTH}, 6) AS PFS_density, round(date_diff('day', dg, status_date_15) / {_MONTH}, 6) AS OS_density FROM e"""
)
def calc_pfs_os(spark, folder):
    """Records with text dates to lines with every survival time, those from imputed anchors too."""
    sizes = views.patient_sizes(spark, folder)
    rows = views.with_status(views.records(spark, folder, sizes), spark, folder)
    shift = F.col("record_id").cast("int")
    rows = rows.withColumns({
        "therapy_start_date_density_imp": F.date_add("therapy_start_date_15", shift % 20).cast("string"),
        "diagnosis_date_density_imp": F.date_sub("diagnosis_date_15", shift % 30),
        "therapy_start_date_15": F.date_format("therapy_start_date_15", "dd/MM/yyyy"),
    })
    out = lines.calc_pfs_os(rows, tie=("cycle", "part", "supplier"), sizes=sizes)
    return _r(out, "PFS_15_15", "OS_28_01", "PFS_density", "OS_density").select(
        "record_id", "treat_line", "PFS_event", "OS_event", "PFS_15_15", "OS_28_01", "PFS_density", "OS_density"
    )


_LAG = "(o_orderkey * 7) % 400 - 10"


@query(f"""
WITH x AS (SELECT CAST({_LAG} AS DOUBLE) AS lag, o_orderkey % 3 AS g, o_orderkey % 2 = 0 AS rchop FROM orders),
y AS (SELECT 'all' AS sample, lag FROM x UNION ALL SELECT 'elevated with', lag FROM x WHERE g = 1 AND rchop UNION ALL SELECT 'without', lag FROM x WHERE NOT rchop)
SELECT sample, lag, count(*) AS n FROM y WHERE lag >= 0 AND lag < 365 GROUP BY 1, 2
""")
def lag_samples(spark, folder):
    """Observed lags from diagnosis to therapy start, of all patients and of strata."""
    k = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        ((k * 7) % 400 - 10).cast("double").alias("Time_diag_to_txstart"), _choice(["normal", "elevated", None], k % 3).alias("ldh_group"), (k % 2 == 0).alias("rchop_flag")
    )
    samples = {"all": {}, "elevated with": {"ldh": "elevated", "rchop": "include"}, "without": {"rchop": "exclude"}}
    made = [impute.lag_sample(rows, **kw).withColumn("sample", F.lit(n)) for n, kw in samples.items()]
    return made[0].unionByName(made[1]).unionByName(made[2])


# --- second cohort ------------------------------------------------------------------------------


@query("""
WITH f AS (SELECT o_custkey AS record_id, o_orderkey, CAST(o_custkey % 50 + 1940 AS INTEGER) AS yob, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r,
  list_extract(['First diagnosis', 'Progression', 'Moved', NULL], CAST(o_orderkey % 4 AS INTEGER) + 1) AS reason FROM orders),
p AS (SELECT DISTINCT record_id, yob FROM f WHERE (reason IS NULL OR reason <> 'Moved') AND CAST(record_id AS VARCHAR) LIKE '1%'),
c AS (SELECT p.*, CAST(c_custkey % 80 + 18 > 60 AS INTEGER) + CAST(c_custkey % 4 + 1 >= 3 AS INTEGER) + CAST(c_acctbal / 500 < 12 AS INTEGER) + CAST(c_custkey % 3 = 0 AS INTEGER)
  + CAST(c_custkey % 9 > 4 AS INTEGER) AS flipi FROM p JOIN customer ON c_custkey = record_id)
SELECT c.record_id, yob, flipi AS diag_flipi_n, CASE WHEN flipi <= 1 THEN 'Low' WHEN flipi = 2 THEN 'Intermediate' ELSE 'High' END AS diag_flipi_risk_grade,
  CAST(o_orderkey AS INTEGER) AS line_key, o_totalprice AS price FROM c JOIN orders ON o_custkey = record_id
""")
def second_cohort(spark, folder):
    """The second cohort's lines with their patients' risk groups, exported as CSV per grain and read back."""
    k = F.col("o_custkey")
    o = table(spark, folder, "orders")
    reason = _choice(["First diagnosis", "Progression", "Moved", None], F.col("o_orderkey") % 4)
    final = o.select(k.alias("record_id"), (k % 50 + 1940).cast("int").alias("yob"), reason.alias("drug1_start_reason"), F.col("o_orderkey").alias("cycle"))
    c, i = table(spark, folder, "customer"), F.col("c_custkey")
    scored = scores.flipi(
        c, age=i % 80 + 18, stage=i % 4 + 1, hemoglobin=F.col("c_acctbal") / 500, ldh_elevated=i % 3 == 0, nodal_areas=i % 9,
        node_cm=i % 12, b2m_elevated=i % 5 == 0, marrow=i % 2 == 0,
    ).select(i.alias("record_id"), "diag_flipi_n", "diag_flipi_risk_grade")
    line = o.select(k.alias("record_id"), F.col("o_orderkey").alias("line_key"), F.col("o_totalprice").alias("price"))
    patient = ["yob", "diag_flipi_n", "diag_flipi_risk_grade"]
    lines_out = cleaning.second_cohort_lines(final.join(scored, "record_id"), line, patient, F.col("record_id").cast("string").rlike("^1"))
    folder_out = exports.results_path("cohort", shared_folder(spark, "results"))
    exports.write_csv(lines_out.select("record_id", "line_key", "price"), f"{folder_out}/therapy_lines")
    exports.write_csv(lines_out.select("record_id", *patient).distinct(), f"{folder_out}/diagnosis_survival")
    read = lambda name: registry.read_registry(spark, f"{folder_out}/{name}", sequence=None)
    return read("therapy_lines").join(read("diagnosis_survival"), "record_id").withColumn("record_id", F.col("record_id").cast("long"))


# --- analysis sheet -----------------------------------------------------------------------------


def _sheet(spark: SparkSession, folder: str) -> DataFrame:
    """The sheet as it is exported, read back from CSV and with its derived columns."""
    k = F.col("c_custkey")
    begun = F.date_add(F.lit("2018-01-01").cast("date"), (k % 1000).cast("int"))
    serial = F.datediff(begun, F.lit("1899-12-30").cast("date")).cast("string")
    end = F.date_add(begun, (k * 37 % 2000 + 30).cast("int"))
    sheet = table(spark, folder, "customer").select(
        k.alias("id"), F.when(k % 2 == 0, F.date_format(begun, "dd.MM.yyyy")).otherwise(serial).alias("mBC diagnosis"), end.alias(bands.END_DATE),
        F.when(k % 3 != 0, F.date_add(begun, (k * 13 % 900 + 5).cast("int"))).alias("date of PD"), (k % 3 == 0).cast("int").alias("Alive"),
        (k % 11 == 0).cast("int").alias("Lost to FU"), (k % 200 / 10 + 17).alias("BMI"), (k % 60).cast("int").alias("Ki-67"),
        (k % 8).cast("int").alias("Number of metastatic sites"), (k % 4).cast("int").alias("1st line HR+"), (k % 5).cast("int").alias("Menopausal status"),
        (k % 2).cast("int").alias("De novo"), (k % 3 % 2).cast("int").alias("DFI"), (k % 2).cast("int").alias("Visceral disease"),
        F.when(k % 13 != 0, (k % 2).cast("int")).alias("Sarcopenia"),
    )
    where = f"{shared_folder(spark, 'sheet')}/sheet"
    sheet.write.options(header=True, escape='"').csv(where)
    types = {c: t for c, t in sheet.dtypes if t != "string"}
    return bands.prepare_sheet(registry.read_sheet(spark, where, types=types))


_SHEET = f"""sheet AS (SELECT c_custkey AS k, DATE '2018-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS begun FROM customer),
dated AS (SELECT *, begun + CAST(k * 37 % 2000 + 30 AS INTEGER) AS stop, CASE WHEN k % 3 <> 0 THEN begun + CAST(k * 13 % 900 + 5 AS INTEGER) END AS pd FROM sheet),
prepared AS (SELECT *, CASE WHEN k % 13 <> 0 THEN CASE k % 2 WHEN 0 THEN 'No' ELSE 'Yes' END END AS arm, CASE WHEN k % 3 = 0 OR k % 11 = 0 THEN 0 ELSE 1 END AS os_event,
  date_diff('day', begun, stop) / {_MONTH} AS os_time, date_diff('day', begun, pd) / {_MONTH} AS pfs_time, CASE WHEN pd IS NULL THEN 0 WHEN pd < stop THEN 1 ELSE 0 END AS pfs_event,
  k % 60 AS ki, k % 200 / CAST(10 AS DOUBLE) + 17 AS bmi FROM dated),
os AS (SELECT k, arm, os_time AS time, os_event AS event, ki, bmi FROM prepared WHERE arm IS NOT NULL)"""


@query(
    f"""WITH {_SHEET}
SELECT CAST(k AS INTEGER) AS id, os_event AS "OS_event", CASE WHEN bmi < 18.5 THEN '<18.5' WHEN bmi <= 24.9 THEN '18.5-24.9' WHEN bmi >= 25 AND bmi <= 29.9 THEN '25-29.9' WHEN bmi >= 30 THEN '>=30' END AS "BMI_cat",
  CASE WHEN ki < 20 THEN '<20' ELSE '>=20' END AS ki_67_cat, CASE WHEN k % 8 <= 2 THEN '1' WHEN k % 8 = 3 THEN '2-3' WHEN k % 8 <= 6 THEN '>3' END AS num_met_sites,
  CASE WHEN k % 4 IN (0, 2) THEN 'ET mono/target' WHEN k % 4 = 1 THEN 'ET + CDK4/6i' ELSE 'Ctx +/- Bev' END AS firstline_hr,
  CASE WHEN k % 5 <= 1 THEN 'pre_peri' WHEN k % 5 = 2 THEN 'post' WHEN k % 5 = 3 THEN 'unknown' END AS "Menopausal_status",
  CASE WHEN k % 2 = 1 THEN 'de_novo' WHEN k % 3 % 2 = 0 THEN 'DFI_<=24' ELSE 'DFI_>24' END AS "DFI_combined", arm AS "Arm", CAST(begun AS DATE) AS "mBC_diagnosis_date",
  round(os_time, 6) AS "OS_time", round(pfs_time, 6) AS "PFS_time", pfs_event AS "PFS_event" FROM prepared"""
)
def sheet_columns(spark, folder):
    out = _sheet(spark, folder)
    names = ["OS_event", "BMI_cat", "ki_67_cat", "num_met_sites", "firstline_hr", "Menopausal_status", "DFI_combined", "Arm", "mBC_diagnosis_date", "OS_time", "PFS_time", "PFS_event"]
    return _r(out, "OS_time", "PFS_time").select(F.col("id").cast("int").alias("id"), *names)


@query(
    f"WITH {_SHEET},{km_sql('os')} SELECT arm AS \"Arm\", max(n) AS records, CAST(sum(d) AS BIGINT) AS events, "
    f"{median_sql('s', 'median')}, {median_sql('lo', 'lower95')}, {median_sql('hi', 'upper95')} FROM km GROUP BY arm"
)
def sheet_survival(spark, folder):
    """Median overall survival per arm of the analysis sheet."""
    rows = _sheet(spark, folder).where(F.col("Arm").isNotNull())
    return _r(K.median_survival(K.kaplan_meier(rows, "OS_time", "OS_event", ["Arm"]), ["Arm"]), "median", "lower95", "upper95")


_SHEET_XS = ["CASE WHEN arm = 'Yes' THEN 1 ELSE 0 END", "ki"]


@query(
    f"WITH {_SHEET},\n{cox_sql(_SHEET_XS, source='os')} SELECT 'ArmYes' AS term, 'Arm' AS variable, 'Yes' AS level, {_z(0)} FROM cxb, cxv "
    f"UNION ALL SELECT 'Ki-67', 'Ki-67', NULL, {_z(1)} FROM cxb, cxv"
)
def sheet_cox(spark, folder):
    """The model of the analysis sheet: arm and proliferation."""
    fit = C.cox_fit(_sheet(spark, folder), "OS_time", "OS_event", ["Arm", "Ki-67"], {"Arm": bands.NO_YES})
    return _r(C.coefficients(fit), "coef", "se", "hr", "lower", "upper", "z", "p")
