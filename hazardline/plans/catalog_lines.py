"""Catalogue of line and patient queries: status, line values, survival times, cohort joins, quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.operators import fill, groups, impute, lines, quality, status, summary
from hazardline.operators.contracts import completeness
from hazardline.operators.scans import KeySizes
from hazardline.plans import views
from hazardline.plans.catalog_cleaning import _REGIMENS
from hazardline.plans.views import table

Q: dict[str, tuple] = {}


def query(sql: str | None):
    def add(fn):
        Q[fn.__name__] = (fn, sql)
        return fn

    return add


# --- survival status ----------------------------------------------------------------------------


def _status_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One status record per order."""
    o = views.lines(spark, folder)
    k, day = F.col("order_key"), F.col("start")
    state = (
        F.when(F.col("state") == "F", "deceased").when(F.col("state") == "O", "alive").when(k % 2 == 0, "nd").otherwise("unknown")
    )
    cols = {
        "surv_stat": state,
        "surv_lost2fu_y_n": F.when(k % 11 == 0, 1).when(k % 11 == 1, 0),
        "last_contact_date": F.when(k % 3 != 0, day),
        "surv_dod_date": F.when(k % 4 == 1, F.date_add(day, 9)),
        "dod_ic_date": F.when(k % 4 == 2, F.date_add(day, 12)),
        "progression_sv_last_date": F.when(k % 5 == 0, F.date_sub(day, 40)),
    }
    out = o.select("record_id", F.col("treat_line").alias("cycle"), "order_key", *[c.alias(n) for n, c in cols.items()], F.col("start"))
    parts = {
        f"{n}_{p}": F.when(k % m != 0, (F.month if p == "month" else F.year)("start"))
        for n, m in (("last_contact_date", 7), ("surv_dod_date", 6), ("dod_ic_date", 8), ("progression_sv_last_date", 2))
        for p in ("month", "year")
    }
    return out.withColumns(parts).drop("start")


@query(
    f"""
WITH {views.LINES.strip()},
s AS (SELECT record_id, treat_line AS cycle, order_key AS k, start, state,
  CASE WHEN state = 'P' OR order_key % 11 = 0 THEN 'Lost2FU' WHEN state = 'F' THEN 'deceased' ELSE 'alive' END AS surv_stat,
  CASE WHEN order_key % 3 <> 0 THEN start END AS contact,
  coalesce(CASE WHEN order_key % 4 = 1 THEN start + 9 END, CASE WHEN order_key % 4 = 2 THEN start + 12 END) AS dod,
  CASE WHEN order_key % 5 = 0 THEN start - 40 END AS prog,
  coalesce(CASE WHEN order_key % 2 <> 0 THEN month(start) END, CASE WHEN order_key % 8 <> 0 THEN month(start) END) AS pm,
  coalesce(CASE WHEN order_key % 2 <> 0 THEN year(start) END, CASE WHEN order_key % 8 <> 0 THEN year(start) END) AS py,
  order_key % 2 = 0 AND order_key % 8 <> 0 AS from_death
  FROM lines),
l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY cycle DESC) = 1),
d AS (SELECT *, CASE WHEN surv_stat IN ('alive', 'Lost2FU') THEN contact ELSE dod END AS sd,
  CASE WHEN surv_stat IN ('alive', 'Lost2FU') AND contact IS NULL AND k % 7 <> 0 THEN true
       WHEN surv_stat = 'deceased' AND dod IS NULL AND k % 6 <> 0 THEN true ELSE false END AS part FROM l)
SELECT CAST(record_id AS DOUBLE) AS record_id, surv_stat,
  CASE WHEN sd IS NOT NULL THEN strftime(sd, '%d/%m/%Y') WHEN part THEN 'nk/' || month(start) || '/' || year(start) END AS status_date,
  CASE WHEN sd IS NOT NULL THEN false WHEN part THEN true END AS status_date_imputed_day,
  CASE WHEN sd IS NOT NULL THEN sd WHEN part THEN make_date(CAST(year(start) AS INTEGER), CAST(month(start) AS INTEGER), 15) END AS status_date_15,
  CASE WHEN prog IS NOT NULL THEN prog WHEN pm IS NOT NULL THEN make_date(CAST(py AS INTEGER), CAST(pm AS INTEGER), 28) END AS progression_sv_last_date_28,
  from_death AS progression_sv_last_from_death
FROM d"""
)
def survival_status(spark, folder):
    out = status.survival_status(_status_rows(spark, folder), tie=["order_key"])
    return out.select(
        "record_id", "surv_stat", "status_date", "status_date_imputed_day", "status_date_15",
        "progression_sv_last_date_28", "progression_sv_last_from_death",
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 0 WHEN o_orderkey % 10 = 0 THEN 0 ELSE 1 END AS os_event,
  CASE WHEN o_orderkey % 4 = 0 THEN 0 WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 4 - 2 < 0 THEN 1 ELSE 0 END AS pfs_event
FROM orders
""")
def sheet_events(spark, folder):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    o = table(spark, folder, "orders").select(
        "o_orderkey",
        (F.col("o_orderstatus") == "O").cast("int").alias("alive"),
        (k % 10 == 0).cast("int").alias("lost"),
        F.when(k % 4 != 0, F.date_add(day, (k % 4).cast("int"))).alias("pd"),
        F.when(k % 9 != 0, F.date_add(day, 2)).alias("fin"),
    )
    return o.select("o_orderkey", status.os_event("alive", "lost").alias("os_event"), status.pfs_event("pd", "fin").alias("pfs_event"))


# --- line values --------------------------------------------------------------------------------

_RANK = "CASE v " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(groups.SITES)) + " END"


@query(f"""
WITH x AS (SELECT l_orderkey AS order_key, l_shipdate, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'CNS, Periphery' WHEN l_returnflag = 'R' THEN 'CNS'
  WHEN l_returnflag = 'A' THEN 'Periphery' END AS v, CASE WHEN l_quantity > 40 THEN l_shipdate END AS d FROM lineitem)
SELECT order_key, list_extract({groups.SITES!r}, CAST(min({_RANK}) AS INTEGER) + 1) AS kind,
  CASE WHEN bool_or(d IS NOT NULL) THEN 'yes' ELSE 'no' END AS dated FROM x GROUP BY 1
""")
def priority_any(spark, folder):
    flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    kind = F.when((flag == "R") & (state == "F"), "CNS, Periphery").when(flag == "R", "CNS").when(flag == "A", "Periphery")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_key"))
        .agg(
            groups.priority_any(kind, groups.SITES).alias("kind"),
            groups.any_present(F.when(F.col("l_quantity") > 40, F.col("l_shipdate"))).alias("dated"),
        )
    )


_RESPONSES = ["CR", "PR", "SD", "PD", "NE", "Unknown", "Not done", "0"]


@query(f"""
WITH x AS (SELECT l_orderkey AS order_key, (l_linenumber, l_partkey, l_suppkey) AS o,
  CASE WHEN l_quantity > 25 THEN list_extract({_RESPONSES!r}, CAST((l_partkey * 7 + l_suppkey) % 8 AS INTEGER) + 1) END AS v FROM lineitem),
g AS (SELECT order_key, coalesce(string_agg(v, ', ' ORDER BY o), '') AS joined FROM x GROUP BY 1)
SELECT order_key, joined, CASE WHEN contains(joined, 'CR') THEN 'CR' WHEN contains(joined, 'PR') THEN 'PR' WHEN contains(joined, 'SD') THEN 'SD'
  WHEN contains(joined, 'PD') THEN 'PD' WHEN contains(joined, 'NE') THEN 'NE'
  WHEN contains(joined, 'Unknown') OR contains(joined, 'Not done') THEN 'Unknown' ELSE joined END AS best
FROM g
""")
def best_response(spark, folder):
    code = F.get(F.array(*[F.lit(r) for r in _RESPONSES]), ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 8).cast("int"))
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    x = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), *order, F.when(F.col("l_quantity") > 25, code).alias("v")
    )
    text = x.groupBy("order_key").agg(groups.paste_without_null("v", groups.order_struct(*order)).alias("joined"))
    return text.join(groups.best_response(x, ["order_key"], "v", order, "best"), "order_key")


@query(f"""
WITH {views.LINES.strip()}
SELECT record_id, treat_line, order_key, CASE WHEN treat_line = max(CASE WHEN order_key % 6 <> 0 THEN treat_line END) OVER (PARTITION BY record_id)
  AND order_key % 6 <> 0 THEN 1 ELSE 0 END AS max_treat_line FROM lines
""")
def max_line(spark, folder):
    x = views.lines(spark, folder).withColumn("line", F.when(F.col("order_key") % 6 != 0, F.col("treat_line")))
    return groups.max_treat_line(x, line="line").select("record_id", "treat_line", "order_key", "max_treat_line")


_COLLAPSED_OUT = [
    "record_id", "treat_line", *views._DATE_COLUMNS, *[f"{n}_imputed_day" for n in views._RECORD_DATES],
    "treat_best_response", "cycle", "part", "supplier", "max_treat_line_num", "is_last_line",
]


@query(f"WITH {views.COLLAPSED.strip()} SELECT {', '.join(_COLLAPSED_OUT)} FROM collapsed")
def collapse_lines(spark, folder):
    sizes = views.patient_sizes(spark, folder)
    return lines.last_line(views.grouped(spark, folder, sizes), sizes=sizes).select(*_COLLAPSED_OUT)


_EVENT_OUT = ["record_id", "treat_line", *[f"progression_event_date_{d}" for d in ("01", "15", "28")]]


@query(f"WITH {views.EVENTS.strip()} SELECT {', '.join(_EVENT_OUT)} FROM events_line")
def progression_events(spark, folder):
    sizes = views.patient_sizes(spark, folder)
    return lines.progression_events(views.grouped(spark, folder, sizes), sizes=sizes).select(*_EVENT_OUT)


_GRID = [(a, b) for a in ("01", "15", "28") for b in ("01", "15", "28")]


@query(
    f"WITH {views.SURVIVAL.strip()} SELECT record_id, treat_line, "
    + ", ".join(f"round(PFS_{a}_{b}, 6) AS PFS_{a}_{b}" for a, b in _GRID)
    + ", PFS_event, progression_event_date_imputed_day FROM survival"
)
def pfs_grid(spark, folder):
    return views.survival(spark, folder).select(
        "record_id", "treat_line", *[F.round(f"PFS_{a}_{b}", 6).alias(f"PFS_{a}_{b}") for a, b in _GRID],
        "PFS_event", "progression_event_date_imputed_day",
    )


@query(
    f"WITH {views.SURVIVAL.strip()} SELECT record_id, treat_line, "
    + ", ".join(f"round(OS_{a}_{b}, 6) AS OS_{a}_{b}" for a, b in _GRID)
    + ", OS_event FROM survival"
)
def os_grid(spark, folder):
    return views.survival(spark, folder).select(
        "record_id", "treat_line", *[F.round(f"OS_{a}_{b}", 6).alias(f"OS_{a}_{b}") for a, b in _GRID], "OS_event"
    )


@query(
    f"WITH {views.COLLAPSED.strip()}, first AS (SELECT * FROM collapsed QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY treat_line) = 1) "
    "SELECT record_id, treat_line, "
    + ", ".join(
        f"round(date_diff('day', diagnosis_date_{d}, status_date_{s}) / CAST(30.4375 AS DOUBLE), 6) AS OS_{s}_{d}" for s, d in _GRID
    )
    + ", CASE WHEN surv_stat = 'deceased' THEN 1 WHEN surv_stat IN ('alive', 'Lost2FU') THEN 0 END AS OS_event FROM first"
)
def os_patient(spark, folder):
    out = lines.os_patient(views.collapsed(spark, folder), order=["treat_line"])
    return out.select(
        "record_id", "treat_line", *[F.round(f"OS_{a}_{b}", 6).alias(f"OS_{a}_{b}") for a, b in _GRID], "OS_event"
    )


# --- joins --------------------------------------------------------------------------------------


@query(f"""
WITH {views.LINES.strip()}, {views.STATUS.strip()},
score AS (SELECT user_id AS record_id, max(value) AS score FROM events GROUP BY 1)
SELECT c_custkey AS record_id, c_mktsegment AS arm, treat_line, order_key, surv_stat, status_date, round(score, 6) AS score,
  CASE WHEN treat_line = max(treat_line) OVER (PARTITION BY c_custkey) THEN 1 WHEN treat_line IS NOT NULL THEN 0 END AS max_treat_line
FROM customer LEFT JOIN lines l ON l.record_id = c_custkey LEFT JOIN status s ON s.record_id = c_custkey
  LEFT JOIN score x ON x.record_id = c_custkey
""")
def cohort_join(spark, folder):
    """Patients to their lines, status and score; the last-line mark from a small distinct table."""
    from hazardline.plans.cleaning import build_cohort

    diag = table(spark, folder, "customer").select(F.col("c_custkey").alias("record_id"), F.col("c_mktsegment").alias("arm"))
    thx = views.lines(spark, folder).select("record_id", "treat_line", "order_key", F.col("treat_line").alias("cycle"))
    sv = views.status(spark, folder).select("record_id", "surv_stat", "status_date")
    score = table(spark, folder, "events").groupBy(F.col("user_id").alias("record_id")).agg(F.round(F.max("value"), 6).alias("score"))
    small = groups.max_treat_line(thx).select("record_id", "cycle", "max_treat_line").distinct()
    return (
        build_cohort(diag, thx, sv, score)
        .join(small, ["record_id", "cycle"], "left")
        .select("record_id", "arm", "treat_line", "order_key", "surv_stat", "status_date", "score", "max_treat_line")
    )


@query(f"""
WITH {views.LINES.strip()},
p AS (SELECT record_id, min(start) AS diagnosis FROM lines GROUP BY 1)
SELECT c_custkey AS record_id, c_nationkey AS sample_origin, diagnosis, treat_line, priority
FROM customer LEFT JOIN p ON p.record_id = c_custkey LEFT JOIN lines l ON l.record_id = c_custkey
""")
def sample_join(spark, folder):
    """A sample register joined to patients and, by patient only, to their lines."""
    line = views.lines(spark, folder)
    pat = line.groupBy("record_id").agg(F.min("start").alias("diagnosis"))
    sample = table(spark, folder, "customer").select(F.col("c_custkey").alias("record_id"), F.col("c_nationkey").alias("sample_origin"))
    return (
        sample.join(pat, "record_id", "left")
        .join(line.select("record_id", "treat_line", "priority"), "record_id", "left")
        .select("record_id", "sample_origin", "diagnosis", "treat_line", "priority")
    )


# --- quality ------------------------------------------------------------------------------------


def _rule_rows(spark: SparkSession, folder: str, sizes: KeySizes) -> DataFrame:
    """Records in entry order with coarse line numbers, so that the rules find something."""
    k, line = F.col("order_key"), F.col("treat_line")
    drugs = F.get(F.array(*[F.lit(r) for r in _REGIMENS[:5]]), (k % 5).cast("int"))
    return views.lines(spark, folder, sizes).select(
        "record_id",
        line.alias("cycle"),
        F.floor((line + k % 3) / 2).cast("int").alias("treat_line"),
        F.get(F.array(*[F.lit(r) for r in ("SD", "PD", "CR")]), (k % 3).cast("int")).alias("treat_best_response"),
        F.when(k % 4 == 0, "Maintenance therapy").otherwise("Progression").alias("drug1_start_reason"),
        drugs.alias("drug_med_all"),
        F.when(k % 5 < 2, F.date_add("start", 30)).alias("progression_date_15"),
        F.when(k % 7 < 3, F.col("start")).alias("progression_before_date_01"),
        F.when(k % 7 < 3, F.col("start")).alias("progression_before_date_15"),
        F.when(k % 6 == 0, F.col("start")).alias("therapy_relapse_date_15"),
        F.when(F.col("state") == "F", "deceased").otherwise("alive").alias("surv_stat"),
        (k % 9 == 0).cast("int").alias("surv_lost2fu_y_n"),
        F.when(k % 8 == 0, F.col("start")).alias("progression_sv_last_date"),
        F.when(k % 10 != 0, F.lit("no")).alias("w_and_w_y_n"),
        "order_key",
    )


_RULES = f"""
WITH {views.LINES.strip()},
r AS (SELECT record_id, treat_line AS cycle, CAST(floor((treat_line + order_key % 3) / 2) AS INTEGER) AS treat_line, order_key, order_key AS k, start, state,
  list_extract(['SD', 'PD', 'CR'], CAST(order_key % 3 AS INTEGER) + 1) AS resp, CASE WHEN order_key % 4 = 0 THEN 'Maintenance therapy' ELSE 'Progression' END AS reason,
  order_key % 5 AS drug, CASE WHEN order_key % 5 < 2 THEN start + 30 END AS own, CASE WHEN order_key % 7 < 3 THEN start END AS bef,
  CASE WHEN order_key % 6 = 0 THEN start END AS rel FROM lines),
n AS (SELECT *, lead(treat_line) OVER w AS nl, lag(treat_line) OVER w AS pl, lead(reason) OVER w AS nr, lead(drug) OVER w AS nd, lead(bef) OVER w AS nb
  FROM r WINDOW w AS (PARTITION BY record_id ORDER BY cycle, treat_line))
"""


@query(
    _RULES
    + """
SELECT 'progress_same_line' AS rule, record_id, cycle, treat_line FROM n WHERE resp IN ('SD', 'PD') AND (bef IS NOT NULL OR rel IS NOT NULL) AND treat_line = nl AND nr <> 'Maintenance therapy'
UNION ALL SELECT 'stable_same_drugs', record_id, cycle, treat_line FROM n WHERE resp = 'SD' AND drug = nd AND nr <> 'Maintenance therapy'
UNION ALL SELECT 'line_change_without_progression', record_id, cycle, treat_line FROM n WHERE own IS NULL AND bef IS NOT NULL AND treat_line <> nl
UNION ALL SELECT 'progression_without_line_change', record_id, cycle, treat_line FROM n WHERE (bef IS NOT NULL OR rel IS NOT NULL) AND treat_line = pl
UNION ALL SELECT 'line_change_without_response', record_id, cycle, treat_line FROM n WHERE treat_line <> pl AND own IS NOT NULL AND rel IS NOT NULL AND resp NOT IN ('SD', 'PD')
UNION ALL SELECT 'progression_dates_differ', record_id, cycle, treat_line FROM n WHERE nl > treat_line AND own <> nb
UNION ALL SELECT 'deceased_and_lost', record_id, cycle, treat_line FROM n WHERE state = 'F' AND k % 9 = 0
UNION ALL SELECT 'no_line_no_watch', record_id, cycle, treat_line FROM n WHERE treat_line IS NULL AND k % 10 = 0
UNION ALL SELECT 'has_last_progression', record_id, cycle, treat_line FROM n WHERE k % 8 = 0"""
)
def quality_rules(spark, folder):
    sizes = views.patient_sizes(spark, folder)
    r = _rule_rows(spark, folder, sizes)
    out = [quality.sequence_rules(r, sizes=sizes), quality.row_rules(r)]
    return quality.union_by_name([x.select("rule", "record_id", "cycle", "treat_line") for x in out])


@query(
    _RULES
    + "SELECT record_id, cycle, treat_line FROM n WHERE record_id IN (SELECT record_id FROM n WHERE nl > treat_line AND own <> nb)"
)
def line_differences(spark, folder):
    sizes = views.patient_sizes(spark, folder)
    return quality.line_differences(_rule_rows(spark, folder, sizes), sizes=sizes).select("record_id", "cycle", "treat_line")


@query(
    _RULES
    + """, u AS (SELECT record_id, bool_or(pl > treat_line) IS TRUE AS resorted FROM n GROUP BY 1)
SELECT n.record_id, cycle, treat_line, resorted, row_number() OVER (PARTITION BY n.record_id ORDER BY CASE WHEN resorted THEN treat_line END, cycle) AS sort_seq
FROM n JOIN u ON u.record_id = n.record_id"""
)
def resort_unsorted(spark, folder):
    sizes = views.patient_sizes(spark, folder)
    out = quality.resort_unsorted(_rule_rows(spark, folder, sizes), order=["cycle"], sizes=sizes)
    return out.select("record_id", "cycle", "treat_line", "resorted", "sort_seq")


@query("""
SELECT (SELECT count(*) FROM customer) AS ids_before, (SELECT count(DISTINCT o_custkey) FROM orders) AS ids_after,
  (SELECT count(*) FROM customer) = (SELECT count(DISTINCT o_custkey) FROM orders) AS complete
""")
def completeness_check(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("record_id"))
    return completeness(c, table(spark, folder, "orders").select(F.col("o_custkey").alias("record_id")))


# --- descriptive tables -------------------------------------------------------------------------


@query("""
SELECT c_mktsegment AS arm, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band, count(*) AS n,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY c_mktsegment) AS DOUBLE), 6) AS share FROM customer GROUP BY 1, 2
""")
def share_in_group(spark, folder):
    band = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "low").otherwise("high")
    c = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("arm"), band.alias("band"))
    return groups.share_within(c, ["arm"], ["band"]).withColumn("share", F.round("share", 6))


@query(f"WITH {views.STUDY.strip()} SELECT arm, count(*) AS n, count(*) FILTER (WHERE event = 1) AS events FROM study GROUP BY 1")
def arm_counts(spark, folder):
    return groups.arm_counts(views.study(spark, folder), "arm", "event")


@query("""
WITH c AS (SELECT 'c_acctbal' AS variable, c_acctbal AS v FROM customer UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer)
SELECT variable, count(v) AS n, count(*) - count(v) AS n_missing, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.25), 6) AS p25,
  round(quantile_cont(v, 0.75), 6) AS p75 FROM c GROUP BY 1
""")
def summary_continuous(spark, folder):
    out = summary.summary_continuous(table(spark, folder, "customer"), ["c_acctbal", "c_nationkey"])
    return out.withColumns({c: F.round(c, 6) for c in ("median", "p25", "p75")})


@query("""
WITH c AS (SELECT 'p_type' AS variable, p_type AS level FROM part UNION ALL SELECT 'p_brand', p_brand FROM part)
SELECT variable, level, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY variable), 6) AS percent FROM c GROUP BY 1, 2
""")
def summary_categorical(spark, folder):
    return summary.summary_categorical(table(spark, folder, "part"), ["p_type", "p_brand"]).withColumn("percent", F.round("percent", 6))


@query("""
WITH n AS (SELECT printf('%.1f (%.1f, %.1f)', round(quantile_cont(p_retailprice, 0.5), 1), round(quantile_cont(p_retailprice, 0.25), 1), round(quantile_cont(p_retailprice, 0.75), 1)) AS statistic FROM part),
c AS (SELECT p_type AS level, count(*) AS n, count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER () AS p FROM part GROUP BY 1)
SELECT 'p_retailprice' AS variable, CAST(NULL AS VARCHAR) AS level, statistic FROM n
UNION ALL SELECT 'p_type', level, printf('%d (%.1f%%)', n, round(p, 1)) FROM c
""")
def summary_table(spark, folder):
    return summary.summary_table(table(spark, folder, "part"), ["p_retailprice"], ["p_type"])


@query("""
SELECT c_mktsegment AS arm, count(c_acctbal) AS n, round(avg(c_acctbal), 6) AS mean, round(stddev_samp(c_acctbal), 6) AS sd,
  round(quantile_cont(c_acctbal, 0.25), 6) AS p25, round(quantile_cont(c_acctbal, 0.5), 6) AS median, round(quantile_cont(c_acctbal, 0.75), 6) AS p75,
  round(avg(c_acctbal) - 2 * stddev_samp(c_acctbal), 6) AS band_low, round(avg(c_acctbal) + 2 * stddev_samp(c_acctbal), 6) AS band_high
FROM customer GROUP BY 1
""")
def distribution(spark, folder):
    c = table(spark, folder, "customer").withColumnRenamed("c_mktsegment", "arm")
    out = summary.distribution(c, "arm", "c_acctbal")
    return out.withColumns({x: F.round(x, 6) for x in ("mean", "sd", "p25", "median", "p75", "band_low", "band_high")})


@query("SELECT DISTINCT trim(x) AS item FROM (SELECT unnest(string_split(p_type || ', ' || p_name || ',' || p_brand, ',')) AS x FROM part)")
def vocabulary(spark, folder):
    p = table(spark, folder, "part").select(F.concat_ws(",", F.concat_ws(", ", "p_type", "p_name"), "p_brand").alias("drugs"))
    return groups.vocabulary(p, "drugs")


# --- empirical imputation -----------------------------------------------------------------------


def _lag_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a diagnosis date a skewed number of days before the patient's first line."""
    line = views.lines(spark, folder)
    first = line.groupBy("record_id").agg(F.min("start").alias("first"))
    j = line.join(first, "record_id")
    r, k = F.col("record_id"), F.col("order_key")
    lag = F.least((r * 37) % 61, (r * 53) % 97).cast("int")
    diag = F.date_sub("first", lag)
    one = F.col("treat_line") == 1
    no_diag, no_start = r % 5 == 0, one & (r % 5 == 1)
    drugs = F.when(r % 2 == 0, "R-CHOP").otherwise("CHOP")
    return j.select(
        "record_id",
        "treat_line",
        F.col("treat_line").alias("cycle"),
        F.when(~no_diag, diag).alias("diagnosis_date"),
        F.month(diag).alias("diagnosis_date_month"),
        F.year(diag).alias("diagnosis_date_year"),
        F.when(~no_start, F.col("start")).alias("therapy_start_date"),
        F.month("start").alias("therapy_start_date_month"),
        F.year("start").alias("therapy_start_date_year"),
        F.when(k % 3 == 0, F.date_add("start", (F.lit(60) + k % 120).cast("int"))).alias("therapy_end_date"),
        F.month("start").alias("therapy_end_date_month"),
        F.lit(None).cast("int").alias("therapy_end_date_year"),
        F.when(k % 2 == 0, "Planned end").otherwise("Toxicity").alias("drug1_end_reason"),
        drugs.alias("drug_med_all"),
        F.when(r % 7 != 0, F.lit(0.5) + (r % 3) * 0.5).alias("diag_ldh_ratio"),
        F.date_add("start", 400).alias("status_date_15"),
    )


_LAGS = f"""
WITH {views.LINES.strip()},
f AS (SELECT record_id, min(start) AS first FROM lines GROUP BY 1),
j AS (SELECT l.*, first, CAST(least((l.record_id * 37) % 61, (l.record_id * 53) % 97) AS INTEGER) AS lag0 FROM lines l JOIN f ON f.record_id = l.record_id),
x AS (SELECT record_id, record_id % 2 = 0 AS rchop, CASE WHEN record_id % 7 = 0 THEN NULL WHEN 0.5 + (record_id % 3) * 0.5 <= 1 THEN 'low' ELSE 'high' END AS ldh,
  CAST(date_diff('day', first - lag0, start) AS DOUBLE) AS lag FROM j WHERE treat_line = 1 AND record_id % 5 NOT IN (0, 1)),
s AS (SELECT 'all' AS stratum, lag FROM x UNION ALL SELECT CASE WHEN rchop THEN 'rchop_' ELSE 'other_' END || ldh, lag FROM x WHERE ldh IS NOT NULL),
c AS (SELECT stratum, lag, count(*) AS n FROM s WHERE lag >= 0 AND lag < 365 GROUP BY 1, 2)"""


@query(_LAGS + " SELECT stratum, lag, CAST(n AS BIGINT) AS n FROM c")
def lag_counts(spark, folder):
    rows = impute.add_lag_columns(_lag_rows(spark, folder)).where("treat_line = 1")
    return impute.strata_counts(rows).withColumn("n", F.col("n").cast("long"))


@query(
    _LAGS
    + """,
q AS (SELECT stratum, count(*) AS total, stddev_samp(lag) AS sd, quantile_cont(lag, 0.75) - quantile_cont(lag, 0.25) AS iqr
      FROM s WHERE lag >= 0 AND lag < 365 GROUP BY 1),
b AS (SELECT stratum, total, CAST(0.9 AS DOUBLE) * CASE WHEN iqr > 0 THEN least(sd, iqr / CAST(1.34 AS DOUBLE)) ELSE sd END * pow(total, CAST(-0.2 AS DOUBLE)) AS bw FROM q WHERE total >= 5),
g AS (SELECT stratum, bw, total, step, step * (CAST(365 AS DOUBLE) / 2047) AS x FROM b, range(2048) r(step))
SELECT g.stratum, CAST(step AS INTEGER) AS step, round(bw, 6) AS bw, round(x, 6) AS x,
  round(sum(n * exp(CAST(-0.5 AS DOUBLE) * pow((x - lag) / bw, 2))) / (any_value(total) * any_value(bw) * sqrt(2 * pi())), 6) AS y
FROM g JOIN c ON c.stratum = g.stratum GROUP BY g.stratum, step, bw, x"""
)
def lag_density(spark, folder):
    rows = impute.add_lag_columns(_lag_rows(spark, folder)).where("treat_line = 1")
    d = impute.fit_density(impute.strata_counts(rows))
    return d.select("stratum", "step", F.round("bw", 6).alias("bw"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


_M = "CAST(2047 AS DOUBLE) / CAST(365 AS DOUBLE)"


@query(
    _LAGS
    + f""",
q AS (SELECT stratum, count(*) AS total, stddev_samp(lag) AS sd, quantile_cont(lag, 0.75) - quantile_cont(lag, 0.25) AS iqr
      FROM s WHERE lag >= 0 AND lag < 365 GROUP BY 1),
b AS (SELECT stratum, total, CAST(0.9 AS DOUBLE) * CASE WHEN iqr > 0 THEN least(sd, iqr / CAST(1.34 AS DOUBLE)) ELSE sd END * pow(total, CAST(-0.2 AS DOUBLE)) AS bw FROM q WHERE total >= 5),
g AS (SELECT b.stratum, step, sum(n * exp(CAST(-0.5 AS DOUBLE) * pow((step * (CAST(365 AS DOUBLE) / 2047) - lag) / bw, 2))) / (any_value(total) * any_value(bw) * sqrt(2 * pi())) AS y
      FROM b JOIN c ON c.stratum = b.stratum, range(2048) r(step) GROUP BY 1, 2),
cum AS (SELECT stratum, step, sum(y) OVER (PARTITION BY stratum ORDER BY step) AS cum FROM g),
rows_ AS (SELECT record_id, treat_line, first - lag0 AS diag, start, order_key AS k,
    record_id % 5 = 0 AS no_diag, treat_line = 1 AND record_id % 5 = 1 AS no_start, record_id % 2 = 0 AS rchop,
    CASE WHEN order_key % 3 = 0 THEN start + CAST(60 + order_key % 120 AS INTEGER) END AS fin,
    CASE WHEN record_id % 7 = 0 THEN NULL WHEN 0.5 + (record_id % 3) * 0.5 <= 1 THEN 'low' ELSE 'high' END AS ldh FROM j),
k1 AS (SELECT *, CASE WHEN treat_line = 1 AND no_diag THEN 1 WHEN no_start THEN 2 END AS kase,
    coalesce(CASE WHEN rchop THEN 'rchop_' ELSE 'other_' END || ldh, 'all') AS st FROM rows_),
k2 AS (SELECT *, CASE kase WHEN 1 THEN CAST(date_trunc('month', diag) AS DATE) WHEN 2 THEN greatest(CAST(date_trunc('month', start) AS DATE), diag) END AS lo,
    CASE kase WHEN 1 THEN last_day(diag) WHEN 2 THEN least(last_day(start), fin) END AS hi FROM k1),
k3 AS (SELECT *, kase = 2 AND rchop AND k % 2 = 0 AND fin IS NOT NULL AND greatest(lo, fin - 150) <= least(hi, fin - 100) AS narrow FROM k2),
k4 AS (SELECT * EXCLUDE (lo, hi), CASE WHEN narrow THEN greatest(lo, fin - 150) ELSE lo END AS lo, CASE WHEN narrow THEN least(hi, fin - 100) ELSE hi END AS hi,
    CASE WHEN st IN (SELECT stratum FROM b) THEN st ELSE 'all' END AS stratum FROM k3),
k5 AS (SELECT *, greatest(0, CAST(ceil(CASE kase WHEN 1 THEN date_diff('day', hi, start) ELSE date_diff('day', diag, lo) END * ({_M})) AS INTEGER)) AS i,
    least(2047, CAST(floor(CASE kase WHEN 1 THEN date_diff('day', lo, start) ELSE date_diff('day', diag, hi) END * ({_M})) AS INTEGER)) AS jj,
    CAST(CAST('0x' || left(md5(record_id || '|7'), 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS u FROM k4 WHERE kase IS NOT NULL),
k6 AS (SELECT k5.*, coalesce(c0.cum, 0) AS below, c1.cum - coalesce(c0.cum, 0) AS mass FROM k5
    LEFT JOIN cum c0 ON c0.stratum = k5.stratum AND c0.step = i - 1 LEFT JOIN cum c1 ON c1.stratum = k5.stratum AND c1.step = jj AND lo <= hi AND i <= jj),
k7 AS (SELECT *, CASE WHEN kase = 1 AND start > fin THEN 'start_after_end' WHEN lo > hi THEN 'no_feasible_day' WHEN coalesce(mass, 0) <= 0 THEN 'no_density_mass' ELSE 'imputed' END AS imp_status FROM k6),
k8 AS (SELECT k7.record_id, k7.treat_line, any_value(kase) AS kase, any_value(diag) AS diag, any_value(start) AS start, any_value(lo) AS lo, any_value(hi) AS hi, any_value(imp_status) AS imp_status,
    any_value(i) + least(count(cum.step) FILTER (WHERE cum.cum <= below + u * mass), any_value(jj) - any_value(i)) AS place
    FROM k7 LEFT JOIN cum ON cum.stratum = k7.stratum AND cum.step BETWEEN i AND jj AND imp_status = 'imputed' GROUP BY 1, 2),
k9 AS (SELECT record_id, treat_line, kase, imp_status, diag, start, CASE WHEN imp_status = 'imputed' THEN greatest(lo, least(hi, CASE kase WHEN 1 THEN start - CAST(round(place / ({_M})) AS INTEGER)
    ELSE diag + CAST(round(place / ({_M})) AS INTEGER) END)) END AS day FROM k8),
o AS (SELECT r.record_id, r.treat_line, CASE WHEN kase = 1 THEN day WHEN NOT no_diag THEN r.diag END AS d, CASE WHEN kase = 2 THEN day WHEN NOT no_start THEN r.start END AS s,
    CASE WHEN day IS NOT NULL THEN CASE kase WHEN 1 THEN date_diff('day', day, k9.start) ELSE date_diff('day', k9.diag, day) END END AS delta, imp_status
    FROM rows_ r LEFT JOIN k9 ON k9.record_id = r.record_id AND k9.treat_line = r.treat_line),
final AS (SELECT record_id, treat_line, coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY treat_line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(d IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY treat_line ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS d, s, delta, imp_status, start
    FROM o JOIN rows_ USING (record_id, treat_line))
SELECT record_id, treat_line, d AS diagnosis_date_density_imp, s AS therapy_start_date_density_imp, CAST(delta AS INTEGER) AS delta_imp, imp_status,
  round(date_diff('day', d, start + 400) / CAST(30.4375 AS DOUBLE), 6) AS OS_density FROM final"""
)
def impute_empirical(spark, folder):
    out = impute.impute_dates_empirical(_lag_rows(spark, folder), seed=7)
    os = lines.time_between("status_date_15", "diagnosis_date_density_imp")
    return out.select(
        "record_id", "treat_line", "diagnosis_date_density_imp", "therapy_start_date_density_imp", "delta_imp", "imp_status",
        F.round(os, 6).alias("OS_density"),
    )
