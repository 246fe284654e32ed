"""Catalogue of cleaning queries: import, dictionary, text, dates, scores and therapy classes.

Each entry is ``name: (query, checking SQL)``; the SQL is None where none can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.functions import dates as D
from hazardline.functions import dictionary as dic
from hazardline.functions import text as X
from hazardline.operators import fill, groups, scores, therapy
from hazardline.operators.contracts import is_one_of_or_null
from hazardline.operators.scans import measure_keys
from hazardline.plans import bands, views
from hazardline.plans.views import table
from hazardline.session import shared_folder
from hazardline.sources import exports, registry

Q: dict[str, tuple] = {}


def query(sql: str | None):
    def add(fn):
        Q[fn.__name__] = (fn, sql)
        return fn

    return add


# --- import -------------------------------------------------------------------------------------


def _gappy_events(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return e.select(
        F.col("event_id"),
        F.col("user_id").alias("record_id"),
        "ts",
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("v"),
        F.when(F.col("event_id") % 4 == 1, F.col("event_type")).alias("t"),
        F.when(F.col("event_id") % 5 == 2, F.col("value")).alias("b"),
    )


@query("""
WITH e AS (SELECT event_id, user_id AS record_id, ts,
                  CASE WHEN event_id % 3 = 0 THEN value END AS v, CASE WHEN event_id % 4 = 1 THEN event_type END AS t,
                  CASE WHEN event_id % 5 = 2 THEN value END AS b FROM events)
SELECT event_id, record_id, last_value(v IGNORE NULLS) OVER d AS v, first_value(t IGNORE NULLS) OVER u AS t,
       coalesce(last_value(b IGNORE NULLS) OVER d, first_value(b IGNORE NULLS) OVER u) AS b
FROM e WINDOW d AS (PARTITION BY record_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
              u AS (PARTITION BY record_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
""")
def fill_down_up(spark, folder):
    e = _gappy_events(spark, folder)
    order = ["ts", "event_id"]
    sizes = measure_keys(e.select("record_id"), ["record_id"])
    once = fill.fill(e, down=["v"], up=["t"], order=order, sizes=sizes)
    return fill.fill_both_ways(once, ["b"], order=order, sizes=sizes).select("event_id", "record_id", "v", "t", "b")


@query("""
SELECT user_id AS record_id, arg_min(value, (ts, event_id)) FILTER (WHERE event_id % 5 = 2) AS b FROM events GROUP BY 1
""")
def first_value_per_patient(spark, folder):
    return fill.first_after_fill(_gappy_events(spark, folder), "record_id", "b", ["ts", "event_id"])


def _wide_events(spark: SparkSession, folder: str) -> DataFrame:
    """A wide export: patient fields on sign-up rows only, some ids that are not numbers."""
    e = table(spark, folder, "events")
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    return e.select(
        F.when(F.col("user_id") % 10 == 7, F.concat(F.lit("T"), user)).otherwise(user).alias("record_id"),
        F.col("event_id").alias("row_seq"),
        F.when(kind == "click", "medical_treatment")
        .when(kind == "view", "medical_treatment")
        .when(kind == "purchase", "survival_status")
        .when(kind == "error", "other")
        .alias("redcap_repeat_instrument"),
        F.when(kind != "signup", F.col("event_id")).alias("redcap_repeat_instance"),
        F.when((kind == "signup") & (F.col("event_id") % 7 < 5), F.when(F.col("user_id") % 3 == 0, "fl").otherwise("dlbcl"))
        .alias("diagnosis"),
        F.when(kind == "purchase", F.col("value")).alias("date_of_update"),
    )


@query("""
WITH w AS (
  SELECT CASE WHEN user_id % 10 = 7 THEN 'T' || user_id ELSE CAST(user_id AS VARCHAR) END AS record_id,
         event_id AS row_seq,
         CASE event_type WHEN 'click' THEN 'medical_treatment' WHEN 'view' THEN 'medical_treatment'
              WHEN 'purchase' THEN 'survival_status' WHEN 'error' THEN 'other' END AS instrument,
         CASE WHEN event_type <> 'signup' THEN event_id END AS instance,
         CASE WHEN event_type = 'signup' AND event_id % 7 < 5
              THEN CASE WHEN user_id % 3 = 0 THEN 'fl' ELSE 'dlbcl' END END AS diagnosis,
         CASE WHEN event_type = 'purchase' THEN value END AS updated FROM events),
f AS (SELECT record_id, row_seq, instrument, instance, last_value(diagnosis IGNORE NULLS) OVER d AS diagnosis,
             first_value(updated IGNORE NULLS) OVER u AS updated
      FROM w WINDOW d AS (PARTITION BY record_id ORDER BY row_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    u AS (PARTITION BY record_id ORDER BY row_seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
c AS (SELECT * FROM f WHERE diagnosis = 'dlbcl' AND regexp_matches(record_id, '^\\d+$')),
base AS (SELECT * FROM c WHERE instance IS NULL)
SELECT 'base' AS part, record_id, row_seq, CAST(record_id AS DOUBLE) AS record_id_num, updated FROM base
UNION ALL SELECT 'thx', record_id, row_seq, CAST(record_id AS DOUBLE), updated FROM c
  WHERE instrument = 'medical_treatment' AND record_id IN (SELECT record_id FROM base)
UNION ALL SELECT 'sv', record_id, row_seq, CAST(record_id AS DOUBLE), updated FROM c
  WHERE instrument = 'survival_status' AND record_id IN (SELECT record_id FROM base)
""")
def split_cohort(spark, folder):
    parts = fill.split_registry(
        _wide_events(spark, folder), F.col("diagnosis") == "dlbcl", down=["diagnosis"], up=["date_of_update"]
    )
    out = [
        df.select(F.lit(n).alias("part"), "record_id", "row_seq", "record_id_num", F.col("date_of_update").alias("updated"))
        for n, df in parts.items()
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("""
SELECT 'without' AS part, c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)
UNION ALL SELECT 'with', c_custkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events)
UNION ALL SELECT 'listed', event_id FROM events
  WHERE event_id % 6 = 0 OR event_type IN ('click', 'view')
UNION ALL SELECT 'starts', user_id FROM (SELECT DISTINCT user_id FROM events) WHERE CAST(user_id AS VARCHAR) LIKE '1%'
""")
def semi_anti_filters(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    events = table(spark, folder, "events")
    users = events.select(F.col("user_id").alias("id")).distinct()
    kind = F.when(F.col("event_id") % 6 != 0, F.col("event_type"))
    listed = events.withColumn("kind", kind).where(is_one_of_or_null("kind", ["click", "view"]))

    def tag(df: DataFrame, name: str, c: str = "id") -> DataFrame:
        return df.select(F.lit(name).alias("part"), F.col(c).alias("id"))

    return (
        tag(customers.join(users, "id", "left_anti"), "without")
        .unionByName(tag(customers.join(users, "id", "left_semi"), "with"))
        .unionByName(tag(listed, "listed", "event_id"))
        .unionByName(tag(users.where(F.col("id").cast("string").rlike("^1")), "starts"))
    )


@query("""
SELECT o_custkey AS record_id, o_orderkey, o_orderdate, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
""")
def latest_per_key(spark, folder):
    o = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("record_id"), "o_orderkey", "o_orderdate", "o_orderstatus"
    )
    return fill.latest_per_key(o, by="o_orderdate", tie=["o_orderkey"])


@query("SELECT record_id, dense_rank() OVER (ORDER BY record_id) AS pat_id FROM (SELECT DISTINCT o_custkey AS record_id FROM orders)")
def rank_ids(spark, folder):
    return fill.rank_ids(table(spark, folder, "orders").select(F.col("o_custkey").alias("record_id")))


@query("""
SELECT id, dense_rank() OVER (ORDER BY id) AS pat_id FROM (SELECT DISTINCT l_returnflag || '-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id FROM lineitem)
""")
def rank_text_ids(spark, folder):
    """Ranks of text ids, cut into pieces at any scale: the pieces are made small."""
    i = table(spark, folder, "lineitem")
    ids = i.select(F.concat_ws("-", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey").alias("id"))
    return fill.rank_ids(ids, "id", floor=5_000)


@query("""
WITH e AS (SELECT l_orderkey, l_linenumber, l_returnflag AS key, l_linestatus || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS stamp, l_partkey, l_suppkey,
                  CASE WHEN l_orderkey % 5 = 0 THEN l_partkey END AS v, CASE WHEN l_orderkey % 7 = 0 THEN l_suppkey END AS t
           FROM lineitem)
SELECT l_orderkey, l_linenumber, last_value(v IGNORE NULLS) OVER d AS v, first_value(t IGNORE NULLS) OVER u AS t
FROM e WINDOW d AS (PARTITION BY key ORDER BY stamp, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
              u AS (PARTITION BY key ORDER BY stamp, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
""")
def fill_text_order(spark, folder):
    """Few large keys in the order of a text with few values, cut into pieces at any scale: the pieces are made small."""
    i = table(spark, folder, "lineitem")
    e = i.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_returnflag").alias("record_id"),
        F.concat("l_linestatus", F.col("l_shipdate").cast("date").cast("string")).alias("stamp"),
        F.when(F.col("l_orderkey") % 5 == 0, F.col("l_partkey")).alias("v"),
        F.when(F.col("l_orderkey") % 7 == 0, F.col("l_suppkey")).alias("t"),
    )
    out = fill.fill(e, down=["v"], up=["t"], order=["stamp", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], floor=2_000)
    return out.select("l_orderkey", "l_linenumber", "v", "t")


@query("""
SELECT c_custkey AS record_id,
       translate(left(to_base64(unhex(sha256('s1' || c_custkey))), 12), '+/', '-_') AS record_id_new FROM customer
""")
def pseudonymise(spark, folder):
    c = table(spark, folder, "customer").select(F.col("c_custkey").alias("record_id"))
    return registry.id_mapping(registry.pseudonymise(c, "s1"))


@query("""
SELECT c_custkey AS record_id, c_name AS name, round(c_acctbal, 2) AS hemoglobine, c_mktsegment AS arm FROM customer
""")
def roundtrip_io(spark, folder):
    """Save with the dated and latest copies, then read the registry CSV and the latest table back."""
    c = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("record_id"),
        F.col("c_name").alias("name"),
        F.round("c_acctbal", 2).alias("hemoglobine"),
        F.col("c_mktsegment").alias("arm"),
    )
    where = shared_folder(spark, "io")
    paths = exports.save_cleaned(c, "patients", where)
    back = registry.read_registry(spark, paths["csv"], as_text=["hemoglobine"])
    typed = X.clean_markers(back, ["hemoglobine"]).select("record_id", "hemoglobine")
    latest = exports.read_latest(spark, where)["patients"].select("record_id", "name", "arm")
    return latest.join(typed.withColumn("record_id", F.col("record_id").cast("long")), "record_id").select(
        "record_id", "name", "hemoglobine", "arm"
    )


# --- dictionary and text ------------------------------------------------------------------------


def _dictionary(spark: SparkSession, folder: str) -> DataFrame:
    n = table(spark, folder, "nation")
    text = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("n_nationkey", F.concat_ws(", ", F.col("n_nationkey").cast("string"), "n_name").alias("t")))),
            lambda x: x["t"],
        ),
        " | ",
    )
    one = n.agg(text.alias(dic.CHOICES)).select(F.lit("nation").alias(dic.FIELD), F.lit("<b>Nation</b>").alias(dic.LABEL), dic.CHOICES)
    segments = spark.createDataFrame(
        [("segment", "Segment", "AUTOMOBILE, Cars, vans | BUILDING, Houses |MACHINERY,Machines", 1), ("segment", "Again", "AUTOMOBILE, A second row", 2)],
        f"{dic.FIELD} string, {dic.LABEL} string, {dic.CHOICES} string, row_seq int",
    )
    return one.withColumn("row_seq", F.lit(0)).unionByName(segments)


@query("""
SELECT c_custkey AS record_id,
       CASE WHEN c_custkey % 17 = 0 THEN 'Not done' ELSE n_name END AS nation,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Cars, vans' WHEN 'BUILDING' THEN 'Houses' WHEN 'MACHINERY' THEN 'Machines' END AS segment
FROM customer LEFT JOIN nation ON n_nationkey = CASE WHEN c_custkey % 19 = 0 THEN c_nationkey + 100 ELSE c_nationkey END
""")
def decode_dictionary(spark, folder):
    c = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("record_id"),
        F.when(F.col("c_custkey") % 17 == 0, "nd")
        .when(F.col("c_custkey") % 19 == 0, (F.col("c_nationkey") + 100).cast("string"))  # a code that no field lists
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    return dic.decode(c, _dictionary(spark, folder), ["nation", "segment"])


@query("""
SELECT page_id, CAST(length(regexp_replace(html, '<[^>]+>', '', 'g')) AS INTEGER) AS n_chars,
       md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS digest FROM pages
""")
def label_catalog(spark, folder):
    clean = dic.clean_html("html")
    return table(spark, folder, "pages").select("page_id", F.length(clean).alias("n_chars"), F.md5(clean).alias("digest"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN NULL ELSE nullif(p_retailprice, 999) END AS albumin,
       CASE WHEN p_size = 49 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS crp FROM part
""")
def numeric_clean(spark, folder):
    price = F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(","))
    p = table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 13 == 0, "999,0").when(F.col("p_partkey") % 11 == 0, "n/a").otherwise(price).alias("albumin"),
        F.when(F.col("p_size") == 49, "999").otherwise(F.col("p_size").cast("string")).alias("crp"),
    )
    return X.clean_markers(p, ["albumin", "crp"])


@query("""
WITH items AS (SELECT l_orderkey AS order_key, lower(p_type) || ', ' || p_brand || ',' || p_type AS drugs, p_name AS name
               FROM lineitem JOIN part ON p_partkey = l_partkey),
one AS (SELECT order_key, list_distinct(list(trim(x))) AS xs FROM (SELECT order_key, unnest(regexp_split_to_array(drugs, ',\\s*')) AS x FROM items) GROUP BY 1),
two AS (SELECT order_key, list_distinct(list(name)) AS xs FROM items GROUP BY 1)
SELECT one.order_key, array_to_string(list_sort(one.xs), ', ') AS drugs_line, array_to_string(list_sort(two.xs), ', ') AS name_line
FROM one JOIN two ON one.order_key = two.order_key
""")
def text_lists(spark, folder):
    items = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_key"), F.col("l_partkey").alias("p_partkey"))
    parts = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lower("p_type"), F.lit(", "), F.col("p_brand"), F.lit(","), F.col("p_type")).alias("drugs"),
        F.col("p_name").alias("name"),
    )
    return groups.line_union_text(items.join(parts, "p_partkey"), ["order_key"], ["drugs", "name"])


@query("""
WITH p AS (SELECT p_partkey, lower(p_type) || ', ' || p_name || ',' || lower(p_type) AS x FROM part),
s AS (SELECT p_partkey, x, [upper(left(w, 1)) || substr(w, 2) FOR w IN regexp_split_to_array(x, ',\\s*')] AS ws,
             list_sort(list_distinct([trim(w) FOR w IN regexp_split_to_array(x, ',\\s*')])) AS us FROM p)
SELECT p_partkey, array_to_string(ws, ', ') AS capitals, array_to_string(us, ', ') AS sorted, upper(x) AS big FROM s
""")
def list_words(spark, folder):
    x = F.concat(F.lower("p_type"), F.lit(", "), F.col("p_name"), F.lit(","), F.lower("p_type"))
    return table(spark, folder, "part").select(
        "p_partkey",
        X.capitalize_words(x).alias("capitals"),
        X.sort_unique_values(x).alias("sorted"),
        F.upper(x).alias("big"),
    )


@query("""
WITH p AS (SELECT *, p_name || ' (' || p_brand || ') x' AS y,
  concat_ws(', ', CASE WHEN p_size > 10 THEN p_name END, CASE WHEN p_size % 2 = 0 THEN 'other' END,
            CASE WHEN p_size % 3 = 0 THEN 'Other' END, CASE WHEN p_size % 5 = 0 THEN p_type END) AS u FROM part)
SELECT p_partkey, u AS united, regexp_replace(y, '\\s*\\(.*$', '') AS short,
       replace(replace(replace(replace(u, 'other, ', ''), 'Other, ', ''), ', other', ''), ', Other ', '') AS listed,
       regexp_replace(p_name || ' myocet Myocet', 'myocet|Myocet', 'Non-pegylated liposomalem Doxorubicin') AS generic,
       nullif(u, '') AS filled, trim(regexp_replace('  ' || p_name || '   ' || p_type || ' ', '\\s+', ' ', 'g')) AS squished,
       CASE WHEN p_size % 4 = 0 AND p_size % 8 <> 0 THEN 'Other - ' || p_name WHEN p_size % 4 = 0 THEN 'Other' ELSE p_type END AS kind,
       CASE WHEN p_size % 8 <> 0 THEN 'Other1 - ' || p_name END AS site
FROM p
""")
def unite_other(spark, folder):
    size = F.col("p_size")
    u = X.unite(
        [F.when(size > 10, F.col("p_name")), F.when(size % 2 == 0, "other"), F.when(size % 3 == 0, "Other"), F.when(size % 5 == 0, F.col("p_type"))]
    )
    free = F.when(size % 8 != 0, F.col("p_name"))
    kind = F.when(size % 4 == 0, "Other").otherwise(F.col("p_type"))
    return table(spark, folder, "part").select(
        "p_partkey",
        u.alias("united"),
        X.drop_parenthesis(F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(") x"))).alias("short"),
        X.drop_other(u).alias("listed"),
        X.replace_first(F.concat(F.col("p_name"), F.lit(" myocet Myocet")), X.BRAND_PATTERN, X.BRAND_GENERIC).alias("generic"),
        X.empty_to_null(u).alias("filled"),
        X.squish(F.concat(F.lit("  "), F.col("p_name"), F.lit("   "), F.col("p_type"), F.lit(" "))).alias("squished"),
        X.other_with_text(kind, free).alias("kind"),
        X.prefixed(free, "Other1 - ").alias("site"),
    )


_DRUGS = [
    "Cladribin", "Fludarabin, Ifosfamid", "Ibrutinib/Placebo", "Interferon alpha", "Interferon", "Interleukin 2, Pixantron",
    "Oxiplatin and Vincristin", "R-BENDAMUSTIN", "OBI-BENDAMUSTIN", "R-LENALIDOMID", "lenalidomid", "Methotrexat, Thiothepa",
    "Pixatrone", "Procarbazin", "Mitoxantron", "Revlimid", "POLA-R-CMP", "non-pegylated liposomalem Doxorubicin", "Rituximab",
]


def _drug_array():
    return F.get(F.array(*[F.lit(d) for d in _DRUGS]), (F.col("p_partkey") % len(_DRUGS)).cast("int"))


_SQL_DRUG = f"list_extract({_DRUGS!r}, CAST(p_partkey % {len(_DRUGS)} AS INTEGER) + 1)"


def _sql_spelling(x: str) -> str:
    for wrong, right in X.SPELLING.items():
        x = f"regexp_replace({x}, '\\b{wrong}\\b', '{right}', 'g')"
    return x


def _sql_regimen(x: str) -> str:
    for wrong, right in X.REGIMEN_SYNONYMS.items():
        x = f"regexp_replace({x}, '{wrong}', '{right}', 'gi')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


@query(f"""
WITH p AS (SELECT p_partkey, {_SQL_DRUG} || ', ' || p_name AS drug FROM part)
SELECT p_partkey, {_sql_spelling('drug')} AS spelled, {_sql_regimen('drug')} AS regimen FROM p
""")
def fix_spelling(spark, folder):
    drug = F.concat(_drug_array(), F.lit(", "), F.col("p_name"))
    return table(spark, folder, "part").select(
        "p_partkey", X.fix_spelling(drug).alias("spelled"), X.normalise_regimen(drug).alias("regimen")
    )


@query("""
WITH x AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS cns, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS per FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN cns = 1 THEN 'Radiotherapy' END AS radio,
       CASE WHEN cns = 1 AND per = 1 THEN 'CNS, Periphery' WHEN cns = 1 THEN 'CNS' WHEN per = 1 THEN 'Periphery' END AS kind,
       CASE WHEN l_linenumber BETWEEN 0 AND 4 THEN 'Grade ' || l_linenumber END AS ecog,
       concat_ws(', ', CASE WHEN cns = 1 THEN 'Central nervous system' END, CASE WHEN per = 1 THEN 'Lung' END,
                 CASE WHEN l_linenumber = 1 THEN 'Soft tissue' END) AS sites
FROM x
""")
def onehot_labels(spark, folder):
    x = table(spark, folder, "lineitem").withColumns(
        {
            "site___cns": (F.col("l_returnflag") == "R").cast("int"),
            "site___lung": (F.col("l_linestatus") == "F").cast("int"),
            "site___soft": (F.col("l_linenumber") == 1).cast("int"),
        }
    )
    return x.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        X.checkbox_text("site___cns", "Radiotherapy").alias("radio"),
        X.two_site_label("site___cns", "site___lung").alias("kind"),
        X.grade_label("l_linenumber").alias("ecog"),
        X.unite([X.onehot_label(c) for c in ("site___cns", "site___lung", "site___soft")]).alias("sites"),
    )


@query("""
WITH x AS (SELECT c_custkey, c_acctbal / 200 AS bmi, c_nationkey AS k, CAST(c_custkey % 5 AS INTEGER) AS m FROM customer)
SELECT c_custkey, CASE WHEN bmi < 18.5 THEN '<18.5' WHEN bmi >= 18.5 AND bmi <= 24.9 THEN '18.5-24.9'
         WHEN bmi >= 25 AND bmi <= 29.9 THEN '25-29.9' WHEN bmi >= 30 THEN '>=30' END AS bmi_band,
       CASE WHEN k < 20 THEN '<20' ELSE '>=20' END AS ki67,
       CASE WHEN k IN (0, 1, 2) THEN '1' WHEN k = 3 THEN '2-3' WHEN k IN (4, 5, 6) THEN '>3' END AS sites,
       CASE WHEN m IN (0, 2) THEN 0 WHEN m = 1 THEN 1 WHEN m = 3 THEN 2 END AS line1,
       CASE WHEN m = 1 THEN 'de_novo' WHEN m = 0 AND k % 3 = 0 THEN 'DFI_<=24' WHEN m = 0 AND k % 3 = 1 THEN 'DFI_>24' END AS dfi,
       CASE WHEN m IN (0, 1) THEN 'pre_peri' WHEN m = 2 THEN 'post' WHEN m = 3 THEN 'unknown' END AS menopause,
       CASE m WHEN 3 THEN 'CR' WHEN 2 THEN 'PR' WHEN 1 THEN 'SD' WHEN 4 THEN 'PD' ELSE '0' END AS response,
       CASE m WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END AS arm,
       CASE m WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE NULL END AS arm_place
FROM x
""")
def recode_bands(spark, folder):
    x = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 200).alias("bmi"), F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 5).cast("int").alias("m")
    )
    arm = X.factor("m", [0, 1], bands.NO_YES)
    return x.select(
        "c_custkey",
        bands.bmi_band("bmi").alias("bmi_band"),
        bands.ki67_band("k").alias("ki67"),
        bands.site_band("k").alias("sites"),
        bands.first_line_group("m").alias("line1"),
        bands.dfi_group("m", F.col("k") % 3).alias("dfi"),
        bands.menopause("m").alias("menopause"),
        X.recode(F.col("m").cast("string"), therapy.RESPONSE_CODES, keep_rest=True).alias("response"),
        arm.alias("arm"),
        X.level_index(arm, bands.NO_YES).cast("int").alias("arm_place"),
    )


# --- dates --------------------------------------------------------------------------------------


def _partial_orders(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders")
    d, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(key % 3 != 0, d).alias("x"),
        F.when(key % 7 != 0, F.month(d)).alias("x_month"),
        F.year(d).alias("x_year"),
        (key % 5 != 0).alias("ok"),
    )


_SQL_PARTIAL = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS x,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(month(o_orderdate) AS INTEGER) END AS m, CAST(year(o_orderdate) AS INTEGER) AS y,
  o_orderkey % 5 <> 0 AS ok FROM orders),
t AS (SELECT *, CASE WHEN x IS NOT NULL THEN strftime(x, '%d/%m/%Y') WHEN m IS NOT NULL THEN 'nk/' || m || '/' || y END AS txt FROM o)"""


@query(
    _SQL_PARTIAL
    + """
SELECT o_orderkey, CASE WHEN ok THEN txt END AS x, CASE WHEN ok THEN txt LIKE 'nk/%' END AS x_imputed_day,
       CASE WHEN ok AND x IS NULL AND m IS NOT NULL THEN make_date(y, m, 1) WHEN ok THEN x END AS x_01,
       CASE WHEN ok AND x IS NULL AND m IS NOT NULL THEN make_date(y, m, 15) WHEN ok THEN x END AS x_15,
       CASE WHEN ok AND x IS NULL AND m IS NOT NULL THEN make_date(y, m, 28) WHEN ok THEN x END AS x_28
FROM t"""
)
def partial_dates(spark, folder):
    out = D.impute_dates(_partial_orders(spark, folder), {"x": F.col("ok")})
    return out.select("o_orderkey", "x", "x_imputed_day", "x_01", "x_15", "x_28")


@query(
    _SQL_PARTIAL
    + """,
r AS (SELECT *, CASE WHEN ok THEN CASE WHEN x IS NOT NULL THEN CAST(x AS VARCHAR) WHEN m IS NOT NULL THEN 'nk/' || m || '/' || y END END AS x_raw FROM t)
SELECT o_orderkey, x_raw, txt AS x,
       CAST(CASE WHEN x_raw LIKE 'nk/%' THEN make_date(y, m, 15) END AS DATE) AS x_raw_imputed_15 FROM r"""
)
def raw_dates(spark, folder):
    raw = D.raw_date(_partial_orders(spark, folder), "x", "x_month", "x_year", F.col("ok"))
    return D.reformat_dates(D.impute_missing_day(raw, "x_raw"), ["x"]).select("o_orderkey", "x_raw", "x", "x_raw_imputed_15")


@query("""
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderkey % 8 AS INTEGER) AS k FROM orders),
t AS (SELECT *, CASE k WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%d-%m-%Y') WHEN 2 THEN strftime(d, '%d/%m/%Y')
  WHEN 3 THEN strftime(d, ' %d.%m.%Y') WHEN 4 THEN strftime(d, '%Y/%m/%d') WHEN 5 THEN 'N/A' WHEN 6 THEN 'nk/' || month(d) || '/' || year(d)
  ELSE 'soon' END AS txt FROM o)
SELECT o_orderkey, CASE WHEN k <= 4 THEN d END AS parsed,
       CASE WHEN k IN (0, 2) THEN d WHEN k = 6 THEN make_date(CAST(year(d) AS INTEGER), CAST(month(d) AS INTEGER), 28) END AS imputed,
       CASE WHEN k = 7 THEN NULL WHEN k % 2 = 0 THEN d ELSE d END AS serial FROM t
""")
def parse_mixed_dates(spark, folder):
    o = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("d"), (F.col("o_orderkey") % 8).cast("int").alias("k")
    )
    k = F.col("k")
    text = F.when(k == 5, "N/A").when(k == 6, F.concat(F.lit("nk/"), F.month("d"), F.lit("/"), F.year("d"))).when(k == 7, "soon")
    for i, f in enumerate(["yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy", " dd.MM.yyyy", "yyyy/MM/dd"]):
        text = text.when(k == i, F.date_format("d", f))
    serial = F.datediff("d", F.lit(D.SERIAL_ORIGIN).cast("date")).cast("string")
    mixed = F.when(k == 7, "soon").when(k % 2 == 0, serial).otherwise(F.date_format("d", "dd.MM.yyyy"))
    return o.select(
        "o_orderkey",
        D.parse_partial_date(text).alias("parsed"),
        D.parse_imputed_date(text, "28").alias("imputed"),
        D.mixed_serial_date(mixed).alias("serial"),
    )


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS days,
       round(date_diff('day', o_orderdate, l_shipdate) / CAST(30.4375 AS DOUBLE), 6) AS months,
       round(date_diff('day', o_orderdate, l_shipdate) / CAST(365.25 AS DOUBLE), 6) AS years,
       round(date_diff('day', o_orderdate, l_shipdate) * (CAST(12 AS DOUBLE) / CAST(365.25 AS DOUBLE)), 6) AS scaled
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def time_between_units(spark, folder):
    j = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    def span(unit: str):
        return D.time_between("l_shipdate", "o_orderdate", unit)

    return j.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        span("days").alias("days"),
        F.round(span("months"), 6).alias("months"),
        F.round(span("years"), 6).alias("years"),
        F.round(span("days") * D.time_scale("d_m"), 6).alias("scaled"),
    )


@query("""
WITH j AS (SELECT *, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 90 AS INTEGER) AS diag,
  CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) END AS fin FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  coalesce(fin, CAST(date_trunc('month', l_shipdate) AS DATE)) AS end_eff,
  diag <= start AND start <= coalesce(fin, CAST(date_trunc('month', l_shipdate) AS DATE)) AS in_order,
  month(start) = month(diag) AND year(start) = year(diag) AS same_month,
  CAST(day(last_day(start)) AS INTEGER) AS n_days, CAST(year(start) - year(diag) + 40 AS INTEGER) AS age
FROM j
""")
def date_rules(spark, folder):
    j = table(spark, folder, "lineitem").join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    start = F.col("o_orderdate").cast("date")
    diag = F.date_sub(start, (F.col("o_orderkey") % 90).cast("int"))
    ship = F.col("l_shipdate").cast("date")
    fin = F.when(F.col("l_linenumber") % 2 == 0, ship)
    end = D.effective_end(fin, F.month(ship), F.year(ship))
    born = F.add_months(diag, F.lit(-480))
    return j.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        end.alias("end_eff"),
        D.dates_in_order(diag, start, end).alias("in_order"),
        D.in_month_year(start, F.month(diag), F.year(diag)).alias("same_month"),
        F.size(D.month_days(F.year(start), F.month(start))).alias("n_days"),
        D.age_at(start, F.year(start), born).alias("age"),
    )


# --- scores -------------------------------------------------------------------------------------


def _score_base(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        k.alias("record_id"),
        F.when(k % 23 != 0, (k % 80 + 18).cast("int")).alias("diagnosis_age"),
        F.when(k % 6 < 5, ((k % 6).cast("string"))).otherwise("nd").alias("diag_stage"),
        F.when(k % 7 < 5, ((k % 7).cast("string"))).otherwise("na").alias("diag_ecog"),
        F.when(k % 4 != 0, F.col("c_acctbal")).alias("diag_ldh_diag"),
        F.when(k % 5 != 0, F.lit(3000.0)).alias("diag_ldh_baseline"),
        F.when(k % 3 == 0, F.when(k % 2 == 0, "yes").otherwise("no")).alias("diag_ldh_elevated_y_n"),
        F.when(k % 9 != 0, F.col("c_acctbal") / 2500).alias("diag_ldh_ratio"),
        (k % 2).cast("int").alias("diag_extranodal_site___adrenal"),
        F.when(k % 31 != 0, (k % 3 == 1).cast("int")).alias("diag_extranodal_site___kidney"),
        F.when(k % 8 == 0, "skin").alias("diag_extranodal_site_other"),
        F.when(k % 16 == 0, "eye").alias("diag_extranodal_site_other_2"),
        F.lit(None).cast("string").alias("diag_extranodal_site_other_3"),
    )


def _sql_labels(column: str, bands_: dict[int, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {n} THEN '{b} score: {n}'" for n, b in bands_.items()) + " END"


_SCORES = """
WITH b AS (SELECT c_custkey AS record_id, c_custkey AS k, c_acctbal AS bal,
  CASE WHEN c_custkey % 23 <> 0 THEN c_custkey % 80 + 18 END AS age, c_custkey % 6 AS st, c_custkey % 7 AS ec,
  CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS ldh, CASE WHEN c_custkey % 5 <> 0 THEN CAST(3000 AS DOUBLE) END AS norm,
  CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END END AS el,
  CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal / 2500 END AS ratio,
  c_custkey % 2 AS adr, CASE WHEN c_custkey % 31 <> 0 THEN CASE WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END END AS kid FROM customer),
p AS (SELECT *, CASE WHEN age > 60 THEN 1 WHEN age <= 60 THEN 0 END AS i_age,
  CASE WHEN st IN (3, 4) THEN 1 WHEN st IN (1, 2) THEN 0 END AS i_stage,
  CASE WHEN ec IN (2, 3, 4) THEN 1 WHEN ec IN (0, 1) THEN 0 END AS i_ecog,
  CASE WHEN ldh > norm OR el = 'yes' OR ratio > 1 THEN 1
       WHEN (ldh IS NOT NULL AND norm IS NOT NULL) OR el IS NOT NULL OR ratio IS NOT NULL THEN 0 END AS i_ldh,
  CASE WHEN ldh IS NOT NULL OR norm IS NOT NULL OR el = 'yes' OR ratio > 1 THEN 1 ELSE 0 END AS i_ldh_literal,
  adr + kid + CASE WHEN k % 8 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 16 = 0 THEN 1 ELSE 0 END AS site_n,
  CASE WHEN adr = 1 OR kid = 1 THEN 1 WHEN kid IS NULL THEN NULL ELSE 0 END AS i_cns,
  CASE WHEN age <= 40 THEN 0 WHEN age <= 60 THEN 1 WHEN age <= 75 THEN 2 WHEN age > 75 THEN 3 END AS n_age,
  CASE WHEN ratio > 1 AND ratio <= 3 THEN 1 WHEN ratio > 3 THEN 2 WHEN ratio IS NOT NULL THEN 0 END AS n_ldh FROM b),
s AS (SELECT *, CASE WHEN site_n > 1 THEN 1 WHEN site_n <= 1 THEN 0 END AS i_site FROM p),
n AS (SELECT *, i_age + i_stage + i_ecog + i_ldh + i_site AS ipi, i_stage + i_ecog + i_ldh AS aa,
  i_age + i_stage + i_ecog + i_ldh + i_site + i_cns AS cns, n_age + i_stage + i_ecog + n_ldh + i_site AS nccn FROM s)
"""


@query(
    _SCORES
    + f"""SELECT record_id, CAST(ipi AS INTEGER) AS diag_ipi_n, CAST(aa AS INTEGER) AS diag_ipi_n_aa, CAST(cns AS INTEGER) AS diag_ipi_n_cns,
  CAST(nccn AS INTEGER) AS diag_nccn_n, {_sql_labels('ipi', scores.STANDARD)} AS diag_ipi_score_standard,
  {_sql_labels('ipi', scores.REVISED)} AS diag_ipi_score_revised, {_sql_labels('aa', scores.AGE_ADJUSTED)} AS diag_ipi_score_aa,
  {_sql_labels('cns', scores.CNS)} AS diag_ipi_score_cns, {_sql_labels('nccn', scores.NCCN)} AS diag_nccn_score FROM n"""
)
def score_components(spark, folder):
    s = scores.scores(scores.score_components(_score_base(spark, folder)))
    return s.select(
        "record_id", "diag_ipi_n", "diag_ipi_n_aa", "diag_ipi_n_cns", "diag_nccn_n", "diag_ipi_score_standard",
        "diag_ipi_score_revised", "diag_ipi_score_aa", "diag_ipi_score_cns", "diag_nccn_score",
    )


@query(_SCORES + "SELECT record_id, CAST(i_ldh AS INTEGER) AS intended, CAST(i_ldh_literal AS INTEGER) AS literal FROM n")
def ldh_rules(spark, folder):
    b = _score_base(spark, folder)
    return b.select("record_id", scores.ldh_point("intended").alias("intended"), scores.ldh_point("literal").alias("literal"))


@query("""
WITH o AS (SELECT o_custkey, count(*) AS areas FROM orders GROUP BY 1),
p AS (SELECT c_custkey AS record_id, c_custkey % 80 + 18 AS age, c_custkey % 4 + 1 AS stage, c_acctbal / 500 AS hb, c_custkey % 3 = 0 AS ldh,
  areas, c_custkey % 12 AS cm, c_custkey % 5 = 0 AS b2m, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 2 = 0 END AS marrow
  FROM customer LEFT JOIN o ON o_custkey = c_custkey),
n AS (SELECT *, CAST(age > 60 AS INTEGER) + CAST(stage >= 3 AS INTEGER) + CAST(hb < 12 AS INTEGER) + CAST(ldh AS INTEGER) + CAST(areas > 10 AS INTEGER) AS f1,
  CAST(age > 60 AS INTEGER) + CAST(cm > 6 AS INTEGER) + CAST(hb < 12 AS INTEGER) + CAST(b2m AS INTEGER) + CAST(marrow AS INTEGER) AS f2 FROM p)
SELECT record_id, f1 AS diag_flipi_n, f2 AS diag_flipi2_n, CAST(age > 60 AS INTEGER) AS diag_flipi_age, CAST(stage >= 3 AS INTEGER) AS diag_flipi_stage,
  CAST(hb < 12 AS INTEGER) AS diag_flipi_hemo, CAST(ldh AS INTEGER) AS diag_flipi_ldh, CAST(areas > 10 AS INTEGER) AS diag_flipi_site,
  CAST(cm > 6 AS INTEGER) AS diag_flipi2_node, CAST(b2m AS INTEGER) AS diag_flipi_b2mg, CAST(marrow AS INTEGER) AS diag_flipi2_marrow,
  CASE WHEN f1 <= 1 THEN 'Low' WHEN f1 = 2 THEN 'Intermediate' WHEN f1 >= 3 THEN 'High' END AS diag_flipi_risk_grade,
  CASE WHEN f2 = 0 THEN 'Low' WHEN f2 <= 2 THEN 'Intermediate' WHEN f2 >= 3 THEN 'High' END AS diag_flipi2_risk_grade FROM n
""")
def flipi(spark, folder):
    areas = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("areas"))
    c = table(spark, folder, "customer").join(areas, "c_custkey", "left").withColumnRenamed("c_custkey", "record_id")
    k = F.col("record_id")
    out = scores.flipi(
        c,
        age=k % 80 + 18,
        stage=k % 4 + 1,
        hemoglobin=F.col("c_acctbal") / 500,
        ldh_elevated=k % 3 == 0,
        nodal_areas=F.col("areas") - 6,
        node_cm=k % 12,
        b2m_elevated=k % 5 == 0,
        marrow=F.when(k % 7 != 0, k % 2 == 0),
    )
    points = list(dict.fromkeys([*scores.FLIPI_POINTS, *scores.FLIPI2_POINTS]))
    return out.select("record_id", *points, "diag_flipi_n", "diag_flipi2_n", "diag_flipi_risk_grade", "diag_flipi2_risk_grade")


# --- therapy classes ----------------------------------------------------------------------------

_REGIMENS = [
    "R-CHOP", "CHOP", "POLA-R-CHP", "R-COMP, Radiotherapy", "DA-R-EPOCH", "R-DHAP, Autologous-HCT", "R-GDP", "ICE", "MATRIX",
    "BR", "GEMOX", "Pixantrone", "Gemcitabine", "Paclitaxel", "Axi-cel", "Tafasitamab, Lenalidomide", "Glofitamab",
    "Epcoritamab", "Mosunetuzumab", "Polatuzumab", "Ibrutinib", "Venetoclax", "Revlimid", "Nivolumab", "Selinexor",
    "Rituximab", "Obinutuzumab", "Best supportive care", "", "BEAM, Allogeneic HCT", "pola-r-cmp", "obi-bendamustin", "Doxorubicin",
]


def _flag_rows(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("order_key")
    drugs = F.get(F.array(*[F.lit(r) for r in _REGIMENS]), (key % len(_REGIMENS)).cast("int"))
    return views.lines(spark, folder).select(
        "record_id",
        "treat_line",
        F.when(key % 41 != 0, drugs).alias("drug_med_all_line"),
        F.when(key % 19 == 0, "no").otherwise("yes").alias("treat_y_n"),
    )


def _re(words) -> str:
    return f"regexp_matches(u, '{'|'.join(rf'\b{w}\b' for w in words)}', 'i')"


_FLAG_OUT = [*therapy.FLAG_WORDS, "rchop_flag", "empty_flag", "anthracyclin_flag", "ritux_only_flag", "antibody_only_flag",
             "intensive_chemo_flag", "nonintensive_chemo_flag", "bispecific_flag", "btk_flag", "targeted_flag",
             "any_systemic_flag", "no_treatment_bsc_flag"]


def _sql_chain(test: str, labels: dict[str, str]) -> str:
    return " ".join(f"WHEN {test} AND {f} THEN '{v}'" for f, v in labels.items())


def _flag_sql() -> str:
    single = {n: _re(w) for n, w in therapy.FLAG_WORDS.items()}
    single["chop_flag"] += " AND NOT regexp_matches(d, '\\bR-CHOP\\b')"
    single["benda_flag"] += f" AND NOT {single['pola_rchp_flag']}"
    single["rchop_flag"] = "regexp_matches(d, '\\bR-CHOP\\b')"
    single["empty_flag"] = "u = ''"
    single["anthracyclin_flag"] = f"regexp_matches(d, '{'|'.join(rf'\b{w}\b' for w in therapy.ANTHRACYCLINE_WORDS)}', 'i')"
    single["ritux_only_flag"] = "regexp_matches(u, '^\\s*RITUXIMAB\\s*$', 'i')"
    single["antibody_only_flag"] = "regexp_matches(u, '^\\s*(RITUXIMAB|OBINUTUZUMAB|OFATUMUMAB)\\s*$', 'i')"
    s = ", ".join(f"{e} AS {n}" for n, e in single.items())

    def any_(names) -> str:
        return "(" + " OR ".join(names) + ")"

    return f"""
WITH {views.LINES.strip()},
t AS (SELECT record_id, treat_line, coalesce(CASE WHEN order_key % 41 <> 0 THEN list_extract({_REGIMENS!r}, CAST(order_key % {len(_REGIMENS)} AS INTEGER) + 1) END, '') AS d,
  CASE WHEN order_key % 19 = 0 THEN 'no' ELSE 'yes' END AS treat_y_n FROM lines),
c AS (SELECT *, upper({_sql_regimen('d')}) AS u FROM t),
f1 AS (SELECT *, {s} FROM c),
f2 AS (SELECT *, {any_(therapy.INTENSIVE)} AS intensive_chemo_flag, {any_(therapy.NON_INTENSIVE)} AS nonintensive_chemo_flag,
  {any_(therapy.BISPECIFIC)} AS bispecific_flag, {any_(therapy.BTK)} AS btk_flag FROM f1),
f3 AS (SELECT *, {any_(therapy.TARGETED)} AS targeted_flag FROM f2),
f4 AS (SELECT *, {any_(therapy.SYSTEMIC)} AS any_systemic_flag FROM f3),
f5 AS (SELECT *, empty_flag OR ((bsc_any_flag OR treat_y_n = 'no') AND NOT any_systemic_flag) AS no_treatment_bsc_flag FROM f4),
f6 AS (SELECT *, CASE WHEN no_treatment_bsc_flag THEN '{therapy.NONE}' WHEN treat_line = 1 AND {any_(therapy.GROUP_FIRST)} THEN 'Any treatment'
    WHEN treat_line >= 2 AND {any_(therapy.GROUP_LATER)} THEN 'Any treatment' ELSE 'Other' END AS therapy_group,
  CASE WHEN no_treatment_bsc_flag THEN '{therapy.NONE}' {_sql_chain('treat_line = 1', therapy.SUBGROUP_FIRST)} WHEN treat_line = 1 THEN 'Other'
    {_sql_chain('treat_line >= 2', therapy.SUBGROUP_LATER)} ELSE 'Other' END AS therapy_subgroup,
  CASE WHEN no_treatment_bsc_flag THEN '{therapy.NONE}' WHEN treat_line = 1 THEN '{therapy.FRONTLINE}'
    {_sql_chain('treat_line >= 2', therapy.CATEGORY_LATER)} ELSE 'Other' END AS therapy_category FROM f5)
SELECT record_id, treat_line, d AS drugs, {', '.join(_FLAG_OUT)}, therapy_group, therapy_subgroup, therapy_category,
  CASE WHEN treat_line = 1 THEN '-' {' '.join(f"WHEN therapy_category = '{k}' THEN '{v}'" for k, v in therapy.INTENTION.items())}
    WHEN no_treatment_bsc_flag THEN 'Palliative' END AS treatment_intention FROM f6"""


@query(_flag_sql())
def treatment_flags(spark, folder):
    out = therapy.treatment_flags(_flag_rows(spark, folder))
    return out.select(
        "record_id", "treat_line", F.col("drug_med_all_line").alias("drugs"), *_FLAG_OUT,
        "therapy_group", "therapy_subgroup", "therapy_category", "treatment_intention",
    )
