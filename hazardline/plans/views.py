"""Registry-shaped views over the star-schema test tables, in DataFrame form and as SQL.

The DataFrame side feeds the queries; the SQL side is the same view for the checking engine.
Patients are customers, lines are orders, records are line items; a day is unknown where the order
number is divisible by three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.operators.scans import KeySizes, measure_keys, ordered_scan, position

MONTH = 365.25 / 12


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def patient_sizes(spark: SparkSession, folder: str) -> KeySizes:
    """Patients with very many lines, counted on the id column as read. Whatever has a row per line or fewer takes it."""
    return measure_keys(table(spark, folder, "orders").select(F.col("o_custkey").alias("record_id")), ["record_id"])


def lines(spark: SparkSession, folder: str, sizes: KeySizes | None = None) -> DataFrame:
    """One row per order: ``record_id, treat_line, start, order_key, state, priority, price``."""
    sizes = sizes or patient_sizes(spark, folder)
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("record_id"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderdate").cast("date").alias("start"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
    )
    return ordered_scan(orders, ["record_id"], ["start", "order_key"], {"treat_line": position()}, sizes=sizes)


LINES = """
lines AS (
  SELECT o_custkey AS record_id, o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS start,
         o_orderstatus AS state, o_orderpriority AS priority, o_totalprice AS price,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS treat_line
  FROM orders)"""


def status(spark: SparkSession, folder: str) -> DataFrame:
    """Per patient: state of the last order, last contact and first order date.

    Aggregates only: the last contact is taken per order first, then per patient.
    """
    ship = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("ship"))
    )
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return (
        orders.join(ship, "o_orderkey", "left")
        .groupBy(F.col("o_custkey").alias("record_id"))
        .agg(
            F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_state"),
            F.max(F.greatest("ship", "o_orderdate")).cast("date").alias("status_date"),
            F.min("o_orderdate").cast("date").alias("first_order"),
        )
        .select(
            "record_id",
            F.when(F.col("last_state") == "F", "deceased")
            .when(F.col("last_state") == "O", "alive")
            .otherwise("Lost2FU")
            .alias("surv_stat"),
            "status_date",
            F.expr("date_sub(first_order, cast(record_id % 200 as int))").alias("diagnosis_date"),
        )
    )


STATUS = """
status AS (
  SELECT o_custkey AS record_id,
         CASE arg_max(o_orderstatus, (o_orderdate, o_orderkey)) WHEN 'F' THEN 'deceased' WHEN 'O' THEN 'alive'
              ELSE 'Lost2FU' END AS surv_stat,
         CAST(max(greatest(ship, o_orderdate)) AS DATE) AS status_date,
         CAST(min(o_orderdate) AS DATE) - CAST(o_custkey % 200 AS INTEGER) AS diagnosis_date
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS ship FROM lineitem GROUP BY 1) s
    ON l_orderkey = o_orderkey
  GROUP BY o_custkey)"""


def _variant(date: Column, key: Column, day: int) -> Column:
    """The date, with its day set where the day is unknown."""
    known = (key % 3) != 0
    return F.when(known, date).otherwise(F.make_date(F.year(date), F.month(date), F.lit(day)))


def records(spark: SparkSession, folder: str, sizes: KeySizes | None = None) -> DataFrame:
    """One row per line item with the dated variants a line needs.

    ``seq`` orders the records of a line (line number, part, supplier).
    """
    line = lines(spark, folder, sizes)
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("cycle"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_shipdate").cast("date").alias("ship"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("line_state"),
        F.col("l_quantity").alias("quantity"),
    )
    joined = line.join(items, "order_key")
    key, ship, start = F.col("order_key"), F.col("ship"), F.col("start")
    after, before = ship > start, ship < start
    dates: dict[str, Column] = {
        "therapy_start_date": start,
        "therapy_end_date": F.when(after & (F.col("line_state") == "F"), ship),
        "progression_date": F.when(after & (F.col("flag") == "R"), ship),
        "progression_before_date": F.when(before & (F.col("flag") == "A"), ship),
        "therapy_relapse_date": F.when(F.col("priority") == "1-URGENT", start),
    }
    new = {f"{n}_{d:02d}": _variant(c, key, d) for n, c in dates.items() for d in (1, 15, 28)}
    new |= {f"{n}_imputed_day": F.when(c.isNotNull(), key % 3 == 0) for n, c in dates.items()}
    response = F.get(
        F.array(*[F.lit(x) for x in ("CR", "PR", "SD", "PD", "NE", "Unknown", "Not done")]),
        ((F.col("part") + F.col("cycle")) % 9).cast("int"),
    )
    return joined.withColumns({**new, "treat_best_response": response})


def _sql_variant(expr: str, day: int) -> str:
    return (
        f"CASE WHEN ({expr}) IS NULL THEN NULL WHEN order_key % 3 <> 0 THEN ({expr}) "
        f"ELSE make_date(CAST(year({expr}) AS INTEGER), CAST(month({expr}) AS INTEGER), {day}) END"
    )


_RECORD_DATES = {
    "therapy_start_date": "start",
    "therapy_end_date": "CASE WHEN ship > start AND line_state = 'F' THEN ship END",
    "progression_date": "CASE WHEN ship > start AND flag = 'R' THEN ship END",
    "progression_before_date": "CASE WHEN ship < start AND flag = 'A' THEN ship END",
    "therapy_relapse_date": "CASE WHEN priority = '1-URGENT' THEN start END",
}
RECORDS = (
    LINES
    + """,
items AS (
  SELECT l.*, l_linenumber AS cycle, l_partkey AS part, l_suppkey AS supplier,
         CAST(l_shipdate AS DATE) AS ship, l_returnflag AS flag, l_linestatus AS line_state, l_quantity AS quantity
  FROM lines l JOIN lineitem ON l_orderkey = order_key),
records AS (
  SELECT *, """
    + ", ".join(f"{_sql_variant(e, d)} AS {n}_{d:02d}" for n, e in _RECORD_DATES.items() for d in (1, 15, 28))
    + ", "
    + ", ".join(
        f"CASE WHEN ({e}) IS NOT NULL THEN order_key % 3 = 0 END AS {n}_imputed_day" for n, e in _RECORD_DATES.items()
    )
    + """,
    list_extract(['CR','PR','SD','PD','NE','Unknown','Not done'], CAST((part + cycle) % 9 AS INTEGER) + 1)
      AS treat_best_response
  FROM items)"""
)


def with_status(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add the patient's state and the variants of status and diagnosis date."""
    st = status(spark, folder)
    unknown = F.col("record_id") % 4 == 0
    new: dict[str, Column] = {}
    for n in ("status_date", "diagnosis_date"):
        for d in (1, 15, 28):
            c = F.col(n)
            new[f"{n}_{d:02d}"] = F.when(unknown, F.make_date(F.year(c), F.month(c), F.lit(d))).otherwise(c)
    last = F.col("record_id") % 5 == 0
    for d in (1, 15, 28):
        new[f"progression_sv_last_date_{d:02d}"] = F.when(last, F.date_sub(F.col("status_date"), 30))
    st = st.withColumns(new).drop("status_date", "diagnosis_date")
    return df.join(st, "record_id", "left")


def _sql_status_variant(c: str, d: int) -> str:
    return (
        f"CASE WHEN record_id % 4 = 0 THEN make_date(CAST(year({c}) AS INTEGER), CAST(month({c}) AS INTEGER), {d}) "
        f"ELSE {c} END AS {c}_{d:02d}"
    )


STATUS_VARIANTS = (
    STATUS
    + """,
patient AS (
  SELECT record_id, surv_stat, """
    + ", ".join(_sql_status_variant(n, d) for n in ("status_date", "diagnosis_date") for d in (1, 15, 28))
    + ", "
    + ", ".join(
        f"CASE WHEN record_id % 5 = 0 THEN status_date - 30 END AS progression_sv_last_date_{d:02d}" for d in (1, 15, 28)
    )
    + """
  FROM status)"""
)


def grouped(spark: SparkSession, folder: str, sizes: KeySizes | None = None) -> DataFrame:
    """Lines formed from the records."""
    from hazardline.operators.lines import collapse_lines

    narrow = records(spark, folder, sizes).drop("price", "quantity", "flag", "line_state", "ship", "order_key", "state")
    return collapse_lines(narrow, tie=("cycle", "part", "supplier"))


def collapsed(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the patient's last line and status: the input of the survival times."""
    from hazardline.operators.lines import last_line

    sizes = patient_sizes(spark, folder)
    return with_status(last_line(grouped(spark, folder, sizes), sizes=sizes), spark, folder)


def _pick(column: str, how: str) -> str:
    return f"{how}({column}) AS {column}"


_DATE_COLUMNS = [f"{n}_{d:02d}" for n in _RECORD_DATES for d in (1, 15, 28)]
_ORDER = "(therapy_start_date_15, cycle, part, supplier)"


def _sql_flag(n: str) -> str:
    d = f"{n}_15"
    if "_end_date" in n:
        key = f"(CAST(DATE '2100-01-01' - {d} AS BIGINT), therapy_start_date_15, cycle, part, supplier)"
    else:
        key = f"(CAST({d} - DATE '1900-01-01' AS BIGINT), therapy_start_date_15, cycle, part, supplier)"
    return f"arg_min({n}_imputed_day, {key}) FILTER (WHERE {d} IS NOT NULL) AS {n}_imputed_day"


COLLAPSED = (
    RECORDS
    + ","
    + STATUS_VARIANTS.lstrip()
    + """,
grouped AS (
  SELECT record_id, treat_line, """
    + ", ".join(_pick(c, "max" if "_end_date" in c else "min") for c in _DATE_COLUMNS)
    + ", "
    + ", ".join(_sql_flag(n) for n in _RECORD_DATES)
    + f""",
    arg_max(treat_best_response, {_ORDER}) FILTER (WHERE treat_best_response IS NOT NULL) AS treat_best_response,
    arg_min(cycle, {_ORDER}) AS cycle, arg_min(part, {_ORDER}) AS part, arg_min(supplier, {_ORDER}) AS supplier,
    arg_min(start, {_ORDER}) AS start, arg_min(priority, {_ORDER}) AS priority
  FROM records GROUP BY record_id, treat_line),
collapsed AS (
  SELECT g.*, p.* EXCLUDE (record_id),
         max(treat_line) OVER (PARTITION BY g.record_id) AS max_treat_line_num,
         treat_line = max(treat_line) OVER (PARTITION BY g.record_id) AS is_last_line
  FROM grouped g LEFT JOIN patient p ON p.record_id = g.record_id)"""
)


def survival(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with progression-free and overall survival."""
    from hazardline.operators.lines import last_line, os_line, pfs_line, progression_events

    sizes = patient_sizes(spark, folder)
    events = progression_events(last_line(grouped(spark, folder, sizes), sizes=sizes), sizes=sizes)
    return os_line(pfs_line(with_status(events, spark, folder)))


_LEADS = ", ".join(
    f"lead({c}_{d:02d}) OVER w AS next_{c}_{d:02d}"
    for c in ("progression_before_date", "therapy_relapse_date")
    for d in (1, 15, 28)
)
EVENTS = (
    COLLAPSED
    + f""",
led AS (SELECT *, lead(treat_line) OVER w AS next_line, {_LEADS}
  FROM collapsed WINDOW w AS (PARTITION BY record_id ORDER BY treat_line NULLS LAST)),
events_line AS (SELECT *, """
    + ", ".join(
        f"CASE WHEN progression_date_{d:02d} IS NOT NULL THEN progression_date_{d:02d} "
        f"WHEN next_line IS NOT NULL AND next_progression_before_date_{d:02d} IS NOT NULL "
        f"THEN next_progression_before_date_{d:02d} "
        f"WHEN next_line IS NOT NULL THEN next_therapy_relapse_date_{d:02d} END AS progression_event_date_{d:02d}"
        for d in (1, 15, 28)
    )
    + " FROM led)"
)


def _sql_pfs(p: int, s: int) -> str:
    ev, st = f"progression_event_date_{p:02d}", f"therapy_start_date_{s:02d}"
    sv, status_date = f"progression_sv_last_date_{s:02d}", f"status_date_{s:02d}"
    m = "CAST(30.4375 AS DOUBLE)"
    return (
        f"CASE WHEN {ev} IS NOT NULL THEN date_diff('day', {st}, {ev}) / {m} "
        f"WHEN is_last_line AND {sv} IS NOT NULL AND {sv} >= {st} THEN date_diff('day', {st}, {sv}) / {m} "
        f"WHEN is_last_line THEN date_diff('day', {st}, {status_date}) / {m} END AS PFS_{p:02d}_{s:02d}"
    )


def _sql_os(s: int, d: int) -> str:
    m = "CAST(30.4375 AS DOUBLE)"
    return (
        f"CASE WHEN is_last_line THEN date_diff('day', diagnosis_date_{d:02d}, status_date_{s:02d}) / {m} END "
        f"AS OS_{s:02d}_{d:02d}"
    )


SURVIVAL = (
    EVENTS
    + ",\nsurvival AS (SELECT *, "
    + ", ".join(_sql_pfs(p, s) for p in (1, 15, 28) for s in (1, 15, 28))
    + ", "
    + ", ".join(_sql_os(s, d) for s in (1, 15, 28) for d in (1, 15, 28))
    + """,
  CASE WHEN progression_event_date_15 IS NOT NULL THEN 1 WHEN is_last_line AND surv_stat = 'deceased' THEN 1
       WHEN is_last_line AND surv_stat IN ('alive', 'Lost2FU') THEN 0 END AS PFS_event,
  CASE WHEN surv_stat = 'deceased' THEN 1 WHEN surv_stat IN ('alive', 'Lost2FU') THEN 0 END AS OS_event,
  progression_event_date_01 IS NOT NULL OR progression_event_date_15 IS NOT NULL
    OR progression_event_date_28 IS NOT NULL AS progression_event_date_imputed_day
  FROM events_line)"""
)


def study(spark: SparkSession, folder: str) -> DataFrame:
    """Each patient's last line with its PFS in months, event, arm and covariates: the input of the statistics."""
    last = survival(spark, folder).where(F.col("is_last_line"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("record_id"),
        F.col("c_mktsegment").alias("arm"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"),
    )
    t = F.col("PFS_15_15")
    return last.join(customers, "record_id").select(
        "record_id",
        "arm",
        "balance",
        "nation",
        "priority",
        F.when(F.col("arm").isin("AUTOMOBILE", "BUILDING"), "No").otherwise("Yes").alias("exposed"),
        F.when(F.col("balance") < 0, "debt").when(F.col("balance") < 5000, "low").otherwise("high").alias("band"),
        F.when(t > 0, t).otherwise(0.5 / MONTH).alias("time"),
        F.col("PFS_event").alias("event"),
    ).where(t.isNotNull() & F.col("event").isNotNull())


STUDY = (
    SURVIVAL
    + """,
study AS (
  SELECT s.record_id, c_mktsegment AS arm, c_acctbal AS balance, c_nationkey AS nation, priority,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'No' ELSE 'Yes' END AS exposed,
         CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
         CASE WHEN PFS_15_15 > 0 THEN PFS_15_15 ELSE CAST(0.5 AS DOUBLE) / CAST(30.4375 AS DOUBLE) END AS time,
         PFS_event AS event
  FROM survival s JOIN customer ON c_custkey = s.record_id
  WHERE is_last_line AND PFS_15_15 IS NOT NULL AND PFS_event IS NOT NULL)"""
)
