"""Catalogue of survival statistics, each checked in SQL where the numbers can be stated there.

The model checks unroll the Newton steps of a two-covariate fit, so coefficients, tests and curves
are compared with an independent computation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardline.operators import cox as C
from hazardline.operators import kaplan_meier as K
from hazardline.plans import views

Q: dict[str, tuple] = {}
STUDY = views.STUDY.strip()


def query(sql: str | None):
    def add(fn):
        Q[fn.__name__] = (fn, sql)
        return fn

    return add


def _r(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def p_sql(chisq: str) -> str:
    """Upper tail of the chi-square distribution with one degree of freedom, by the error-function series."""
    x = f"sqrt(({chisq}) / 2)"
    term = f"(CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END) * pow({x}, 2 * k + 1) / (gamma(k + 1) * (2 * k + 1))"
    return f"1 - 2 / sqrt(pi()) * list_sum([{term} FOR k IN range(90)])"


def even_p_sql(chisq: str, df: int) -> str:
    """The same tail for an even number of degrees of freedom, a finite sum."""
    terms, factor = [], 1
    for i in range(df // 2):
        factor *= max(i, 1)
        terms.append(f"pow(({chisq}) / 2, {i}) / {factor}")
    return f"exp(-({chisq}) / 2) * ({' + '.join(terms)})"


def solve_sql(name: str, source: str, p: int, right: dict[str, list[str]]) -> str:
    """Gauss-Jordan elimination, unrolled: ``<name>_<p>`` has the columns ``<r><j>``, the solutions of the symmetric system
    ``i<j><k>`` (j <= k) of ``source`` for each right side ``r`` given by its expressions."""
    a = [f"i{min(j, k)}{max(j, k)} AS a{j}_{k}" for j in range(p) for k in range(p)]
    sides = [f"{e} AS {r}{j}" for r, es in right.items() for j, e in enumerate(es)]
    out = [f"{name}_0 AS MATERIALIZED (SELECT {', '.join(a + sides)} FROM {source})"]
    for c in range(p):
        columns = []
        for j in range(p):
            share = f"a{j}_{c} / a{c}_{c}"
            for col, pivot in [(f"a{j}_{k}", f"a{c}_{k}") for k in range(p)] + [(f"{r}{j}", f"{r}{c}") for r in right]:
                columns.append(f"{pivot} / a{c}_{c} AS {col}" if j == c else f"{col} - {pivot} * {share} AS {col}")
        out.append(f"{name}_{c + 1} AS MATERIALIZED (SELECT {', '.join(columns)} FROM {name}_{c})")
    return ",\n".join(out)


# --- Kaplan-Meier -------------------------------------------------------------------------------


def km_sql(source: str, by: str = "arm", name: str = "km") -> str:
    """Common table expressions of a product-limit curve."""
    return f"""
{name}_c AS (SELECT {by}, time, count(*) FILTER (WHERE event = 1) AS d, count(*) FILTER (WHERE event <> 1) AS c FROM {source} GROUP BY 1, 2),
{name}_n AS (SELECT *, CAST(sum(d + c) OVER (PARTITION BY {by} ORDER BY time DESC) AS BIGINT) AS n FROM {name}_c),
{name}_s AS (SELECT *, product(1 - d / CAST(n AS DOUBLE)) OVER w AS s, sum(CASE WHEN n > d THEN d / (CAST(n AS DOUBLE) * (n - d)) END) OVER w AS v FROM {name}_n
  WINDOW w AS (PARTITION BY {by} ORDER BY time)),
{name} AS (SELECT {by}, time, n, d, c, s, CASE WHEN s > 0 THEN sqrt(v) END AS se,
  CASE WHEN s > 0 THEN s * exp(CAST(-1.959963984540054 AS DOUBLE) * sqrt(v)) END AS lo,
  CASE WHEN s > 0 THEN least(1, s * exp(CAST(1.959963984540054 AS DOUBLE) * sqrt(v))) END AS hi FROM {name}_s)"""


def median_sql(column: str, alias: str) -> str:
    first = f"min(time) FILTER (WHERE {column} <= 0.5 + 1e-12)"
    value = f"arg_min({column}, time) FILTER (WHERE {column} <= 0.5 + 1e-12)"
    below = f"min(time) FILTER (WHERE {column} < 0.5 - 1e-12)"
    return f"round(CASE WHEN abs({value} - 0.5) <= 1e-12 AND {below} IS NOT NULL THEN ({first} + {below}) / 2 ELSE {first} END, 6) AS {alias}"


@query(
    f"WITH {STUDY},{km_sql('study')} SELECT arm, round(time, 6) AS time, n AS n_risk, d AS n_event, c AS n_censor, "
    "round(s, 6) AS survival, round(se, 6) AS std_err, round(lo, 6) AS lower, round(hi, 6) AS upper FROM km"
)
def kaplan_meier(spark, folder):
    out = K.kaplan_meier(views.study(spark, folder), "time", "event", ["arm"])
    return _r(out, "time", "survival", "std_err", "lower", "upper")


_LINE_STUDY = """
line_study AS (SELECT c_mktsegment AS arm, PFS_15_15 AS time, PFS_event AS event FROM survival JOIN customer ON c_custkey = survival.record_id
  WHERE PFS_15_15 IS NOT NULL AND PFS_event IS NOT NULL)"""


@query(
    f"WITH {views.SURVIVAL.strip()},{_LINE_STUDY},{km_sql('line_study')} SELECT arm, max(n) AS records, CAST(sum(d) AS BIGINT) AS events, "
    f"{median_sql('s', 'median')}, {median_sql('lo', 'lower95')}, {median_sql('hi', 'upper95')} FROM km GROUP BY arm"
)
def km_median(spark, folder):
    """Median progression-free survival per arm over all therapy lines, from the raw records."""
    arm = views.table(spark, folder, "customer").select(F.col("c_custkey").alias("record_id"), F.col("c_mktsegment").alias("arm"))
    rows = views.survival(spark, folder).join(arm, "record_id")
    curve = K.kaplan_meier(rows, "PFS_15_15", "PFS_event", ["arm"])
    return _r(K.median_survival(curve, ["arm"]), "median", "lower95", "upper95")


@query(
    f"WITH {STUDY},{km_sql('study')}, t AS (SELECT unnest([3.0, 6.0, 12.0, 24.0, 60.0]) AS tp), last AS (SELECT arm, max(time) AS m FROM km GROUP BY 1), "
    "p AS (SELECT last.arm, CAST(tp AS DOUBLE) AS tp, arg_max((s, lo, hi), time) FILTER (WHERE time <= tp) AS x, count(*) FILTER (WHERE time <= tp) AS k "
    "FROM last JOIN km ON km.arm = last.arm, t WHERE tp <= m GROUP BY 1, 2) "
    "SELECT arm, tp AS time, round(tp / 12, 6) AS follow_up, CASE WHEN k = 0 THEN 100 ELSE round_even(x[1] * 100, 2) END AS survival, "
    "CASE WHEN k = 0 THEN 100 ELSE round_even(x[2] * 100, 2) END AS lower, CASE WHEN k = 0 THEN 100 ELSE round_even(x[3] * 100, 2) END AS upper FROM p"
)
def km_at_times(spark, folder):
    curve = K.kaplan_meier(views.study(spark, folder), "time", "event", ["arm"])
    return _r(K.survival_at(curve, ["arm"], times=[3, 6, 12, 24, 60], scale="m_y"), "follow_up")


@query(
    f"WITH {STUDY}, m AS (SELECT max(time) AS m FROM study), b AS (SELECT 6.0 * k AS t FROM m, range(200) r(k) WHERE 6.0 * k <= m) "
    "SELECT arm, CAST(t AS DOUBLE) AS time, count(*) FILTER (WHERE study.time >= t) AS n_risk, count(*) FILTER (WHERE study.time <= t AND event = 1) AS cum_events "
    "FROM study, b GROUP BY 1, 2"
)
def risk_table(spark, folder):
    return K.risk_table(K.kaplan_meier(views.study(spark, folder), "time", "event", ["arm"]), ["arm"], step=6.0)


def _logrank_sql(group: str) -> str:
    """Observed and expected events per group, and the two-group statistic."""
    return f"""
lt AS (SELECT time, sum(event) AS d, count(*) AS m FROM study GROUP BY 1),
ln AS (SELECT time, d, sum(m) OVER (ORDER BY time DESC) AS n FROM lt),
gs AS (SELECT DISTINCT {group} AS g FROM study),
gc AS (SELECT g, time, d, n, (SELECT count(*) FROM study s WHERE s.{group} = g AND s.time >= ln.time) AS ng FROM gs, ln WHERE d > 0),
oe AS (SELECT g, sum(d * ng / CAST(n AS DOUBLE)) AS e, sum(CASE WHEN n > 1 THEN d * (ng / CAST(n AS DOUBLE)) * (1 - ng / CAST(n AS DOUBLE)) * (n - d) / (n - 1) ELSE 0 END) AS v FROM gc GROUP BY 1),
ob AS (SELECT {group} AS g, count(*) AS n, CAST(sum(event) AS DOUBLE) AS o FROM study GROUP BY 1)"""


@query(
    f"WITH {STUDY},{_logrank_sql('exposed')} SELECT ob.g AS exposed, n, o AS observed, round(e, 6) AS expected, round((o - e) * (o - e) / v, 6) AS chisq, "
    f"1 AS df, round({p_sql('(o - e) * (o - e) / v')}, 6) AS p FROM ob JOIN oe ON oe.g = ob.g"
)
def logrank(spark, folder):
    out = K.logrank(views.study(spark, folder), "time", "event", "exposed")
    return _r(out, "expected", "chisq", "p")


_ARMS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _arms_sql() -> str:
    """The k-sample statistic over all arms but the last, by elimination."""
    k = len(_ARMS) - 1
    share = [f"max(CASE WHEN g = '{a}' THEN ng / CAST(n AS DOUBLE) END)" for a in _ARMS[:k]]
    wide = f"lw AS (SELECT time, max(d) AS d, max(n) AS n, {', '.join(f'{e} AS h{i}' for i, e in enumerate(share))} FROM gc GROUP BY time)"
    spread = "CASE WHEN n > 1 THEN d * (n - d) / CAST(n - 1 AS DOUBLE) ELSE 0 END"
    v = [f"sum({spread} * h{i} * ({1 if i == j else 0} - h{j})) AS i{i}{j}" for i in range(k) for j in range(i, k)]
    u = [f"(SELECT o - e FROM ob JOIN oe ON oe.g = ob.g WHERE ob.g = '{a}') AS u{i}" for i, a in enumerate(_ARMS[:k])]
    solved = solve_sql("lz", "lv", k, {"r": [f"u{i}" for i in range(k)]})
    x = " + ".join(f"u{i} * r{i}" for i in range(k))
    return f"{wide}, lv AS (SELECT {', '.join(v)}, {', '.join(u)} FROM lw), {solved}, lx AS (SELECT {x} AS x FROM lz_{k}, lv)"


@query(
    f"WITH {STUDY},{_logrank_sql('arm')}, {_arms_sql()} SELECT ob.g AS arm, n, o AS observed, round(e, 6) AS expected, round(x, 6) AS chisq, 4 AS df, "
    f"round({even_p_sql('x', 4)}, 6) AS p FROM ob JOIN oe ON oe.g = ob.g, lx"
)
def logrank_arms(spark, folder):
    out = K.logrank(views.study(spark, folder), "time", "event", "arm")
    return _r(out, "expected", "chisq", "p")


@query(f"""
WITH {STUDY}, gs AS (SELECT DISTINCT arm AS g FROM study), pr AS (SELECT a.g AS group1, b.g AS group2 FROM gs a JOIN gs b ON a.g < b.g),
x AS (SELECT group1, group2, time, sum(event) AS d, count(*) AS m, sum(CASE WHEN arm = group1 THEN event ELSE 0 END) AS d1, count(*) FILTER (WHERE arm = group1) AS m1
  FROM pr JOIN study ON arm IN (group1, group2) GROUP BY 1, 2, 3),
n AS (SELECT group1, group2, CAST(d AS DOUBLE) AS d, CAST(d1 AS DOUBLE) AS d1, CAST(sum(m) OVER w AS DOUBLE) AS n, CAST(sum(m1) OVER w AS DOUBLE) AS n1 FROM x
  WINDOW w AS (PARTITION BY group1, group2 ORDER BY time DESC)),
s AS (SELECT group1, group2, sum(d1 - d * n1 / n) AS u, sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END) AS v FROM n WHERE d > 0 GROUP BY 1, 2)
SELECT group1, group2, round(u * u / v, 6) AS chisq, 1 AS df, round({p_sql('u * u / v')}, 6) AS p FROM s""")
def logrank_pairwise(spark, folder):
    return _r(K.pairwise_logrank(views.study(spark, folder), "time", "event", "arm"), "chisq", "p")


# --- models -------------------------------------------------------------------------------------


def cox_sql(xs: list[str], steps: int = 8, name: str = "cx", varying: str | None = None, source: str = "study") -> str:
    """Unrolled Newton steps with Efron ties for covariates of ``source``.

    Ends in ``<name>b`` (coefficients), ``<name>i`` (information, likelihood), ``<name>v`` (variances; of three or more
    covariates only the diagonal) and ``<name>0`` (at zero).
    With ``varying`` the second covariate is that expression times ln(1 + event time).
    """
    p = len(xs)
    out = []
    if varying is None:
        out.append(f"{name}d AS (SELECT time, event, {', '.join(f'CAST({x} AS DOUBLE) AS x{k}' for k, x in enumerate(xs))} FROM {source})")
    else:
        out.append(
            f"{name}d AS (SELECT t.time, CASE WHEN r.time = t.time THEN event ELSE 0 END AS event, CAST({xs[0]} AS DOUBLE) AS x0, "
            f"CAST({xs[0]} AS DOUBLE) * ln(1 + t.time) AS x1 FROM (SELECT DISTINCT time FROM {source} WHERE event = 1) t JOIN {source} r ON r.time >= t.time)"
        )
        p = 2
    pairs = [(j, k) for j in range(p) for k in range(j, p)]
    out.append(f"{name}b0 AS (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS b{k}" for k in range(p)) + ")")
    for s in range(steps + 1):
        xb = " + ".join(f"b{k} * x{k}" for k in range(p))
        n = f"{name}_{s}"
        moments = [("0", "w"), *[(f"1{k}", f"w * x{k}") for k in range(p)], *[(f"2{j}{k}", f"w * x{j} * x{k}") for j, k in pairs]]
        out.append(f"{n}e AS (SELECT d.*, exp({xb}) AS w, {xb} AS xb FROM {name}d d, {name}b{s})")
        agg = ", ".join(
            [f"sum({e}) AS s{m}" for m, e in moments]
            + [f"coalesce(sum({e}) FILTER (WHERE event = 1), 0) AS d{m}" for m, e in moments]
            + [f"sum(x{k}) FILTER (WHERE event = 1) AS dx{k}" for k in range(p)]
        )
        out.append(f"{n}t AS (SELECT time, {agg}, sum(xb) FILTER (WHERE event = 1) AS dxb, count(*) FILTER (WHERE event = 1) AS d FROM {n}e GROUP BY time)")
        if varying is None:
            suffix = ", ".join(f"sum(s{m}) OVER w AS s{m}" for m, _ in moments)
            out.append(f"{n}r AS (SELECT * EXCLUDE ({', '.join('s' + m for m, _ in moments)}), {suffix} FROM {n}t WINDOW w AS (ORDER BY time DESC))")
        else:
            out.append(f"{n}r AS (SELECT * FROM {n}t)")
        out.append(f"{n}l AS (SELECT *, l / CAST(d AS DOUBLE) AS f, s0 - l / CAST(d AS DOUBLE) * d0 AS phi FROM (SELECT *, unnest(range(d)) AS l FROM {n}r WHERE d > 0))")
        means = ", ".join(f"(s1{k} - f * d1{k}) / phi AS m{k}" for k in range(p))
        out.append(f"{n}m AS (SELECT *, {means} FROM {n}l)")
        terms = ", ".join(
            ["sum(dxb / d - ln(phi)) AS ll"]
            + [f"sum(dx{k} / d - m{k}) AS u{k}" for k in range(p)]
            + [f"sum((s2{j}{k} - f * d2{j}{k}) / phi - m{j} * m{k}) AS i{j}{k}" for j, k in pairs]
        )
        out.append(f"{n}i AS (SELECT {terms} FROM {n}m)")
        if p == 1:
            step = "b0 + u0 / i00 AS b0"
        elif p > 2:
            out.append(solve_sql(f"{n}z", f"{n}i", p, {"r": [f"u{k}" for k in range(p)]}))
            step = ", ".join(f"b{k} + r{k} AS b{k}" for k in range(p))
            out.append(f"{name}b{s + 1} AS MATERIALIZED (SELECT {step} FROM {n}z_{p}, {name}b{s})")
            continue
        else:
            det = "(i00 * i11 - i01 * i01)"
            step = f"b0 + (i11 * u0 - i01 * u1) / {det} AS b0, b1 + (i00 * u1 - i01 * u0) / {det} AS b1"
        out.append(f"{name}b{s + 1} AS (SELECT {step} FROM {n}i, {name}b{s})")
    out.append(f"{name}b AS (SELECT * FROM {name}b{steps})")
    out.append(f"{name}i AS (SELECT * FROM {name}_{steps}i)")
    out.append(f"{name}0 AS (SELECT * FROM {name}_0i)")
    if p == 2:
        det = "(i00 * i11 - i01 * i01)"
        out.append(f"{name}v AS (SELECT i11 / {det} AS v00, i00 / {det} AS v11, -i01 / {det} AS v01, ll FROM {name}i)")
    elif p > 2:
        unit = {f"c{c}_": ["1.0::DOUBLE" if j == c else "0.0::DOUBLE" for j in range(p)] for c in range(p)}
        out.append(solve_sql(f"{name}w", f"{name}i", p, unit))
        diagonal = ", ".join(f"c{k}_{k} AS v{k}{k}" for k in range(p))
        out.append(f"{name}v AS (SELECT {diagonal}, ll FROM {name}w_{p}, {name}i)")
    else:
        out.append(f"{name}v AS (SELECT 1 / i00 AS v00, ll FROM {name}i)")
    return ",\n".join(out)


_XS = ["CASE WHEN exposed = 'Yes' THEN 1 ELSE 0 END", "balance / 1000"]
_LAST = 8
LEVELS = {"exposed": ["No", "Yes"]}


def _study(spark: SparkSession, folder: str) -> DataFrame:
    return views.study(spark, folder).withColumn("balance_k", F.col("balance") / 1000)


def _fit(spark: SparkSession, folder: str) -> tuple[DataFrame, C.CoxFit]:
    rows = _study(spark, folder)
    return rows, C.cox_fit(rows, "time", "event", ["exposed", "balance_k"], LEVELS)


def _z(k: int) -> str:
    return (
        f"round(b{k}, 6) AS coef, round(sqrt(v{k}{k}), 6) AS se, round(exp(b{k}), 6) AS hr, "
        f"round(exp(b{k} - 1.959963984540054 * sqrt(v{k}{k})), 6) AS lower, round(exp(b{k} + 1.959963984540054 * sqrt(v{k}{k})), 6) AS upper, "
        f"round(b{k} / sqrt(v{k}{k}), 6) AS z, round({p_sql(f'b{k} * b{k} / v{k}{k}')}, 6) AS p"
    )


@query(
    f"WITH {STUDY},\n{cox_sql(_XS)} SELECT 'exposedYes' AS term, 'exposed' AS variable, 'Yes' AS level, {_z(0)} FROM cxb, cxv "
    f"UNION ALL SELECT 'balance_k', 'balance_k', NULL, {_z(1)} FROM cxb, cxv"
)
def cox(spark, folder):
    _, fit = _fit(spark, folder)
    return _r(C.coefficients(fit), "coef", "se", "hr", "lower", "upper", "z", "p")


@query(
    f"WITH {STUDY},\n{cox_sql(_XS)}, s AS (SELECT time, event, round(b0 * ({_XS[0]}) + b1 * ({_XS[1]}), 9) AS xb FROM study, cxb), "
    "pr AS (SELECT count(*) FILTER (WHERE b.xb < a.xb) AS conc, count(*) FILTER (WHERE b.xb = a.xb) AS tied, count(*) AS total FROM s a JOIN s b "
    "ON a.event = 1 AND (b.time > a.time OR (b.time = a.time AND b.event = 0))), "
    "u AS (SELECT i11, i00, i01, u0, u1, (i00 * i11 - i01 * i01) AS det FROM cx0), "
    "t AS (SELECT 'likelihood_ratio' AS test, 2 * (cxi.ll - cx0.ll) AS x FROM cxi, cx0 "
    "UNION ALL SELECT 'wald', b0 * b0 * i00 + 2 * b0 * b1 * i01 + b1 * b1 * i11 FROM cxb, cxi "
    "UNION ALL SELECT 'score', (i11 * u0 * u0 - 2 * i01 * u0 * u1 + i00 * u1 * u1) / det FROM u) "
    "SELECT test, round(x, 4) AS statistic, 2 AS df, round(exp(-x / 2), 6) AS p, round((conc + tied / CAST(2 AS DOUBLE)) / total, 4) AS concordance, "
    "(SELECT count(*) FROM study) AS n, (SELECT count(*) FROM study WHERE event = 1) AS events FROM t, pr"
)
def cox_global(spark, folder):
    _, fit = _fit(spark, folder)
    out = C.global_tests(fit)
    return out.withColumns({"statistic": F.round("statistic", 4), "concordance": F.round("concordance", 4), "p": F.round("p", 6)})


@query(
    f"WITH {STUDY},\n{cox_sql(_XS)},\n{cox_sql(_XS[1:], name='ca')},\n{cox_sql(_XS[:1], name='cb')} "
    f"SELECT 'exposed' AS variable, round(2 * (cxi.ll - cai.ll), 4) AS lr, 1 AS df, round({p_sql('2 * (cxi.ll - cai.ll)')}, 5) AS global_p FROM cxi, cai "
    f"UNION ALL SELECT 'balance_k', round(2 * (cxi.ll - cbi.ll), 4), 1, round({p_sql('2 * (cxi.ll - cbi.ll)')}, 5) FROM cxi, cbi"
)
def cox_variable_tests(spark, folder):
    _, fit = _fit(spark, folder)
    return C.variable_tests(fit).withColumns({"lr": F.round("lr", 4), "global_p": F.round("global_p", 5)})


@query(
    f"WITH {STUDY},\n{cox_sql(_XS)},\n{cox_sql(_XS[1:], name='ca')},\n{cox_sql(_XS[:1], name='cb')} "
    f"SELECT 'exposedYes' AS term, 'exposed' AS variable, 'Yes' AS level, {_z(0)}, round({p_sql('2 * (cxv.ll - cai.ll)')}, 5) AS global_p FROM cxb, cxv, cai "
    f"UNION ALL SELECT 'balance_k', 'balance_k', NULL, {_z(1)}, round({p_sql('2 * (cxv.ll - cbi.ll)')}, 5) FROM cxb, cxv, cbi"
)
def cox_table(spark, folder):
    _, fit = _fit(spark, folder)
    out = C.cox_table(fit).withColumn("global_p", F.round("global_p", 5))
    return _r(out, "coef", "se", "hr", "lower", "upper", "z", "p")


_BANDS = ["low", "debt", "high"]
_ARM_XS = [f"CASE WHEN arm = '{a}' THEN 1 ELSE 0 END" for a in _ARMS[1:]]
_BAND_XS = [f"CASE WHEN band = '{b}' THEN 1 ELSE 0 END" for b in _BANDS[1:]]


def _factors_sql() -> str:
    rows = []
    for k, (v, lv) in enumerate([("arm", a) for a in _ARMS[1:]] + [("band", b) for b in _BANDS[1:]]):
        lr, df = ("2 * (cxv.ll - fbi.ll)", 4) if v == "arm" else ("2 * (cxv.ll - fai.ll)", 2)
        rows.append(f"SELECT '{v}{lv}' AS term, '{v}' AS variable, '{lv}' AS level, {_z(k)}, round({even_p_sql(lr, df)}, 5) AS global_p FROM cxb, cxv, fai, fbi")
    return (
        f"WITH {STUDY},\n{cox_sql(_ARM_XS + _BAND_XS)},\n{cox_sql(_ARM_XS, name='fa')},\n{cox_sql(_BAND_XS, name='fb')} " + " UNION ALL ".join(rows)
    )


@query(_factors_sql())
def cox_factors(spark, folder):
    """A model of two factors with several levels, and their joint tests."""
    rows = views.study(spark, folder)
    out = C.cox_table(C.cox_fit(rows, "time", "event", ["arm", "band"], {"arm": _ARMS, "band": _BANDS}))
    return _r(out.withColumn("global_p", F.round("global_p", 5)), "coef", "se", "hr", "lower", "upper", "z", "p")


@query(
    f"WITH {STUDY},\n{cox_sql(_XS)} SELECT 0 AS place, 'exposed' AS variable, 'No' AS level, (SELECT count(*) FROM study WHERE exposed = 'No') AS n, true AS reference, "
    "CAST(1 AS DOUBLE) AS hr, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper, CAST(NULL AS DOUBLE) AS p "
    "UNION ALL SELECT 1, 'exposed', 'Yes', (SELECT count(*) FROM study WHERE exposed = 'Yes'), false, round(exp(b0), 6), "
    f"round(exp(b0 - 1.959963984540054 * sqrt(v00)), 6), round(exp(b0 + 1.959963984540054 * sqrt(v00)), 6), round({p_sql('b0 * b0 / v00')}, 6) FROM cxb, cxv "
    "UNION ALL SELECT 2, 'balance_k', NULL, (SELECT count(*) FROM study), false, round(exp(b1), 6), "
    f"round(exp(b1 - 1.959963984540054 * sqrt(v11)), 6), round(exp(b1 + 1.959963984540054 * sqrt(v11)), 6), round({p_sql('b1 * b1 / v11')}, 6) FROM cxb, cxv"
)
def forest_rows(spark, folder):
    rows, fit = _fit(spark, folder)
    return _r(C.forest_rows(rows, fit), "hr", "lower", "upper", "p")


def _tt_fit(spark: SparkSession, folder: str) -> C.CoxFit:
    return C.cox_tt(views.study(spark, folder), "time", "event", ["exposed"], "exposed", LEVELS)


def _z4(k: int) -> str:
    """As :func:`_z`, to as many digits as two different sums of a time-varying model agree in."""
    return _z(k).replace(", 6)", ", 4)")


def _r4(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("coef", "se", "hr", "lower", "upper", "z", "p")})


@query(
    f"WITH {STUDY},\n{cox_sql(_XS[:1], varying='x')} SELECT 'exposedYes' AS term, 'exposed' AS variable, 'Yes' AS level, {_z4(0)} FROM cxb, cxv "
    f"UNION ALL SELECT 'tt(exposed)', 'exposed', 'tt', {_z4(1)} FROM cxb, cxv"
)
def cox_tt(spark, folder):
    return _r4(C.coefficients(_tt_fit(spark, folder)))


@query(
    f"WITH {STUDY},\n{cox_sql(_XS[1:], varying='x')} SELECT 'balance_k' AS term, 'balance_k' AS variable, NULL AS level, {_z4(0)} FROM cxb, cxv "
    f"UNION ALL SELECT 'tt(balance_k)', 'balance_k', 'tt', {_z4(1)} FROM cxb, cxv"
)
def cox_tt_numeric(spark, folder):
    """An effect over time of a covariate that has a value of its own on nearly every row."""
    return _r4(C.coefficients(C.cox_tt(_study(spark, folder), "time", "event", ["balance_k"], "balance_k")))


@query(
    f"WITH {STUDY},\n{cox_sql(_XS[:1], varying='x')}, t AS (SELECT i * (CAST(60 AS DOUBLE) / 199) AS time FROM range(200) r(i)), "
    "c AS (SELECT time, b0 + b1 * ln(1 + time) AS lh, sqrt(v00 + ln(1 + time) * ln(1 + time) * v11 + 2 * ln(1 + time) * v01) AS se FROM t, cxb, cxv) "
    "SELECT round(time, 6) AS time, round(exp(lh), 4) AS hr, round(exp(lh - 1.96 * se), 4) AS lower, round(exp(lh + 1.96 * se), 4) AS upper FROM c"
)
def hr_curve(spark, folder):
    out = C.hr_curve(_tt_fit(spark, folder), "exposed", 60.0)
    return out.select(
        F.round("time", 6).alias("time"), F.round("hr", 4).alias("hr"), F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper")
    )


_AT = [1.0, 3.0, 6.0, 12.0, 24.0, 36.0]
_BASE = f"""
h AS (SELECT time, sum(1 / phi) AS h, sum(1 / (phi * phi)) AS v, sum(m0 / phi) AS q0, sum(m1 / phi) AS q1 FROM cx_{_LAST}m GROUP BY time),
hc AS (SELECT tp, coalesce(sum(h) FILTER (WHERE time <= tp), 0) AS h, coalesce(sum(v) FILTER (WHERE time <= tp), 0) AS v,
  coalesce(sum(q0) FILTER (WHERE time <= tp), 0) AS q0, coalesce(sum(q1) FILTER (WHERE time <= tp), 0) AS q1 FROM h, (SELECT CAST(unnest({_AT}) AS DOUBLE) AS tp) GROUP BY tp),
pp AS (SELECT lv, tp, exp(-h * r) AS s, r, lv AS x0, x1, h, v, q0, q1 FROM (SELECT lv, x1, exp(b0 * lv + b1 * x1) AS r FROM cxd, cxb, (SELECT unnest([0, 1]) AS lv)), hc),
ag AS (SELECT lv, tp, avg(s) AS s, greatest(avg(s * s) - avg(s) * avg(s), 0) / count(*) AS sp, avg(s * r) AS sr, avg(s * r * x0) AS sx0, avg(s * r * x1) AS sx1,
  any_value(h) AS h, any_value(v) AS v, any_value(q0) AS q0, any_value(q1) AS q1 FROM pp GROUP BY 1, 2),
gr AS (SELECT *, q0 * sr - h * sx0 AS g0, q1 * sr - h * sx1 AS g1 FROM ag),
ad AS (SELECT lv, tp, s, sqrt(g0 * g0 * v00 + 2 * g0 * g1 * v01 + g1 * g1 * v11 + sr * sr * v + sp) AS se FROM gr, cxv)"""


@query(
    f"WITH {STUDY},\n{cox_sql(_XS)},{_BASE} SELECT CASE lv WHEN 1 THEN 'Yes' ELSE 'No' END AS exposed, tp AS time, round(s, 5) AS survival, round(se, 5) AS std_err, "
    "round(greatest(s - 1.959963984540054 * se, 0), 5) AS lower, round(least(s + 1.959963984540054 * se, 1), 5) AS upper FROM ad"
)
def adjusted_survival(spark, folder):
    rows, fit = _fit(spark, folder)
    out = C.adjusted_survival(fit, "exposed", times=_AT)
    return out.withColumns({c: F.round(c, 5) for c in ("survival", "std_err", "lower", "upper")})


_WEALTH = [_XS[0], "CASE WHEN balance >= 5000 THEN 1 ELSE 0 END"]


def _profile_sql() -> str:
    """Adjusted curves at every event time; equal covariates are merged with their count."""
    body = _BASE[_BASE.index("hc AS") :].replace(f"(SELECT CAST(unnest({_AT}) AS DOUBLE) AS tp)", "(SELECT time AS tp FROM h)")
    base = _BASE[: _BASE.index("hc AS")] + """
hc AS (SELECT time AS tp, sum(h) OVER w AS h, sum(v) OVER w AS v, sum(q0) OVER w AS q0, sum(q1) OVER w AS q1 FROM h WINDOW w AS (ORDER BY time)),
"""
    body = body[body.index("pp AS") :]
    return base + body


@query(
    f"WITH {STUDY},\n{cox_sql(_WEALTH)},{_profile_sql()}, "
    "km AS (SELECT lv, tp AS time, s, greatest(s - 1.959963984540054 * se, 0) AS lo, least(s + 1.959963984540054 * se, 1) AS hi FROM ad) "
    f"SELECT CASE lv WHEN 1 THEN 'Yes' ELSE 'No' END AS \"group\", {median_sql('s', 'q')}, {median_sql('lo', 'ci_lower')}, {median_sql('hi', 'ci_upper')} FROM km GROUP BY lv"
)
def adjusted_median(spark, folder):
    """Medians of curves standardised over a model of factors only, so rows are merged by profile."""
    rows = views.study(spark, folder).withColumn("wealth", F.when(F.col("balance") >= 5000, "high").otherwise("low"))
    fit = C.cox_fit(rows, "time", "event", ["exposed", "wealth"], {**LEVELS, "wealth": ["low", "high"]})
    return _r(C.adjusted_median(C.adjusted_survival(fit, "exposed"), "exposed"), "q", "ci_lower", "ci_upper")


@query(
    f"WITH {STUDY},\n{cox_sql(_XS)},{_profile_sql()}, "
    "km AS (SELECT lv, tp AS time, s, greatest(s - 1.959963984540054 * se, 0) AS lo, least(s + 1.959963984540054 * se, 1) AS hi FROM ad) "
    f"SELECT CASE lv WHEN 1 THEN 'Yes' ELSE 'No' END AS \"group\", {median_sql('s', 'q')}, {median_sql('lo', 'ci_lower')}, {median_sql('hi', 'ci_upper')} FROM km GROUP BY lv"
)
def adjusted_median_numeric(spark, folder):
    """Medians of standardised curves where a covariate is continuous: searched for, no curve is made."""
    _, fit = _fit(spark, folder)
    return _r(C.adjusted_median_search(fit, "exposed"), "q", "ci_lower", "ci_upper")


def _ph_sql(g: str, more: str = "") -> str:
    """Scaled residuals against a transform of time; ``g`` is its expression over ``cxd`` and ``mt``."""
    return (
        f"WITH {STUDY},\n{cox_sql(_XS)}, mt AS (SELECT time, avg(m0) AS a0, avg(m1) AS a1 FROM cx_{_LAST}m GROUP BY time){more}, "
        f"rs AS (SELECT {g} AS g, x0 - a0 AS r0, x1 - a1 AS r1 FROM cxd JOIN mt ON mt.time = cxd.time WHERE event = 1), "
        "gb AS (SELECT avg(g) AS gb, count(*) AS n FROM rs), "
        "su AS (SELECT sum((g - gb) * (g - gb)) AS gg, sum((g - gb) * r0) AS g0, sum((g - gb) * r1) AS g1, sum(r0 * r0) AS r00, sum(r0 * r1) AS r01, sum(r1 * r1) AS r11, any_value(n) AS n FROM rs, gb), "
        "sc AS (SELECT *, n * (v00 * g0 + v01 * g1) AS s0, n * (v01 * g0 + v11 * g1) AS s1, "
        "n * n * (v00 * v00 * r00 + 2 * v00 * v01 * r01 + v01 * v01 * r11) AS q0, n * n * (v01 * v01 * r00 + 2 * v01 * v11 * r01 + v11 * v11 * r11) AS q1 FROM su, cxv), "
        "ct AS (SELECT 'exposedYes' AS term, s0 / sqrt(gg * q0) AS rho, s0 * s0 / (v00 * n * gg) AS chisq, 1 AS df FROM sc "
        "UNION ALL SELECT 'balance_k', s1 / sqrt(gg * q1), s1 * s1 / (v11 * n * gg), 1 FROM sc "
        "UNION ALL SELECT 'GLOBAL', NULL, (g0 * g0 * v00 + 2 * g0 * g1 * v01 + g1 * g1 * v11) * n / gg, 2 FROM sc) "
        f"SELECT term, round(rho, 4) AS rho, round(chisq, 4) AS chisq, df, round(CASE df WHEN 1 THEN {p_sql('chisq')} ELSE exp(-chisq / 2) END, 4) AS p FROM ct"
    )


def _ph(spark: SparkSession, folder: str, transform: str) -> DataFrame:
    rows, fit = _fit(spark, folder)
    out = C.ph_check(rows, fit, transform=transform)
    return out.withColumns({c: F.round(c, 4) for c in ("rho", "chisq", "p")})


@query(_ph_sql("cxd.time"))
def ph_check(spark, folder):
    return _ph(spark, folder, "identity")


@query(
    _ph_sql(
        "(SELECT any_value(before) FROM kb WHERE kb.time = cxd.time)",
        "," + km_sql("(SELECT 1 AS one, time, event FROM study)", "one").replace("GROUP BY 1, 2)", "GROUP BY one, time)")
        + ", kb AS (SELECT time, 1 - coalesce(lag(s) OVER (ORDER BY time), 1) AS before FROM km)",
    )
)
def ph_check_km(spark, folder):
    return _ph(spark, folder, "km")


@query(
    f"WITH {STUDY}, sub AS (SELECT * FROM study WHERE band IN ('low', 'high')),{km_sql('sub', 'exposed')} SELECT exposed, max(n) AS records, CAST(sum(d) AS BIGINT) AS events, "
    f"{median_sql('s', 'median')}, {median_sql('lo', 'lower95')}, {median_sql('hi', 'upper95')} FROM km GROUP BY exposed"
)
def subgroup(spark, folder):
    sub = views.study(spark, folder).where(F.col("band").isin("low", "high"))
    curve = K.kaplan_meier(sub, "time", "event", ["exposed"])
    return _r(K.median_survival(curve, ["exposed"]), "median", "lower95", "upper95")


@query(
    f"WITH {STUDY}, sub AS (SELECT * FROM study WHERE band IN ('low', 'high')),\n{cox_sql(_XS, source='sub')} "
    f"SELECT 'exposedYes' AS term, 'exposed' AS variable, 'Yes' AS level, {_z(0)}, (SELECT count(*) FROM sub) AS n FROM cxb, cxv "
    f"UNION ALL SELECT 'balance_k', 'balance_k', NULL, {_z(1)}, (SELECT count(*) FROM sub) FROM cxb, cxv"
)
def subgroup_cox(spark, folder):
    sub = _study(spark, folder).where(F.col("band").isin("low", "high"))
    fit = C.cox_fit(sub, "time", "event", ["exposed", "balance_k"], LEVELS)
    return _r(C.coefficients(fit), "coef", "se", "hr", "lower", "upper", "z", "p").withColumn("n", F.lit(fit.n).cast("long"))
