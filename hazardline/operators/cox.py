"""Proportional hazards models fitted by Newton steps over grouped sums.

Each step is one Spark aggregation: rows give ``exp(xb)`` and its first and second moments per time,
summed map-side; suffix sums over the distinct times give the risk sets; one row of likelihood,
score and information comes back. Only p-by-p matrices are handled on the driver. Ties follow Efron.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.operators.kaplan_meier import Z95, chi2_sf, kaplan_meier
from hazardline.operators.scans import (
    PIECE,
    KeySizes,
    measure_keys,
    ordered_scan,
    position,
    preceding,
    remaining_sum,
    running_product,
    running_sum,
)
from hazardline.operators.tiles import Blocks, everywhere, point_blocks, spread

# --- fixed values -----------------------------------------------------------------------------
TOLERANCE = 1e-9
MAX_STEPS = 25
TIE_CHUNK = 4096  # tied deaths summed in one row; more are spread over rows
TIE_SUMS = ("tl", "a1", "a2", "b0", "b1", "b2")
HALVINGS = 20
RANKS = 65_536  # ranked rows whose bits one task of the concordance counts
HR_POINTS = 200
# ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Term:
    name: str
    variable: str
    level: str | None = None


@dataclass
class CoxFit:
    terms: list[Term]
    beta: np.ndarray
    vcov: np.ndarray
    loglik0: float
    loglik: float
    score: float
    steps: int
    n: int
    events: int
    time: str
    event: str
    variables: list[str]
    levels: dict[str, list[str]]
    mean: np.ndarray
    scale: np.ndarray
    design: DataFrame = field(repr=False)
    spark: object = field(repr=False)
    scan: dict = field(default_factory=dict, repr=False)
    heavy: bool = False
    converged: bool = True

    @property
    def scaled_beta(self) -> np.ndarray:
        return self.beta * self.scale

    @property
    def scaled_vcov(self) -> np.ndarray:
        return self.vcov * np.outer(self.scale, self.scale)

    def release(self) -> None:
        """Gives the kept design back; what is on the driver (coefficients, tests) stays."""
        self.design.unpersist()


def _total(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0.0)


def _terms(covariates: Sequence[str], levels: Mapping[str, Sequence[str]]) -> list[Term]:
    out = []
    for v in covariates:
        if v in levels:
            out += [Term(f"{v}{lv}", v, lv) for lv in levels[v][1:]]
        else:
            out.append(Term(v, v))
    return out


def _raw_value(term: Term) -> Column:
    c = F.col(f"`{term.variable}`")
    return c.cast("double") if term.level is None else (c.cast("string") == term.level).cast("double")


def complete_cases(
    df: DataFrame, time: str, event: str, covariates: Sequence[str], levels: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Rows with time, event and every covariate known; factor values must be a known level."""
    keep = F.col(f"`{time}`").isNotNull() & F.col(f"`{event}`").isNotNull()
    for v in covariates:
        c = F.col(f"`{v}`")
        keep = keep & (c.cast("string").isin(list(levels[v])) if v in levels else c.isNotNull())
    return df.where(keep)


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(j, k) for j in range(p) for k in range(j, p)]


def _moments(weight: Column, xs: Sequence[Column], prefix: str, second: bool = True) -> dict[str, Column]:
    """Weighted sums of 1, x and xx'."""
    out = {f"{prefix}0": F.sum(weight)}
    out |= {f"{prefix}1_{k}": F.sum(weight * x) for k, x in enumerate(xs)}
    if second:
        out |= {f"{prefix}2_{j}_{k}": F.sum(weight * xs[j] * xs[k]) for j, k in _pairs(len(xs))}
    return out


def _linear(beta: np.ndarray, xs: Sequence[Column]) -> Column:
    return _total([F.lit(float(b)) * x for b, x in zip(beta, xs)])


def _number(x: float) -> str:
    if not math.isfinite(x):
        raise ValueError("the model does not converge")
    return f"({float(x)!r}D)"


def _moment_sql(weight: str, p: int, prefix: str) -> dict[str, str]:
    """As :func:`_moments`, in SQL text: a step has hundreds of expressions, and text builds fastest."""
    out = {f"{prefix}0": weight} | {f"{prefix}1_{k}": f"{weight} * x{k}" for k in range(p)}
    return out | {f"{prefix}2_{j}_{k}": f"{weight} * x{j} * x{k}" for j, k in _pairs(p)}


def _risk_sums(design: DataFrame, beta: np.ndarray, p: int, scan: dict) -> DataFrame:
    """One row per event time: risk-set moments ``s*``, moments over the deaths ``d*``, death counts
    and covariate sums. Plain case: covariates fixed in time.
    """
    rows = design.selectExpr("*", f"{_linear_sql(beta)} AS xb")
    return _summed_up(rows, [], p, scan)


def _risk_sums_of_models(design: DataFrame, betas: Mapping[int, np.ndarray], p: int, scan: dict) -> DataFrame:
    """As :func:`_risk_sums` for several coefficient vectors at once, with the ``model`` each row is of.

    A row meets each model inside the map side, so the design is read once for all.
    """
    listed = ", ".join(f"struct({m} AS model, {_linear_sql(b)} AS xb)" for m, b in betas.items())
    rows = design.selectExpr("*", f"explode(array({listed})) AS _m").selectExpr("*", "_m.model AS model", "_m.xb AS xb")
    return _summed_up(rows, ["model"], p, scan)


def _linear_sql(beta: np.ndarray) -> str:
    return " + ".join(f"{_number(v)} * x{k}" for k, v in enumerate(beta)) or "0D"


def _summed_up(rows: DataFrame, keys: list[str], p: int, scan: dict) -> DataFrame:
    rows = rows.selectExpr(
        "*", "exp(xb) * w AS e", "CASE WHEN event = 1 THEN exp(xb) * w ELSE 0D END AS f", "CASE WHEN event = 1 THEN w ELSE 0D END AS l"
    )
    risk_set = _moment_sql("e", p, "s")
    at_time = _moment_sql("f", p, "d") | {"deaths": "l", "dxb": "l * xb"} | {f"dx{k}": f"l * x{k}" for k in range(p)}
    per_time = rows.groupBy(*keys, "time").agg(*[F.expr(f"sum({e}) AS {n}") for n, e in (risk_set | at_time).items()])
    if scan.get("bounded"):
        by = f"PARTITION BY {', '.join(keys)} " if keys else ""
        suffix = [f"sum({n}) OVER ({by}ORDER BY time DESC) AS {n}" for n in risk_set]
        return per_time.selectExpr(*keys, "time", *at_time, *suffix).where("deaths > 0")
    risk = ordered_scan(per_time, keys, ["time"], {f"r_{n}": remaining_sum(n) for n in risk_set}, **scan)
    return risk.selectExpr(*keys, "time", *at_time, *[f"r_{n} AS {n}" for n in risk_set]).where("deaths > 0")


def _tie_sum(s0: Column, d0: Column, deaths: Column, first: Column, last: Column) -> Column:
    """Efron sums over the places ``first..last`` among the tied deaths of a time.

    With phi_l = s0 - (l/d) d0: ``tl`` = sum log phi, ``a1`` = sum 1/phi, ``a2`` = sum (l/d)/phi,
    ``b0, b1, b2`` = sums of (l/d)^k / phi^2.
    """
    zero = F.struct(*[F.lit(0.0).alias(n) for n in TIE_SUMS])

    def add(acc: Column, i: Column) -> Column:
        f = i / deaths
        phi = s0 - f * d0
        return F.struct(
            (acc["tl"] + F.log(phi)).alias("tl"),
            (acc["a1"] + 1 / phi).alias("a1"),
            (acc["a2"] + f / phi).alias("a2"),
            (acc["b0"] + 1 / (phi * phi)).alias("b0"),
            (acc["b1"] + f / (phi * phi)).alias("b1"),
            (acc["b2"] + f * f / (phi * phi)).alias("b2"),
        )

    return F.aggregate(F.sequence(first, last), zero, add)


def _with_ties(risk: DataFrame, heavy: bool) -> DataFrame:
    """Add the Efron sums. Small ties are summed in the row; heavy ones in chunks over many tasks."""
    s0, d0, d = F.col("s0"), F.col("d0"), F.col("deaths")
    last = (d - 1).cast("long")
    if not heavy:
        out = risk.withColumn("_t", _tie_sum(s0, d0, d, F.lit(0).cast("long"), last))
        return out.selectExpr(*risk.columns, *[f"_t.{n} AS {n}" for n in TIE_SUMS])
    keys = [c for c in ("model", "time") if c in risk.columns]
    starts = F.sequence(F.lit(0).cast("long"), last, F.lit(TIE_CHUNK).cast("long"))
    chunks = risk.select(*keys, "s0", "d0", "deaths", F.explode(starts).alias("_from")).repartition(*keys, "_from")
    end = F.least(F.col("_from") + TIE_CHUNK - 1, last)
    summed = chunks.select(*keys, _tie_sum(s0, d0, d, F.col("_from"), end).alias("t"))
    return risk.join(summed.groupBy(*keys).agg(*[F.sum(f"t.{n}").alias(n) for n in TIE_SUMS]), keys)


def _newton_sums(p: int) -> list[str]:
    """Log-likelihood, score and information as sums over event times."""
    aggs = ["sum(dxb - tl) AS ll", "sum(deaths) AS events"]
    aggs += [f"sum(dx{k} - s1_{k} * a1 + d1_{k} * a2) AS u{k}" for k in range(p)]
    for j, k in _pairs(p):
        product = f"s1_{j} * s1_{k} * b0 - (s1_{j} * d1_{k} + d1_{j} * s1_{k}) * b1 + d1_{j} * d1_{k} * b2"
        aggs.append(f"sum(s2_{j}_{k} * a1 - d2_{j}_{k} * a2 - ({product})) AS i{j}_{k}")
    return aggs


def _newton_row(risk: DataFrame, p: int, heavy: bool) -> dict:
    return _with_ties(risk, heavy).selectExpr(*_newton_sums(p)).first().asDict()


def _newton_rows(risk: DataFrame, p: int, heavy: bool) -> dict[int, dict]:
    """The row of each model."""
    rows = _with_ties(risk, heavy).groupBy("model").agg(*[F.expr(e) for e in _newton_sums(p)]).collect()
    return {r["model"]: r.asDict() for r in rows}


def _unpack(row: dict, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    u = np.array([row[f"u{k}"] for k in range(p)])
    info = np.zeros((p, p))
    for j, k in _pairs(p):
        info[j, k] = info[k, j] = row[f"i{j}_{k}"]
    return row["ll"], u, info


@dataclass
class _Search:
    """One model on its way: coefficients, what is known there, and the step being tried."""

    beta: np.ndarray
    free: np.ndarray  # numbers of the terms in the model
    ll: float
    u: np.ndarray
    info: np.ndarray
    events: float
    move: np.ndarray | None = None
    halvings: int = 0
    steps: int = 0
    converged: bool = False
    done: bool = False

    def candidate(self) -> np.ndarray:
        if self.move is None:
            self.steps += 1
            self.move = np.zeros_like(self.beta)
            self.move[self.free] = np.linalg.pinv(self.info[np.ix_(self.free, self.free)]) @ self.u[self.free]
        return self.beta + self.move / 2**self.halvings

    def take(self, beta: np.ndarray, row: dict) -> None:
        """A step is taken where it raises the likelihood, ends the search where it no longer changes it, else is halved."""
        ll, u, info = _unpack(row, len(beta))
        known = ll is not None and math.isfinite(ll)
        self.converged = known and abs(ll - self.ll) <= TOLERANCE * max(abs(ll), 1.0)
        if self.converged or known and ll > self.ll:
            self.beta, self.ll, self.u, self.info, self.move, self.halvings = beta, ll, u, info, None, 0
            self.done = self.converged or self.steps >= MAX_STEPS
        else:
            self.halvings += 1
            self.done = self.halvings > HALVINGS


def _newton(
    evaluate: Callable[[dict[int, np.ndarray]], dict[int, dict]], starts: Sequence[np.ndarray], free: Sequence[Sequence[int]]
) -> tuple[list[_Search], list[tuple[float, float]]]:
    """Newton steps with step halving for several models, all advanced by one evaluation a step.

    Each model moves the terms in ``free`` and leaves the others where they start. Also returns the log-likelihood and the
    score statistic at the start.
    """
    rows = evaluate(dict(enumerate(starts)))
    models, at_start = [], []
    for m, (beta, terms) in enumerate(zip(starts, free, strict=True)):
        ll, u, info = _unpack(rows[m], len(beta))
        f = np.array(list(terms), int)
        models.append(_Search(np.array(beta, float), f, ll, u, info, rows[m]["events"], converged=not len(f), done=not len(f)))
        at_start.append((ll, float(u[f] @ np.linalg.pinv(info[np.ix_(f, f)]) @ u[f]) if len(f) else 0.0))
    while asked := {m: s.candidate() for m, s in enumerate(models) if not s.done}:
        rows = evaluate(asked)
        for m, beta in asked.items():
            models[m].take(beta, rows[m])
    return models, at_start


def _settled(model: _Search, unsettled: str) -> bool:
    if unsettled not in ("error", "return"):
        raise ValueError("unsettled is 'error' or 'return'")
    if not model.converged and unsettled == "error":
        raise ValueError(f"the model did not settle in {model.steps} steps")
    return model.converged


def _prepare(
    df: DataFrame, time: str, event: str, covariates: Sequence[str], levels: Mapping[str, Sequence[str]], extra: Column | None
):
    """The design table (kept in memory or on disk) with centred, scaled columns."""
    levels = {k: [str(x) for x in v] for k, v in levels.items()}
    terms = _terms(covariates, levels)
    rows = complete_cases(df, time, event, covariates, levels)
    raw = rows.select(
        F.col(f"`{time}`").cast("double").alias("time"),
        F.col(f"`{event}`").cast("int").alias("event"),
        *[_raw_value(t).alias(f"x{k}") for k, t in enumerate(terms)],
        *([extra.alias("z")] if extra is not None else []),
    )
    if extra is not None:
        raw = raw.where(F.col("z").isNotNull())
    if all(v in levels for v in covariates):
        raw = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).cast("double").alias("w"))
    else:
        raw = raw.withColumn("w", F.lit(1.0))
    raw = raw.persist()
    p = len(terms)
    aggs = [F.sum("w").alias("n"), F.approx_count_distinct("time").alias("times")]
    aggs += [F.sum(F.col("w") * F.col(f"x{k}")).alias(f"m{k}") for k in range(p)]
    aggs += [F.sum(F.col("w") * F.col(f"x{k}") * F.col(f"x{k}")).alias(f"q{k}") for k in range(p)]
    stats = raw.agg(*aggs).first()
    n = stats["n"] or 0.0
    if n == 0:
        raise ValueError("no complete rows to fit")
    mean = np.array([stats[f"m{k}"] / n for k in range(p)])
    var = np.array([stats[f"q{k}"] / n for k in range(p)]) - mean**2
    scale = np.where(var > 1e-12, np.sqrt(np.maximum(var, 1e-300)), 1.0)
    design = raw.withColumns({f"x{k}": (F.col(f"x{k}") - F.lit(float(mean[k]))) / F.lit(float(scale[k])) for k in range(p)})
    # few distinct times (calendar days, say) fit one window; otherwise every scan measures
    scan = {"bounded": True} if stats["times"] * 1.2 < PIECE else {}
    deaths = design.where("event = 1").groupBy("time").agg(F.sum("w").alias("d"))
    heavy = (deaths.agg(F.max("d")).first()[0] or 0) > TIE_CHUNK
    return terms, levels, design, mean, scale, int(n), scan, heavy


def cox_fit(
    df: DataFrame, time: str, event: str, covariates: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None,
    unsettled: str = "error",
) -> CoxFit:
    """Fit a proportional hazards model on the complete rows.

    Covariates named in ``levels`` are factors, with the first level as reference; others are
    numeric. A fit that does not settle in ``MAX_STEPS`` steps is an error, or with
    ``unsettled="return"`` is returned with ``converged`` false.
    """
    levels = levels or {}
    terms, levels, design, mean, scale, n, scan, heavy = _prepare(df, time, event, covariates, levels, None)
    p = len(terms)
    [model], [(ll0, score)] = _newton(
        lambda betas: {0: _newton_row(_risk_sums(design, betas[0], p, scan), p, heavy)}, [np.zeros(p)], [range(p)]
    )
    vcov = np.linalg.pinv(model.info) if p else model.info
    return CoxFit(
        terms, model.beta / scale, vcov / np.outer(scale, scale), ll0, model.ll, score, model.steps, n, int(model.events), time,
        event, list(covariates), levels, mean, scale, design, df.sparkSession, scan, heavy, _settled(model, unsettled),
    )


def _normal_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def coefficients(fit: CoxFit) -> DataFrame:
    """One row per term: coefficient, standard error, hazard ratio, interval, z and p."""
    rows = []
    for k, t in enumerate(fit.terms):
        b, se = float(fit.beta[k]), float(math.sqrt(max(fit.vcov[k, k], 0.0)))
        z = b / se if se > 0 else math.nan
        rows.append(
            (t.name, t.variable, t.level, b, se, math.exp(b), math.exp(b - Z95 * se), math.exp(b + Z95 * se), z, _normal_p(z))
        )
    schema = "term string, variable string, level string, coef double, se double, hr double, lower double, upper double, z double, p double"
    return fit.spark.createDataFrame(rows, schema)


def covariance(fit: CoxFit) -> DataFrame:
    rows = [
        (a.name, b.name, float(fit.vcov[i, j])) for i, a in enumerate(fit.terms) for j, b in enumerate(fit.terms)
    ]
    return fit.spark.createDataFrame(rows, "term1 string, term2 string, covariance double")


def concordance_counts(fit: CoxFit) -> dict[str, float]:
    """Concordant, discordant and tied pairs of risk score and time, exactly.

    A pair counts when the shorter time ends in an event (at equal times: event against censored). Rows of equal time and
    score are merged and ranked by score, then time. Of two ranks the lower one differs first at one bit: it has a 0 where
    the higher has a 1, after equal leading bits. So each row joins, once per bit, the group of its leading bits; the groups
    are summed per time before the shuffle, and a suffix sum over times counts the pairs. Groups of many bits in common are
    small, those of few have one row per time; nothing is held per score, and nothing but three sums reaches the driver.
    """
    p = len(fit.terms)
    score = _linear(fit.scaled_beta, [F.col(f"x{k}") for k in range(p)])
    dead = F.col("event") == 1
    merged = (
        fit.design.withColumn("s", F.round(score, 12))
        .groupBy("time", "s")
        .agg(F.sum(F.when(dead, F.col("w")).otherwise(0.0)).alias("d"), F.sum(F.when(dead, 0.0).otherwise(F.col("w"))).alias("c"))
    )
    # equal scores are ranked by time, so a later row never ranks below an earlier one of its score
    ranked = ordered_scan(merged, [], ["s", "time"], {"_rank": position()}).withColumn("m", F.col("d") + F.col("c")).persist()
    rows = ranked.agg(F.max("_rank")).first()[0] or 0

    def later_pairs(groups: DataFrame, keys: list[str], asks: str, same: Column) -> float:
        """Sum over groups of ``asks`` at a time times the ``m`` at later times and ``same`` at its own."""
        after = ordered_scan(groups, keys, ["time"], {"_rest": remaining_sum("m")}, **fit.scan)
        return after.agg(F.sum(F.col(asks) * (F.col("_rest") - F.col("m") + same))).first()[0] or 0.0

    bits = F.sequence(F.lit(0), F.lit(max(int(rows).bit_length() - 1, 0)))
    # a row makes one of each bit, so few rows go to a task; neighbours stay together, which share groups
    spread_out = ranked.repartitionByRange(rows // RANKS + 1, "_rank")
    split = spread_out.withColumn("bit", F.explode(bits))
    shifted = F.expr("shiftright(_rank, bit)")
    one = (shifted % 2) == 1
    groups = split.groupBy("bit", F.expr("shiftright(_rank, bit + 1)").alias("lead"), "time").agg(
        F.sum(F.when(one, F.col("d")).otherwise(0.0)).alias("ask"),
        F.sum(F.when(one, 0.0).otherwise(F.col("m"))).alias("m"),
        F.sum(F.when(one, 0.0).otherwise(F.col("c"))).alias("same"),
    )
    concordant = later_pairs(groups, ["bit", "lead"], "ask", F.col("same"))
    tied = later_pairs(ranked.select("s", "time", "d", "c", "m"), ["s"], "d", F.col("c"))
    per_time = ranked.groupBy("time").agg(F.sum("d").alias("d"), F.sum("c").alias("c"), F.sum("m").alias("m"))
    comparable = later_pairs(per_time, [], "d", F.col("c"))
    ranked.unpersist()
    return {
        "concordant": concordant,
        "discordant": comparable - tied - concordant,
        "tied_risk": tied,
        "comparable": comparable,
    }


def concordance(fit: CoxFit) -> float:
    c = concordance_counts(fit)
    return (c["concordant"] + c["tied_risk"] / 2) / c["comparable"] if c["comparable"] else math.nan


def global_tests(fit: CoxFit, with_concordance: bool = True) -> DataFrame:
    """Likelihood ratio, Wald and score test of the whole model, and the concordance."""
    p = len(fit.terms)
    lr = 2 * (fit.loglik - fit.loglik0)
    wald = float(fit.beta @ np.linalg.pinv(fit.vcov) @ fit.beta)
    c = concordance(fit) if with_concordance else None
    rows = [
        (name, float(x), p, chi2_sf(x, p), c, fit.n, fit.events)
        for name, x in (("likelihood_ratio", lr), ("wald", wald), ("score", fit.score))
    ]
    return fit.spark.createDataFrame(
        rows, "test string, statistic double, df int, p double, concordance double, n long, events long"
    )


def variable_tests(fit: CoxFit) -> DataFrame:
    """Likelihood-ratio test per variable: the model without it, on the same complete rows.

    All reduced models move together, one aggregation over the kept design a step, from the full model's coefficients.
    """
    p = len(fit.terms)
    free = [[k for k, t in enumerate(fit.terms) if t.variable != v] for v in fit.variables]
    starts = [np.where(np.isin(np.arange(p), f), fit.scaled_beta, 0.0) for f in free]
    models, _ = _newton(
        lambda betas: _newton_rows(_risk_sums_of_models(fit.design, betas, p, fit.scan), p, fit.heavy), starts, free
    )
    rows = []
    for v, model in zip(fit.variables, models, strict=True):
        _settled(model, "error")
        lr, dof = 2 * (fit.loglik - model.ll), p - len(model.free)
        rows.append((v, float(lr), dof, chi2_sf(lr, dof)))
    return fit.spark.createDataFrame(rows, "variable string, lr double, df int, global_p double")


def cox_table(fit: CoxFit) -> DataFrame:
    """Hazard ratio, interval and p per term, with the global p of its variable."""
    return coefficients(fit).join(variable_tests(fit).select("variable", "global_p"), "variable", "left")


def forest_rows(df: DataFrame, fit: CoxFit) -> DataFrame:
    """Per variable and level: n, hazard ratio, interval and p, with the reference level as 1."""
    used = complete_cases(df, fit.time, fit.event, fit.variables, fit.levels)
    names = [
        F.struct(
            F.lit(v).alias("variable"),
            (F.col(f"`{v}`").cast("string") if v in fit.levels else F.lit(None).cast("string")).alias("level"),
        )
        for v in fit.variables
    ]
    counts = (
        used.select(F.explode(F.array(*names)).alias("x"))
        .groupBy("x.variable", "x.level")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    listed = [(v, lv) for v in fit.variables for lv in fit.levels.get(v, [None])]
    wanted = fit.spark.createDataFrame(
        [(i, v, lv, bool(v in fit.levels and lv == fit.levels[v][0])) for i, (v, lv) in enumerate(listed)],
        "place int, variable string, level string, reference boolean",
    )
    est = coefficients(fit).select("variable", "level", "hr", "lower", "upper", "p")

    def same(a: DataFrame, b: DataFrame) -> Column:
        return (a["variable"] == b["variable"]) & a["level"].eqNullSafe(b["level"])

    out = wanted.join(F.broadcast(est), same(wanted, est), "left").select(
        wanted["place"], wanted["variable"], wanted["level"], wanted["reference"], "hr", "lower", "upper", "p"
    )
    # as many rows as the model has levels
    out = out.join(F.broadcast(counts), same(out, counts), "left").select(
        "place", out["variable"], out["level"], F.coalesce(counts["n"], F.lit(0)).alias("n"), "reference",
        "hr", "lower", "upper", "p",
    )
    return out.withColumn("hr", F.when(F.col("reference"), F.lit(1.0)).otherwise(F.col("hr")))


# --- time-varying effects -----------------------------------------------------------------------


def log_time(x: Column, t: Column) -> Column:
    """The default time transform: x * log(1 + t)."""
    return x * F.log1p(t)


def _tt_sums(
    design: DataFrame, beta: np.ndarray, p: int, blocks: Blocks, tt: Callable[[Column, Column], Column], sizes: KeySizes
) -> DataFrame:
    """Risk sums with one time-varying term, from suffix sums per value of its covariate.

    Rows of one value share the factor exp(b * tt(value, t)), so the risk set at t is a weighted sum of the values' suffix
    sums there. A suffix sum holds from the value's time before it up to its own, and meets the event times in between, in
    tiles. So each value meets each event time once at most: few values cost their number times the event times, and a value
    per row costs what the definition asks for.
    """
    xs = [F.col(f"x{k}") for k in range(p)]
    xb = _linear(beta[:p], xs)
    e, dead = F.exp(xb) * F.col("w"), F.col("event") == 1
    lived = F.when(dead, F.col("w")).otherwise(0.0)
    sums = _moments(e, xs, "s") | _moments(F.when(dead, e).otherwise(0.0), xs, "d")
    sums |= {"deaths": F.sum(lived), "dxb": F.sum(lived * xb)} | {f"dx{k}": F.sum(lived * x) for k, x in enumerate(xs)}
    cells = design.groupBy("z", "time").agg(*[c.alias(n) for n, c in sums.items()])
    suffix = [n for n in sums if n[0] == "s"]
    steps = {f"r_{n}": remaining_sum(n) for n in suffix} | {"_before": preceding("time")}
    live = ordered_scan(cells, ["z"], ["time"], steps, sizes=sizes).drop(*suffix).withColumnsRenamed({f"r_{n}": n for n in suffix})
    b = float(beta[p])
    met = spread(live, blocks, "_before", "time").withColumn("_f", tt(F.col("z"), F.col("at")))
    met = met.withColumn("_e", F.exp(F.lit(b) * F.col("_f"))).withColumn("_now", F.col("at") == F.col("time"))
    f = F.col("_f")

    def at_death(value: Column) -> Column:
        return F.sum(F.when(F.col("_now"), value).otherwise(0.0))

    out: dict[str, Column] = {}
    for s, add in (("s", F.sum), ("d", at_death)):
        part = lambda name, s=s: F.col("_e") * F.col(f"{s}{name}")
        out[f"{s}0"] = add(part("0"))
        for k in range(p):
            out[f"{s}1_{k}"] = add(part(f"1_{k}"))
            out[f"{s}2_{k}_{p}"] = add(part(f"1_{k}") * f)
        for j, k in _pairs(p):
            out[f"{s}2_{j}_{k}"] = add(part(f"2_{j}_{k}"))
        out[f"{s}1_{p}"] = add(part("0") * f)
        out[f"{s}2_{p}_{p}"] = add(part("0") * f * f)
    out |= {f"dx{k}": at_death(F.col(f"dx{k}")) for k in range(p)} | {f"dx{p}": at_death(F.col("deaths") * f)}
    out |= {"deaths": at_death(F.col("deaths")), "dxb": at_death(F.col("dxb") + F.lit(b) * F.col("deaths") * f)}
    return met.groupBy(F.col("at").alias("time")).agg(*[c.alias(n) for n, c in out.items()])


def cox_tt(
    df: DataFrame,
    time: str,
    event: str,
    covariates: Sequence[str],
    varying: str,
    levels: Mapping[str, Sequence[str]] | None = None,
    tt: Callable[[Column, Column], Column] = log_time,
    unsettled: str = "error",
) -> CoxFit:
    """A model with the extra term ``tt(varying)``, evaluated at each event time.

    ``varying`` is numeric, of any number of values, or a two-level factor that enters as 0/1.
    """
    levels = levels or {}
    if varying in levels:
        if len(levels[varying]) != 2:
            raise ValueError("a time-varying factor must have two levels")
        z = (F.col(f"`{varying}`").cast("string") == str(levels[varying][1])).cast("double")
    else:
        z = F.col(f"`{varying}`").cast("double")
    terms, levels, design, mean, scale, n, scan, heavy = _prepare(df, time, event, covariates, levels, z)
    p = len(terms)
    blocks = point_blocks(design.where("event = 1").select("time").distinct(), **scan)
    sizes = measure_keys(design.select("z", "time").distinct(), ["z"])
    [model], [(ll0, score)] = _newton(
        lambda betas: {0: _newton_row(_tt_sums(design, betas[0], p, blocks, tt, sizes), p + 1, heavy)}, [np.zeros(p + 1)], [range(p + 1)]
    )
    blocks.release()
    terms = [*terms, Term(f"tt({varying})", varying, "tt")]
    mean, scale = np.append(mean, 0.0), np.append(scale, 1.0)
    return CoxFit(
        terms, model.beta / scale, np.linalg.pinv(model.info) / np.outer(scale, scale), ll0, model.ll, score, model.steps, n,
        int(model.events), time, event, list(covariates), levels, mean, scale, design, df.sparkSession, scan, heavy,
        _settled(model, unsettled),
    )


def hr_curve(fit: CoxFit, varying: str, end: float, points: int = HR_POINTS) -> DataFrame:
    """Hazard ratio over time, exp(b1 + b2 log(1+t)), with its delta-method interval."""
    i = next(k for k, t in enumerate(fit.terms) if t.variable == varying and t.level != "tt")
    j = next(k for k, t in enumerate(fit.terms) if t.name == f"tt({varying})")
    b1, b2 = float(fit.beta[i]), float(fit.beta[j])
    v11, v22, v12 = float(fit.vcov[i, i]), float(fit.vcov[j, j]), float(fit.vcov[i, j])
    lt = F.log1p("time")
    log_hr = F.lit(b1) + F.lit(b2) * lt
    se = F.sqrt(F.lit(v11) + lt * lt * F.lit(v22) + lt * F.lit(2 * v12))
    # 1.96 is the multiplier of this curve
    return (
        fit.spark.range(points)
        .select((F.col("id") * F.lit(end / (points - 1))).alias("time"))
        .select("time", F.exp(log_hr).alias("hr"), F.exp(log_hr - 1.96 * se).alias("lower"), F.exp(log_hr + 1.96 * se).alias("upper"))
    )


# --- baseline hazard, adjusted curves, residual check -------------------------------------------


def baseline(fit: CoxFit) -> DataFrame:
    """Per event time the cumulative hazard of the mean row, its variance part and the integral of
    risk-set means: ``time, hazard, variance, q0 …``. As many rows as event times.
    """
    p = len(fit.terms)
    t = _with_ties(_risk_sums(fit.design, fit.scaled_beta, p, fit.scan), fit.heavy)
    steps = {"_h": F.col("a1"), "_v": F.col("b0")}
    steps |= {f"_q{k}": F.col(f"s1_{k}") * F.col("b0") - F.col(f"d1_{k}") * F.col("b1") for k in range(p)}
    # risk-set means weighted by the hazard: sum over ties of xbar / phi
    per_time = t.select("time", *[c.alias(n) for n, c in steps.items()])
    names = {"hazard": "_h", "variance": "_v"} | {f"q{k}": f"_q{k}" for k in range(p)}
    return ordered_scan(per_time, [], ["time"], {n: running_sum(c) for n, c in names.items()}, **fit.scan).drop(*steps)


def _profiles(fit: CoxFit, variable: str) -> DataFrame:
    """``w, level, r, x0 …``: each distinct row of covariates once per level of ``variable``, with the number of rows it
    stands for and its relative hazard with the variable set to the level."""
    if variable not in fit.levels:
        raise ValueError("the adjusted variable must be a factor of the model")
    fixed = [k for k, t in enumerate(fit.terms) if t.variable == variable]
    others = [f"x{k}" for k in range(len(fit.terms)) if k not in fixed]
    counted = fit.design.groupBy(*others).agg(F.sum("w").alias("w")) if others else fit.design.agg(F.sum("w").alias("w"))

    def setting(level: str) -> list[Column]:
        out = []
        for k, t in enumerate(fit.terms):
            value = ((1.0 if t.level == level else 0.0) - fit.mean[k]) / fit.scale[k]
            out.append(F.lit(float(value)) if k in fixed else F.col(f"x{k}"))
        return out

    variants = []
    for i, lv in enumerate(fit.levels[variable]):
        xs = setting(lv)
        variants.append(F.struct(F.lit(i).alias("level"), F.exp(_linear(fit.scaled_beta, xs)).alias("r"), *[x.alias(f"x{k}") for k, x in enumerate(xs)]))
    return counted.select("w", F.explode(F.array(*variants)).alias("v")).select("w", "v.*")


def _standardised(fit: CoxFit, met: DataFrame, base: DataFrame) -> DataFrame:
    """Mean survival per level and time with its interval, from profiles that met times (``time``, ``hazard``).

    ``base`` has the variance parts of the times. Profiles are summed map-side; only the sums are shuffled.
    """
    p = len(fit.terms)
    w, s, r = F.col("w"), F.exp(-F.col("hazard") * F.col("r")), F.col("r")
    sums = met.groupBy("level", "time").agg(
        F.sum("w").alias("n"), F.sum(w * s).alias("s"), F.sum(w * s * s).alias("ss"), F.sum(w * s * r).alias("sr"),
        *[F.sum(w * s * r * F.col(f"x{j}")).alias(f"sx{j}") for j in range(p)],
    )
    sums = sums.join(base, "time")
    n, mean_s, mean_sr = F.col("n"), F.col("s") / F.col("n"), F.col("sr") / F.col("n")
    grad = [F.col(f"q{j}") * mean_sr - F.col("hazard") * F.col(f"sx{j}") / n for j in range(p)]
    v = fit.scaled_vcov
    model = _total([F.lit(float(v[i, j])) * grad[i] * grad[j] for i in range(p) for j in range(p)])
    spread_of = F.greatest(F.col("ss") / n - mean_s * mean_s, F.lit(0.0)) / n
    se = F.sqrt(model + mean_sr * mean_sr * F.col("variance") + spread_of)
    return sums.select(
        "level", "time", mean_s.alias("survival"), se.alias("std_err"),
        F.greatest(mean_s - Z95 * se, F.lit(0.0)).alias("lower"), F.least(mean_s + Z95 * se, F.lit(1.0)).alias("upper"),
    )


def _base_columns(fit: CoxFit) -> list[str]:
    return ["time", "hazard", "variance", *[f"q{k}" for k in range(len(fit.terms))]]


def adjusted_survival(fit: CoxFit, variable: str, times: Sequence[float] | None = None) -> DataFrame:
    """Directly standardised survival per level of ``variable``, with its 95% interval.

    Every row is predicted with the variable set to each level, and the predictions are averaged; rows of equal covariates
    are predicted once. The interval combines the uncertainty of coefficients and baseline hazard (delta method) with
    the spread of the predictions over rows. Curves are given at the event times, which profiles meet in tiles, or at
    ``times``, a short list.
    """
    profiles = _profiles(fit, variable)
    base = baseline(fit).select(*_base_columns(fit))
    if times is None:
        base = base.persist()
        met = everywhere(profiles, point_blocks(base, ["hazard"], **fit.scan))
    else:
        lists = F.struct(*base.columns)
        got = base.agg(*[F.max_by(lists, F.when(F.col("time") <= float(t), F.col("time"))).alias(f"_{i}") for i, t in enumerate(times)]).first()
        points = [(float(t), *([0.0] * (len(base.columns) - 1) if g is None else g[1:])) for t, g in zip(times, got, strict=True)]
        base = fit.spark.createDataFrame(points, ", ".join(f"{c} double" for c in base.columns))
        asked = F.array(*[F.struct(F.lit(t).alias("time"), F.lit(float(h)).alias("hazard")) for t, h, *_ in points])
        met = profiles.withColumn("_at", F.explode(asked)).select(*profiles.columns, "_at.*")
    labels = F.array(*[F.lit(lv) for lv in fit.levels[variable]])
    return _standardised(fit, met, base).select(F.get(labels, F.col("level")).alias(variable), "time", "survival", "std_err", "lower", "upper")


def adjusted_median_search(fit: CoxFit, variable: str, sections: int = 8) -> DataFrame:
    """As :func:`adjusted_median` of the whole curve, without the curve: ``group, q, ci_lower, ci_upper``.

    The first event time at which a curve is down to one half is searched for by its rank. Each round splits the ranks that
    are still open into ``sections``, for all levels and bounds in one aggregation over the profiles; rounds grow with the
    logarithm of the event times. The curve falls; its bounds are taken to fall too.
    """
    tolerance = 1e-12
    profiles = _profiles(fit, variable).persist()
    ranked = ordered_scan(baseline(fit).select(*_base_columns(fit)), [], ["time"], {"_rank": position()}, **fit.scan).persist()
    count = ranked.count()
    levels = range(len(fit.levels[variable]))
    curves = ("survival", "lower", "upper")
    tests = {"reached": lambda x: x <= 0.5 + tolerance, "below": lambda x: x < 0.5 - tolerance}
    known: dict[tuple[int, int], tuple] = {}  # level and rank to the curves' values there
    at: dict[int, float] = {}
    # the last rank known to be above, and the first known to be down
    open_ = {(lv, c, k): [0, count + 1] for lv in levels for c in curves for k in tests}

    def ask(wanted: set[tuple[int, int]]) -> None:
        rows = ranked.where(F.col("_rank").isin(sorted({rank for _, rank in wanted}))).collect()
        by_rank = {r["_rank"]: r for r in rows}
        at.update({rank: r["time"] for rank, r in by_rank.items()})
        points = [F.struct(F.lit(lv).alias("lv"), F.lit(by_rank[k]["time"]).alias("time"), F.lit(by_rank[k]["hazard"]).alias("hazard")) for lv, k in sorted(wanted)]
        met = profiles.withColumn("_at", F.explode(F.filter(F.array(*points), lambda x: x["lv"] == F.col("level"))))
        base = fit.spark.createDataFrame([tuple(r)[:-1] for r in rows], ", ".join(f"{c} double" for c in _base_columns(fit)))
        ranks = {r["time"]: rank for rank, r in by_rank.items()}
        for r in _standardised(fit, met.select(*profiles.columns, "_at.time", "_at.hazard"), base).collect():
            known[r["level"], ranks[r["time"]]] = tuple(r[c] for c in curves)

    while wider := {key: b for key, b in open_.items() if b[1] - b[0] > 1}:
        tried = {key: sorted({lo + max(1, (hi - lo) * i // sections) for i in range(1, sections)} - {hi}) for key, (lo, hi) in wider.items()}
        wanted = {(key[0], rank) for key, ranks in tried.items() for rank in ranks} - known.keys()
        if wanted:
            ask(wanted)
        for (lv, curve, test), ranks in tried.items():
            down = [k for k in ranks if tests[test](known[lv, k][curves.index(curve)])]
            bounds = open_[lv, curve, test]
            bounds[1] = min([bounds[1], *down])
            bounds[0] = max([bounds[0], *[k for k in ranks if k < bounds[1] and k not in down]])

    def crossing(lv: int, curve: str) -> float | None:
        first, below = open_[lv, curve, "reached"][1], open_[lv, curve, "below"][1]
        if first > count:
            return None
        value = known[lv, first][curves.index(curve)]
        flat = abs(value - 0.5) <= tolerance and below <= count
        return (at[first] + at[below]) / 2 if flat else at[first]

    profiles.unpersist()
    ranked.unpersist()
    rows = [(name, *[crossing(lv, c) for c in curves]) for lv, name in enumerate(fit.levels[variable])]
    return fit.spark.createDataFrame(rows, "group string, q double, ci_lower double, ci_upper double")


def adjusted_median(curve: DataFrame, variable: str) -> DataFrame:
    """Median of each adjusted curve with its interval: ``group, q, ci_lower, ci_upper``."""
    from hazardline.operators.kaplan_meier import quantile_columns

    aggs, finals = [], []
    for column, name in (("survival", "q"), ("lower", "ci_lower"), ("upper", "ci_upper")):
        parts, value = quantile_columns(column, name)
        aggs += parts
        finals.append(value)
    return curve.groupBy(F.col(variable).alias("group")).agg(*aggs).select("group", *finals)


def ph_check(df: DataFrame, fit: CoxFit, transform: str = "km") -> DataFrame:
    """Correlation of scaled Schoenfeld residuals with time, per term and for the whole model.

    Everything comes from sums per event time. Transforms: ``km`` (1 - survival just before the
    time), ``identity`` or ``log``.
    """
    p = len(fit.terms)
    xs = [F.col(f"x{k}") for k in range(p)]
    risk = _with_ties(_risk_sums(fit.design, fit.scaled_beta, p, fit.scan), fit.heavy)
    squares = (
        fit.design.where("event = 1")
        .groupBy("time")
        .agg(*[F.sum(F.col("w") * xs[j] * xs[k]).alias(f"xx{j}_{k}") for j, k in _pairs(p)])
    )
    t = risk.join(squares, "time")
    if transform == "km":
        counts = fit.design.groupBy("time").agg(
            F.sum(F.when(F.col("event") == 1, F.col("w")).otherwise(0.0)).alias("_d"), F.sum("w").alias("_m")
        )
        at = ordered_scan(counts, [], ["time"], {"_n": remaining_sum("_m")}, **fit.scan)
        kept = ordered_scan(
            at.withColumn("_k", 1 - F.col("_d") / F.col("_n")), [], ["time"], {"_s": running_product("_k")}, **fit.scan
        )
        before = ordered_scan(kept, [], ["time"], {"_b": preceding("_s")}, **fit.scan)
        t = t.join(before.select("time", (1 - F.coalesce("_b", F.lit(1.0))).alias("g")), "time")
    elif transform in ("identity", "log"):
        t = t.withColumn("g", F.col("time") if transform == "identity" else F.log("time"))
    else:
        raise ValueError("transform must be 'km', 'identity' or 'log'")
    d, g = F.col("deaths"), F.col("g")
    means = {f"b{k}_": (F.col(f"s1_{k}") * F.col("a1") - F.col(f"d1_{k}") * F.col("a2")) / d for k in range(p)}
    t = t.withColumns(means)
    res = [F.col(f"dx{k}") - d * F.col(f"b{k}_") for k in range(p)]
    aggs = [F.sum(d).alias("n"), F.sum(d * g).alias("g1"), F.sum(d * g * g).alias("g2")]
    aggs += [F.sum(res[k]).alias(f"r{k}") for k in range(p)] + [F.sum(g * res[k]).alias(f"gr{k}") for k in range(p)]
    for j, k in _pairs(p):
        bj, bk = F.col(f"b{j}_"), F.col(f"b{k}_")
        aggs.append(
            F.sum(F.col(f"xx{j}_{k}") - F.col(f"dx{j}") * bk - bj * F.col(f"dx{k}") + d * bj * bk).alias(f"rr{j}_{k}")
        )
    row = t.agg(*aggs).first().asDict()
    n, gbar = row["n"], row["g1"] / row["n"]
    ssg = row["g2"] - n * gbar * gbar
    graw = np.array([row[f"gr{k}"] - gbar * row[f"r{k}"] for k in range(p)])
    rr = np.zeros((p, p))
    for j, k in _pairs(p):
        rr[j, k] = rr[k, j] = row[f"rr{j}_{k}"]
    v = fit.scaled_vcov
    gs = n * v @ graw
    ssr = np.diag(n * n * v @ rr @ v)
    out = []
    for k, term in enumerate(fit.terms):
        chi2 = float(gs[k] ** 2 / (v[k, k] * n * ssg))
        out.append((term.name, float(gs[k] / math.sqrt(ssg * ssr[k])), chi2, 1, chi2_sf(chi2, 1)))
    chi2 = float(graw @ v @ graw * n / ssg)
    out.append(("GLOBAL", None, chi2, p, chi2_sf(chi2, p)))
    return fit.spark.createDataFrame(out, "term string, rho double, chisq double, df int, p double")
