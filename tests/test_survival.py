import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazardline.operators import cox as C
from hazardline.operators import kaplan_meier as K
from hazardline.operators import tiles

ARM = {"arm": ["No", "Yes"]}


@pytest.fixture(scope="module")
def cohort():
    rng = np.random.default_rng(1)
    n = 300
    x, age = rng.integers(0, 2, n), rng.normal(60, 10, n)
    t = np.round(rng.exponential(15 * np.exp(-0.5 * x - 0.02 * (age - 60)))) + 1
    e = (rng.random(n) < 0.7).astype(int)
    return pd.DataFrame({"t": t, "e": e, "x": x, "age": age, "arm": np.where(x == 1, "Yes", "No")})


@pytest.fixture(scope="module")
def df(spark, cohort):
    return spark.createDataFrame(cohort)


def dense(X, t, e, at_time=None, steps=12):
    """Plain Newton with Efron ties; ``at_time`` gives the covariates at an event time."""
    b, p = np.zeros(X.shape[1]), X.shape[1]
    for _ in range(steps):
        ll, u, info, ll_first = 0.0, np.zeros(p), np.zeros((p, p)), None
        for s in np.unique(t[e == 1]):
            Z = X if at_time is None else at_time(X, s)
            w = np.exp(Z @ b) * (t >= s)
            dead = (t == s) & (e == 1)
            d = dead.sum()
            ll += (Z[dead] @ b).sum()
            u += Z[dead].sum(0)
            for k in range(d):
                v = w - (k / d) * w * dead
                s0, m = v.sum(), v @ Z / v.sum()
                ll -= math.log(s0)
                u -= m
                info += (Z * v[:, None]).T @ Z / s0 - np.outer(m, m)
        b = b + np.linalg.solve(info, u)
    return b, np.linalg.inv(info), ll


def test_km_textbook(spark):
    curve = K.kaplan_meier(spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, 1), (None, 1), (4.0, None)], "t double, e int"), "t", "e")
    got = [(r["time"], round(r["survival"], 6), r["n_risk"]) for r in curve.orderBy("time").collect()]
    assert got == [(1.0, 0.666667, 3), (2.0, 0.666667, 2), (3.0, 0.0, 1)]
    last = curve.orderBy(F.desc("time")).first()
    assert last["lower"] is None and last["std_err"] is None
    assert K.median_survival(curve).first()["median"] == 3.0


def test_median_midpoint_and_not_reached(spark):
    flat = K.kaplan_meier(spark.createDataFrame([(1.0, 1), (3.0, 1), (5.0, 1), (7.0, 1)], "t double, e int"), "t", "e")
    assert K.median_survival(flat).first()["median"] == 4.0
    assert K.median_survival(flat, scale="m_y").first()["median"] == pytest.approx(4 / 12)
    none = K.kaplan_meier(spark.createDataFrame([(1.0, 0), (3.0, 0)], "t double, e int"), "t", "e")
    row = K.median_text(K.median_survival(none)).first()
    assert row["median"] is None and row["median_text"] == "NR"


def test_km_segments_and_properties(df):
    plain = K.kaplan_meier(df, "t", "e", ["arm"]).orderBy("arm", "time").toPandas()
    cut = K.kaplan_meier(df, "t", "e", ["arm"], floor=10).orderBy("arm", "time").toPandas()
    pd.testing.assert_frame_equal(plain, cut)
    for _, g in plain.groupby("arm"):
        assert (g["survival"].diff().dropna() <= 1e-12).all() and g["survival"].between(0, 1).all()


def test_survival_at_before_first_and_after_last(df):
    curve = K.kaplan_meier(df, "t", "e")
    got = {r["time"]: r["survival"] for r in K.survival_at(curve, times=[0.5, 10, 1e6]).collect()}
    assert got[0.5] == 100.0 and 1e6 not in got
    assert {round(r["time"], 2) for r in K.survival_at(curve, scale="m_y").collect()} <= {12.0, 24.0, 60.0}
    with pytest.raises(ValueError):
        K.survival_at(curve, scale="w_y")


def test_risk_table(df, cohort):
    got = {r["time"]: (r["n_risk"], r["cum_events"]) for r in K.risk_table(K.kaplan_meier(df, "t", "e"), step=5, x_end=20).collect()}
    for b in (0.0, 5.0, 10.0, 15.0, 20.0):
        assert got[b] == ((cohort.t >= b).sum(), ((cohort.t <= b) & (cohort.e == 1)).sum())


def test_logrank_known_value_and_label_swap(spark):
    """The leukaemia remission data of Freireich et al. (1963)."""
    treated = [(6, 1), (6, 1), (6, 1), (6, 0), (7, 1), (9, 0), (10, 1), (10, 0), (11, 0), (13, 1), (16, 1), (17, 0), (19, 0), (20, 0), (22, 1), (23, 1), (25, 0), (32, 0), (32, 0), (34, 0), (35, 0)]
    control = [1, 1, 2, 2, 3, 4, 4, 5, 5, 8, 8, 8, 8, 11, 11, 12, 12, 15, 17, 22, 23]
    rows = [(float(t), e, "b") for t, e in treated] + [(float(t), 1, "a") for t in control]
    data = spark.createDataFrame(rows, "t double, e int, g string")
    one = K.logrank(data, "t", "e", "g").collect()
    assert one[0]["chisq"] == pytest.approx(16.79, abs=0.005)
    swapped = K.logrank(data.withColumn("g", F.when(F.col("g") == "a", "z").otherwise("b")), "t", "e", "g").collect()
    assert swapped[0]["chisq"] == pytest.approx(one[0]["chisq"])
    assert K.pairwise_logrank(data, "t", "e", "g").first()["chisq"] == pytest.approx(one[0]["chisq"])
    with pytest.raises(ValueError):
        K.logrank(data.where("g = 'a'"), "t", "e", "g")


@pytest.mark.parametrize("x,df_,p", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (11.344866730144373, 3, 0.01), (18.307038053275146, 10, 0.05)])
def test_chi_square_tail(x, df_, p):
    assert K.chi2_sf(x, df_) == pytest.approx(p, rel=1e-9)
    assert K.chi2_sf(0, df_) == 1 and math.isnan(K.chi2_sf(1, 0))


@pytest.fixture(scope="module")
def fit(df):
    return C.cox_fit(df, "t", "e", ["arm", "age"], ARM)


def test_cox_against_dense_newton(fit, cohort):
    b, v, ll = dense(np.c_[cohort.x, cohort.age - 60], cohort.t.to_numpy(), cohort.e.to_numpy())
    assert fit.beta == pytest.approx(b, abs=1e-6)
    assert fit.vcov == pytest.approx(v, rel=1e-5)
    assert fit.loglik == pytest.approx(ll, abs=1e-6)
    row = C._newton_row(C._risk_sums(fit.design, fit.scaled_beta, 2, fit.scan), 2, fit.heavy)
    assert abs(row["u0"]) < 1e-4 and abs(row["u1"]) < 1e-4


def test_heavy_ties_and_cut_times_give_the_same(fit, monkeypatch):
    base = C._newton_row(C._risk_sums(fit.design, fit.scaled_beta, 2, {"bounded": True}), 2, False)
    monkeypatch.setattr(C, "TIE_CHUNK", 2)
    heavy = C._newton_row(C._risk_sums(fit.design, fit.scaled_beta, 2, {"floor": 5}), 2, True)
    assert heavy == pytest.approx(base, rel=1e-9, abs=1e-7)


def test_concordance_against_all_pairs(fit, cohort):
    s = np.round(((np.c_[cohort.x, cohort.age] - fit.mean) / fit.scale) @ fit.scaled_beta, 12)
    t, e = cohort.t.to_numpy(), cohort.e.to_numpy()
    want = np.zeros(3)
    for i in np.flatnonzero(e):
        later = (t > t[i]) | ((t == t[i]) & (e == 0))
        want += [(later & (s < s[i])).sum(), (later & (s > s[i])).sum(), (later & (s == s[i])).sum()]
    got = C.concordance_counts(fit)
    assert [got[k] for k in ("concordant", "discordant", "tied_risk")] == list(want)


def test_concordance_counts_bits_in_several_tasks(fit, monkeypatch):
    whole = C.concordance_counts(fit)
    monkeypatch.setattr(C, "RANKS", 16)
    assert C.concordance_counts(fit) == whole


def test_concordance_with_tied_scores(spark, df, cohort):
    only = C.cox_fit(df, "t", "e", ["arm"], ARM)
    t, e, x = cohort.t.to_numpy(), cohort.e.to_numpy(), cohort.x.to_numpy() * np.sign(only.beta[0])
    want = np.zeros(2)
    for i in np.flatnonzero(e):
        later = (t > t[i]) | ((t == t[i]) & (e == 0))
        want += [(later & (x < x[i])).sum(), (later & (x == x[i])).sum()]
    got = C.concordance_counts(only)
    assert [got["concordant"], got["tied_risk"]] == list(want)


def test_time_varying_effect_both_ways(df, cohort, monkeypatch):
    by_level = C.cox_tt(df, "t", "e", ["arm", "age"], "arm", ARM)
    monkeypatch.setattr(tiles, "BLOCK", 7)
    monkeypatch.setattr(tiles, "BROADCAST_BLOCKS", 0)
    by_row = C.cox_tt(df, "t", "e", ["arm", "age"], "arm", ARM)
    X = np.c_[cohort.x, cohort.age - 60, cohort.x]
    b, v, _ = dense(X, cohort.t.to_numpy(), cohort.e.to_numpy(), lambda z, s: z * np.array([1, 1, math.log1p(s)]))
    assert by_level.beta == pytest.approx(b, abs=1e-5) and by_row.beta == pytest.approx(b, abs=1e-5)
    assert by_level.vcov == pytest.approx(v, rel=1e-4)
    own = C.cox_tt(df, "t", "e", ["age"], "age", tt=lambda x, t: x * t)
    Y = np.c_[cohort.age, cohort.age]
    want, _, _ = dense(Y, cohort.t.to_numpy(), cohort.e.to_numpy(), lambda z, s: z * np.array([1, s]))
    assert own.beta == pytest.approx(want, abs=1e-5)
    curve = C.hr_curve(by_level, "arm", 30.0).orderBy("time").collect()
    assert len(curve) == 200 and curve[0]["hr"] == pytest.approx(math.exp(by_level.beta[0]))


def test_adjusted_curve_against_direct_average(df, fit, cohort, monkeypatch):
    got = C.adjusted_survival(fit, "arm").orderBy("arm", "time").toPandas()
    z = (np.c_[cohort.x, cohort.age] - fit.mean) / fit.scale
    b, t, e = fit.scaled_beta, cohort.t.to_numpy(), cohort.e.to_numpy()
    times, hazard, h = np.unique(t[e == 1]), [], 0.0
    w = np.exp(z @ b)
    for s in times:
        dead = (t == s) & (e == 1)
        for k in range(dead.sum()):
            h += 1 / (w[t >= s].sum() - k / dead.sum() * w[dead].sum())
        hazard.append(h)
    for level, value in (("No", 0), ("Yes", 1)):
        zz = z.copy()
        zz[:, 0] = (value - fit.mean[0]) / fit.scale[0]
        r = np.exp(zz @ b)
        want = [np.exp(-h * r).mean() for h in hazard]
        assert got[got.arm == level]["survival"].to_numpy() == pytest.approx(np.array(want), abs=1e-10)
    monkeypatch.setattr(tiles, "BLOCK", 7)
    monkeypatch.setattr(tiles, "BROADCAST_BLOCKS", 0)
    parts = C.adjusted_survival(fit, "arm").orderBy("arm", "time").toPandas()
    pd.testing.assert_frame_equal(got, parts)
    grid = C.adjusted_survival(fit, "arm", times=[0.5, 10.0]).toPandas()
    assert grid[grid.time == 0.5]["survival"].tolist() == [1.0, 1.0]
    whole = C.adjusted_median(C.adjusted_survival(fit, "arm"), "arm").orderBy("group").collect()
    for sections in (2, 5):
        assert C.adjusted_median_search(fit, "arm", sections).orderBy("group").collect() == whole


def test_unsettled_fits_are_errors(df, monkeypatch):
    monkeypatch.setattr(C, "MAX_STEPS", 1)
    with pytest.raises(ValueError, match="did not settle"):
        C.cox_fit(df, "t", "e", ["arm", "age"], ARM)
    assert not C.cox_fit(df, "t", "e", ["arm", "age"], ARM, unsettled="return").converged


def test_reduced_models_move_together(df, fit):
    got = {r["variable"]: r for r in C.variable_tests(fit).collect()}
    for v, other in (("arm", "age"), ("age", "arm")):
        alone = C.cox_fit(df, "t", "e", [other], ARM if other == "arm" else {})
        assert got[v]["lr"] == pytest.approx(2 * (fit.loglik - alone.loglik), abs=1e-6) and got[v]["df"] == 1


def test_adjusted_curve_without_other_covariates_is_the_model_curve(df):
    only = C.cox_fit(df, "t", "e", ["arm"], ARM)
    got = C.adjusted_survival(only, "arm", times=[10.0]).toPandas().set_index("arm")["survival"]
    h = C.baseline(only).where("time <= 10").agg(F.max("hazard")).first()[0]
    want = {lv: math.exp(-h * math.exp(only.scaled_beta[0] * ((i - only.mean[0]) / only.scale[0]))) for i, lv in enumerate(("No", "Yes"))}
    assert got.to_dict() == pytest.approx(want)


def test_tables(df, fit):
    tests = {r["test"]: r for r in C.global_tests(fit).collect()}
    assert tests["wald"]["statistic"] == pytest.approx(float(fit.beta @ np.linalg.inv(fit.vcov) @ fit.beta))
    assert tests["likelihood_ratio"]["df"] == 2
    forest = C.forest_rows(df, fit).orderBy("place").collect()
    assert [(r["level"], r["reference"]) for r in forest] == [("No", True), ("Yes", False), (None, False)]
    assert forest[0]["hr"] == 1.0 and forest[0]["n"] + forest[1]["n"] == forest[2]["n"] == 300
    table = C.cox_table(fit).collect()
    assert all(0 <= r["global_p"] <= 1 for r in table)
    assert C.covariance(fit).count() == 4


def test_ph_check_against_dense_residuals(df, fit, cohort):
    z = (np.c_[cohort.x, cohort.age] - fit.mean) / fit.scale
    t, e, w = cohort.t.to_numpy(), cohort.e.to_numpy(), np.exp(z @ fit.scaled_beta)
    res, g = [], []
    for s in np.unique(t[e == 1]):
        dead, risk = (t == s) & (e == 1), t >= s
        d = dead.sum()
        mean = np.mean([((w * (risk - k / d * dead)) @ z) / (w * (risk - k / d * dead)).sum() for k in range(d)], axis=0)
        res += list(z[dead] - mean)
        g += [s] * d
    res, g = np.array(res), np.array(g) - np.mean(g)
    v, n = fit.scaled_vcov, len(g)
    scaled = n * res @ v
    got = {r["term"]: r for r in C.ph_check(df, fit, "identity").collect()}
    for k, name in enumerate(("armYes", "age")):
        assert got[name]["rho"] == pytest.approx(np.corrcoef(g, scaled[:, k])[0, 1], abs=1e-4)
        assert got[name]["chisq"] == pytest.approx((g @ scaled[:, k]) ** 2 / (v[k, k] * n * (g @ g)), rel=1e-3)
    assert {r["term"] for r in C.ph_check(df, fit).collect()} == {"armYes", "age", "GLOBAL"}
    with pytest.raises(ValueError):
        C.ph_check(df, fit, "rank")


def test_unknown_levels_and_missing_rows_are_left_out(df):
    more = df.unionByName(df.limit(5).withColumn("arm", F.lit("Maybe"))).unionByName(df.limit(3).withColumn("age", F.lit(None).cast("double")))
    assert C.cox_fit(more, "t", "e", ["arm", "age"], ARM).n == 300
    with pytest.raises(ValueError):
        C.cox_fit(df.where("false"), "t", "e", ["age"])


def test_many_groups_against_dense_logrank(spark, monkeypatch):
    rng = np.random.default_rng(5)
    g, t, e = rng.integers(0, 90, 900), rng.integers(1, 40, 900).astype(float), rng.integers(0, 2, 900)
    df = spark.createDataFrame(pd.DataFrame({"t": t, "e": e, "g": [f"g{x:03d}" for x in g]}))
    levels = np.unique(g)
    k = len(levels)
    o, x, v = np.zeros(k), np.zeros(k), np.zeros((k, k))
    for s in np.unique(t[e == 1]):
        n = np.array([((g == a) & (t >= s)).sum() for a in levels], float)
        d = np.array([((g == a) & (t == s) & (e == 1)).sum() for a in levels], float)
        N, D = n.sum(), d.sum()
        o, x = o + d, x + D * n / N
        if N > 1:
            v += D * (N - D) / (N - 1) * (np.diag(n / N) - np.outer(n, n) / N**2)
    u = (o - x)[:-1]
    chi2 = u @ np.linalg.pinv(v[:-1, :-1]) @ u
    monkeypatch.setattr(tiles, "BLOCK", 5)
    got = K.logrank(df, "t", "e", "g").orderBy("g").collect()
    assert len(got) == k > 64 and [r["observed"] for r in got] == list(o)
    assert [r["expected"] for r in got] == pytest.approx(list(x)) and got[0]["chisq"] == pytest.approx(chi2) and got[0]["df"] == k - 1
    pairs = K.pairwise_logrank(df, "t", "e", "g")
    assert pairs.count() == k * (k - 1) // 2
    two = df.where("g in ('g003', 'g017')")
    assert pairs.where("group1 = 'g003' and group2 = 'g017'").first()["chisq"] == pytest.approx(K.logrank(two, "t", "e", "g").first()["chisq"])


def test_pairwise_jobs_do_not_grow_with_groups(spark):
    tracker = spark.sparkContext.statusTracker()

    def jobs(groups: int) -> int:
        rows = [(float(i % 17 + 1), i % 2, f"g{i % groups}") for i in range(200)]
        df = spark.createDataFrame(rows, "t double, e int, g string")
        spark.sparkContext.setJobGroup(f"pairs-{groups}", "")
        K.pairwise_logrank(df, "t", "e", "g")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"pairs-{groups}"))

    assert jobs(3) == jobs(12)


def test_risk_table_by_stratum_with_fine_breaks(df, cohort):
    got = K.risk_table(K.kaplan_meier(df, "t", "e", ["arm"]), ["arm"], step=0.25, x_end=40).collect()
    assert len(got) == 2 * 161
    for r in got:
        own = cohort[cohort.x == (r["arm"] == "Yes")]
        assert r["n_risk"] == (own.t >= r["time"]).sum() and r["cum_events"] == ((own.t <= r["time"]) & (own.e == 1)).sum()
