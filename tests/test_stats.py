"""Distribution tails vs published tables; algebraic checks of ANOVA, OLS, REML."""

import math

import numpy as np
import pytest

from hrlens.operators.stats import anova, dist, mixed, ols


@pytest.mark.parametrize("q,k,nu,p", [(3.578, 3, 20, 0.95), (3.958, 4, 20, 0.95), (8.331, 3, 2, 0.95),
                                      (4.602, 3, 5, 0.95), (5.218, 4, 5, 0.95), (2.772, 2, 1e9, 0.95),
                                      (5.599, 10, 10, 0.95)])
def test_studentized_range_table(q, k, nu, p):
    assert dist.ptukey(q, k, nu) == pytest.approx(p, abs=2e-4)


def test_f_t_tails():
    assert dist.f_sf(4.0, 3, 20) == pytest.approx(0.022077, abs=1e-6)
    assert dist.t_ppf(0.975, 20) == pytest.approx(2.085963, abs=1e-6)
    assert dist.t_sf2(2.0, 5) == pytest.approx(0.101939, abs=1e-6)
    assert dist.chi2_sf_2df(2 * math.log(20)) == pytest.approx(0.05)


def test_anova_two_groups_equals_t_squared(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 30), rng.normal(0.5, 1, 20)
    df = spark.createDataFrame([("a", float(x)) for x in a] + [("b", float(x)) for x in b], "g string, y double")
    f = anova.anova_oneway(df, "g", "y").first()["f_stat"]
    sp = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    t = (a.mean() - b.mean()) / math.sqrt(sp * (1 / len(a) + 1 / len(b)))
    assert f == pytest.approx(t * t, rel=1e-9)


def test_anova_planted_edges(spark):
    # one-row group, all-equal group, NULL value and NULL group are tolerated
    rows = [("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 5.0), ("c", 2.0), ("c", 4.0), ("c", None), (None, 9.0)]
    t = anova.anova_oneway(spark.createDataFrame(rows, "g string, y double"), "g", "y").first()
    assert t["n_groups"] == 3 and t["n_total"] == 6
    assert t["ss_within"] == pytest.approx(2.0)


def test_tukey_pvalue_consistency(spark):
    rng = np.random.default_rng(2)
    rows = [(g, float(x)) for g, mu in (("a", 0), ("b", 0.3), ("c", 1.0)) for x in rng.normal(mu, 1, 40)]
    out = anova.tukey_hsd(spark.createDataFrame(rows, "g string, y double"), "g", "y").collect()
    assert len(out) == 3
    for r in out:
        # the CI excludes 0 exactly when the pair is rejected
        assert r["reject"] == (r["lower"] > 0 or r["upper"] < 0)
        assert (r["p_adj"] < 0.05) == r["reject"]


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(3)
    n = 200
    x1 = rng.normal(2000, 3, n)
    x2 = rng.normal(0, 1, n)
    y = 5 + 0.5 * x1 - 2 * x2 + rng.normal(0, 1, n)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))],
                               "k long, x1 double, x2 double, y double")
    fit = ols.ols_fit(df, "y", ["x1", "x2"], order_key="k")
    X = np.column_stack([np.ones(n), x1, x2])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert np.allclose(fit.coef, beta, rtol=1e-8, atol=1e-8)
    e = y - X @ beta
    assert fit.extra["durbin_watson"] == pytest.approx(np.sum(np.diff(e) ** 2) / np.sum(e ** 2), rel=1e-9)
    s2 = e @ e / (n - 3)
    assert np.allclose(fit.std_err, np.sqrt(np.diag(s2 * np.linalg.inv(X.T @ X))), rtol=1e-6)


def _dense_reml(X, y, groups, theta):
    n, p = X.shape
    V = np.eye(n)
    for g in np.unique(groups):
        idx = np.where(groups == g)[0]
        V[np.ix_(idx, idx)] += theta
    Vi = np.linalg.inv(V)
    A = X.T @ Vi @ X
    beta = np.linalg.solve(A, X.T @ Vi @ y)
    r = y - X @ beta
    s2 = r @ Vi @ r / (n - p)
    ll = -0.5 * ((n - p) * (math.log(2 * math.pi * s2) + 1) + np.linalg.slogdet(V)[1] + np.linalg.slogdet(A)[1])
    return ll, beta


def test_reml_bucketed_equals_dense(spark):
    rng = np.random.default_rng(4)
    sizes = [3, 5, 5, 8, 3, 12, 7]
    rows, g_all, x_all, y_all = [], [], [], []
    for g, m in enumerate(sizes):
        u = rng.normal(0, 0.7)
        for _ in range(m):
            x = rng.normal() + 2000
            y = 1 + 2 * x + u + rng.normal(0, 1)
            rows.append((g, float(x), float(y)))
            g_all.append(g), x_all.append(x), y_all.append(y)
    df = spark.createDataFrame(rows, "g int, x double, y double")
    n = len(y_all)
    shifted, shift = mixed._prep(df, "g", "y", ["x"])
    T, buckets, _ = mixed.sufficient_stats(shifted, "g", ["__one", "x", "y"])
    T, buckets, m = mixed.centred_stats(T, buckets)
    assert shift["x"] + m[1] == pytest.approx(np.mean(x_all)) and shift["y"] + m[2] == pytest.approx(np.mean(y_all))
    Xc = np.column_stack([np.ones(n), np.array(x_all) - np.mean(x_all)])
    yc = np.array(y_all) - np.mean(y_all)
    assert np.allclose(T, np.column_stack([Xc, yc]).T @ np.column_stack([Xc, yc]))
    for theta in (0.0, 0.5, 2.6):
        ll_b = mixed.reml_profile(T, buckets, n, theta)[0]
        ll_d = _dense_reml(Xc, yc, np.array(g_all), theta)[0]
        assert ll_b == pytest.approx(ll_d, rel=1e-10)
        step = 1e-6 * (1 + theta)
        if theta:
            up, down = (mixed.reml_profile(T, buckets, n, theta + s)[0] for s in (step, -step))
            assert mixed.reml_slope(T, buckets, n, theta) == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-6)
    fit, gs = mixed.fit_random_intercept(df, "g", "y", ["x"])
    assert fit.beta[1] == pytest.approx(2.0, abs=0.5)
    blups = {r["g"]: r["random_effect"] for r in mixed.random_effects(fit, gs, "g").collect()}
    assert len(blups) == len(sizes)
    assert abs(mixed.reml_slope(T, buckets, n, fit.theta)) < 1e-6
    with pytest.raises(ValueError):
        mixed.fit_random_intercept(df.where("g > 99"), "g", "y", ["x"])


def test_tukey_single_group_has_no_pairs(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, y double")
    assert anova.tukey_table(df, "g", "y").count() == 0


def test_tukey_without_error_df_is_nan(spark):
    # one row per group: no within-group degrees of freedom; no task failure
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.0)], "g string, y double")
    rows = anova.tukey_hsd(df, "g", "y").collect()
    assert len(rows) == 3 and all(r["p_adj"] is None or r["p_adj"] != r["p_adj"] for r in rows)
    assert math.isnan(dist.qtukey(0.95, 3, 0)) and math.isnan(dist.ptukey(2.0, 3, 0))
    assert math.isnan(dist.psturng(2.0, 3, 0))


def test_rater_reports_on_any_table(spark):
    """The rater analysis runs on a user's own table (FIXTURES A5 columns), rows incomplete dropped."""
    from hrlens.plans.rater import rater_reports
    rng = np.random.default_rng(12)
    rows = []
    for r in range(30):
        eff = rng.normal(0, 0.5)
        for e in range(20):
            rows.append((r * 100 + e, r, float(3 + eff + rng.normal(0, 1)), ["S", "E"][e % 2], ["J", "M"][e % 3 == 0],
                         float(rng.random()), float(rng.random()), float(20 + e), float(e % 7)))
    rows.append((9999, 1, None, "S", "J", 0.1, 0.1, 30.0, 1.0))
    df = spark.createDataFrame(rows, "employee_id long, rater_id long, rating_score double, department string, "
                                     "job_level string, performance_true double, goal_difficulty double, "
                                     "age double, tenure_years double")
    r = rater_reports(df)
    assert r["adjusted"].count() == 600 and r["bias"].count() == 30
    icc = r["icc"].first()
    assert 0 < icc["icc"] < 1 and icc["n_obs"] == 600
    terms = [x["term"] for x in r["mixed"].collect()]
    assert terms[:3] == ["Intercept", "C(department)[T.S]", "C(job_level)[T.M]"] and terms[-1] == "Group Var"


def frame(spark, x, names, parts=5):
    return spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in names)).repartition(parts)


@pytest.mark.parametrize("k", [2, 60])
def test_r_factor_of_an_ill_conditioned_design(spark, k):
    """The merged factor is the dense QR's, where normal equations would have lost all digits."""
    from hrlens.operators.stats import qr
    rng = np.random.default_rng(k)
    n = 700
    x = rng.normal(size=(n, k)) * np.logspace(0, 6, k) + 2000
    x[:, -1] = x[:, 0] + 1e-5 * rng.normal(size=n)  # scaled, a condition number of some 1e9
    y = x @ rng.normal(size=k) + rng.normal(size=n)
    names = [f"c{i}" for i in range(k)]
    rows, r = qr.r_factor(frame(spark, np.column_stack([x, y]), [*names, "y"]), [*names, "y"])
    dense = np.linalg.qr(np.column_stack([np.ones(n), x, y]), mode="r")
    dense *= np.where(np.diag(dense) < 0, -1, 1)[:, None]
    assert rows == n and np.allclose(r, dense, rtol=1e-5, atol=1e-9 * np.abs(dense).max(axis=0))
    s = qr.solve(r)
    a = np.column_stack([np.ones(n), x])
    want = np.linalg.lstsq(a / np.linalg.norm(a, axis=0), y, rcond=None)[0] / np.linalg.norm(a, axis=0)
    assert np.allclose(a @ s.coef, a @ want, rtol=1e-9, atol=1e-6)
    assert s.ssr == pytest.approx(np.sum((y - a @ want) ** 2), rel=1e-6) and not s.collinear


def test_collinear_columns_are_named(spark):
    rng = np.random.default_rng(4)
    n = 300
    x, level = rng.normal(2000, 3, n), rng.integers(0, 3, n)
    dummies = (level[:, None] == np.arange(3)).astype(float)  # all levels beside the constant
    y = 3 * x + level + rng.normal(size=n)
    df = frame(spark, np.column_stack([x, 2 * x - 7, dummies, np.zeros(n), y]), ["x", "twice", "a", "b", "c", "none", "y"])
    fit = ols.ols_fit(df, "y", ["x", "twice", "a", "b", "c", "none"], diagnostics=False)
    assert fit.extra["singular"] and len(fit.extra["collinear"]) == 3 and "none" in fit.extra["collinear"]
    assert len({"x", "twice"} & set(fit.extra["collinear"])) == 1
    design = np.column_stack([np.ones(n), x, 2 * x - 7, dummies, np.zeros(n)])
    want = np.linalg.pinv(design, rcond=1e-12) @ y
    assert np.allclose(design @ fit.coef, design @ want, rtol=1e-9) and fit.df_resid == n - 4
    assert fit.ssr == pytest.approx(np.sum((y - design @ want) ** 2), rel=1e-9)


def test_fewer_rows_than_columns_and_none(spark):
    df = frame(spark, [[1, 2, 3, 4], [2, 1, 5, 9]], ["a", "b", "c", "y"], 2)
    fit = ols.ols_fit(df, "y", ["a", "b", "c"], diagnostics=False)
    assert fit.n == 2 and fit.df_resid == 0 and fit.ssr == pytest.approx(0, abs=1e-9)
    with pytest.raises(ValueError):
        ols.ols_fit(df.where("a > 5"), "y", ["a"], diagnostics=False)


# a factor of any cardinality
def dummy_fit(x, level, y):
    """Coefficients and errors by a dense dummy-coded design, levels in string order, the first as reference."""
    names = sorted(set(level))
    design = np.column_stack([np.ones(len(y)), x, *[(level == v).astype(float) for v in names[1:]]])
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    e = y - design @ beta
    cov = e @ e / (len(y) - design.shape[1]) * np.linalg.inv(design.T @ design)
    return dict(zip(["const", "x1", "x2", *[f"f_{v}" for v in names[1:]]], zip(beta, np.sqrt(np.diag(cov)))))


def test_absorbed_factor_equals_dummy_coding(spark):
    from hrlens.operators.stats import absorb
    rng = np.random.default_rng(8)
    n = 400
    level = np.array([f"L{min(i, 30)}" for i in rng.integers(0, 45, n)])  # one level holds a third of the rows
    x = np.column_stack([rng.normal(2000, 3, n), rng.normal(size=n)])
    y = x @ [0.5, -2] + np.array([hash(v) % 7 for v in level]) + rng.normal(size=n)
    rows = [(v, float(a), float(b), float(c)) for v, (a, b), c in zip(level, x, y)]
    rows += [(None, 1.0, 1.0, 1.0), ("L1", None, 1.0, 1.0), ("L2", 1.0, float("nan"), 1.0), ("L3", 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "f string, x1 double, x2 double, y double").repartition(4)
    fit = absorb.fit_absorbed(df, "y", ["x1", "x2"], "f")
    want = dummy_fit(x, level, y)
    got = {r["term"]: r for r in absorb.coef_table(fit).collect()}
    assert got.keys() == want.keys() and fit.df_resid == n - len(set(level)) - 2
    from hrlens.operators.stats.dist import t_sf2
    for t, (b, se) in want.items():
        assert got[t]["coef"] == pytest.approx(b, rel=1e-6, abs=1e-6) and got[t]["std_err"] == pytest.approx(se, rel=1e-6)
        assert got[t]["p_value"] == pytest.approx(t_sf2(b / se, fit.df_resid), rel=1e-4, abs=1e-9)
    assert fit.sst == pytest.approx(np.sum((y - y.mean()) ** 2), rel=1e-9)
    own = {r["level"]: r["coef"] for r in absorb.level_effects(fit).collect()}
    assert own["L5"] - own["L0"] == pytest.approx(want["f_L5"][0], rel=1e-6)


def test_absorbs_a_hundred_thousand_levels(spark):
    from pyspark.sql import functions as F
    from hrlens.operators.stats import absorb
    levels = 100_000
    df = spark.range(3 * levels).select(
        (F.col("id") % levels).alias("f"), (F.xxhash64("id") % 1000 / 100.0).alias("x1"), (F.xxhash64("id", F.lit(1)) % 1000 / 100.0).alias("x2"),
        (F.col("id") % levels % 13).alias("effect"))
    df = df.withColumn("y", 1.5 * F.col("x1") - 0.5 * F.col("x2") + F.col("effect"))
    fit = absorb.fit_absorbed(df, "y", ["x1", "x2"], "f")
    assert np.allclose(fit.coef, [1.5, -0.5], atol=1e-9) and fit.n_levels == levels and fit.df_resid == 2 * levels - 2
    effects = absorb.level_effects(fit)
    assert effects.count() == levels
    assert effects.where(F.abs(F.col("coef") - F.col("level") % 13) > 1e-7).count() == 0
    assert absorb.coef_table(fit).count() == levels + 2


def test_absorbed_column_without_spread(spark):
    from hrlens.operators.stats import absorb
    rows = [(i % 5, float(i % 5) * 1.1, float(i % 7), float(i % 7) * 2 + i % 5 + (i % 3) * 0.1) for i in range(100)]
    fit = absorb.fit_absorbed(spark.createDataFrame(rows, "f int, same double, x double, y double"), "y", ["same", "x"], "f")
    assert fit.collinear == ["same"] and fit.coef[0] == 0 and fit.df_resid == 100 - 5 - 1


# bootstrap
def test_bootstrap_replicates_by_hand(spark):
    import hashlib
    from hrlens.operators.stats import bootstrap as B
    rng = np.random.default_rng(6)
    x = rng.normal(50, 10, 150)
    y = 3 + 2 * x + rng.normal(0, 5, 150)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*rows, (900, None, 1.0), (901, 1.0, float("nan")), (None, 1.0, 1.0)], "id long, x double, y double")
    lines = {r["replicate"]: r for r in B.line_replicates(df.repartition(4), "x", "y", "id", 40, 7).collect()}
    again = {r["replicate"]: r for r in B.line_replicates(df.coalesce(1), "x", "y", "id", 40, 7).collect()}
    p = 2 ** 31 - 1

    def number(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % p
    cdf = np.cumsum([np.exp(-1) / np.prod(np.arange(1, w + 1)) for w in range(12)])
    every = []
    for b in range(40):
        a, c = 1 + number(f"a:{b}:7") % (p - 1), number(f"b:{b}:7")
        w = np.array([np.sum((number(str(i)) * a + c) % p >= np.ceil(cdf * p)) for i in range(150)])
        every.append(w)
        slope, intercept = np.polyfit(x, y, 1, w=np.sqrt(w))
        assert lines[b]["slope"] == pytest.approx(slope, rel=1e-8) and lines[b]["intercept"] == pytest.approx(intercept, rel=1e-7)
        assert again[b]["slope"] == pytest.approx(slope, rel=1e-8)
    every = np.concatenate(every)
    assert abs(every.mean() - 1) < 0.05 and abs(every.var() - 1) < 0.1


def test_bootstrap_band_covers_like_the_analytic_one(spark):
    from hrlens.operators.stats import bootstrap as B
    rng = np.random.default_rng(9)
    x = rng.uniform(0, 10, 3000)
    y = 1 + x + rng.normal(0, 2, 3000)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, x double, y double")
    boot = B.bootstrap_band(B.line_replicates(df, "x", "y", "id", 1000), 0, 10, 11)
    fit = ols.ols_fit(df, "y", ["x"], diagnostics=False)
    band = ols.band_frame(fit, "x", 0, 10, 11)
    assert np.allclose(boot["upper"] - boot["lower"], band["upper"] - band["lower"], rtol=0.15)
    empty = B.line_replicates(df.where("id < 0"), "x", "y", "id", 5)
    assert B.bootstrap_band(empty, 0, 1, 3)["lower"].isna().all()
