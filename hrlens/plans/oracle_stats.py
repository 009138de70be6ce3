"""DuckDB oracle SQL for the statistics keys that SQL can express.

F tables, Tukey pair statistics and simple-regression coefficients are
closed-form aggregates; F and t tails are summed by Simpson's rule
(``oracle_tails``), which shares nothing with the continued fraction of
``operators/stats/dist.py``.
"""

from __future__ import annotations

from ..operators.stats import bootstrap
from .oracle_tails import beta_tail, t_quantile
from .oracle_views import PAY_WON, sig, with_views
from .registry import PARAMS as P


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _large(extra_where: str = "") -> str:
    return (f"SELECT est_id, industry_code, region_code, headcount, {PAY_WON} AS annual_pay, "
            f"{PAY_WON} / 10000 AS annual_pay_10k, CAST(year(start_date) AS DOUBLE) AS year FROM est "
            f"WHERE status_code = 1 AND headcount >= {P['summary_min_headcount']} {extra_where}")


RATERS = ("SELECT * FROM ratings WHERE employee_id IS NOT NULL AND rater_id IS NOT NULL AND rating_score IS NOT NULL "
          "AND department IS NOT NULL AND job_level IS NOT NULL AND performance_true IS NOT NULL "
          "AND goal_difficulty IS NOT NULL AND age IS NOT NULL AND tenure_years IS NOT NULL")


def _anova(views: str, base: str, grp: str, y: str, factor: str) -> str:
    return views + (
        f", g AS (SELECT {grp} AS grp, count(y) AS n, avg(y) AS m, var_samp(y) AS v FROM "
        f"(SELECT {grp}, CAST({y} AS DOUBLE) AS y FROM ({base}) b0) b "
        f"WHERE {grp} IS NOT NULL AND y IS NOT NULL AND NOT isnan(y) GROUP BY {grp})\n"
        f"SELECT '{factor}' AS factor, n_groups, n_total, n_groups - 1 AS df_between, n_total - n_groups AS df_within, "
        f"{sig('ssb')} AS ss_between, {sig('ssw')} AS ss_within, {sig('ssb / (n_groups - 1)')} AS ms_between, "
        f"{sig('ssw / (n_total - n_groups)')} AS ms_within, "
        f"{sig('(ssb / (n_groups - 1)) / (ssw / (n_total - n_groups))')} AS f_stat FROM ("
        f"SELECT count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_total, "
        f"sum(n * pow(m - (SELECT sum(n * m) / sum(n) FROM g), 2)) AS ssb, "
        f"sum((n - 1) * COALESCE(v, 0.0)) AS ssw FROM g) s")


def _tukey(views: str, base: str, grp: str, y: str) -> str:
    return views + (
        f", g AS (SELECT {grp} AS grp, count(y) AS n, avg(y) AS m, var_samp(y) AS v FROM "
        f"(SELECT {grp}, CAST({y} AS DOUBLE) AS y FROM ({base}) b0) b "
        f"WHERE {grp} IS NOT NULL AND y IS NOT NULL AND NOT isnan(y) GROUP BY {grp}), "
        f"msw AS (SELECT sum((n - 1) * COALESCE(v, 0.0)) / (sum(n) - count(*)) AS msw FROM g), "
        f"p AS (SELECT a.grp AS group1, b.grp AS group2, a.n AS n1, b.n AS n2, b.m - a.m AS md, "
        f"sqrt((SELECT msw FROM msw) / 2 * (1.0 / a.n + 1.0 / b.n)) AS se FROM g a JOIN g b ON a.grp < b.grp)\n"
        f"SELECT group1, group2, n1, n2, {sig('md')} AS meandiff, {sig('se')} AS std_pair, "
        f"{sig('abs(md) / se')} AS q_stat FROM p ORDER BY group1, group2")


def _anova_test(views: str, base: str, grp: str, y: str, factor: str, alpha: float = 0.05) -> str:
    return views + (
        f", g AS (SELECT {grp} AS grp, count(y) AS n, avg(y) AS m, var_samp(y) AS v FROM "
        f"(SELECT {grp}, CAST({y} AS DOUBLE) AS y FROM ({base}) b0) b "
        f"WHERE {grp} IS NOT NULL AND y IS NOT NULL AND NOT isnan(y) GROUP BY {grp}), "
        f"s AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) - count(*) AS dfw, "
        f"sum(n * pow(m - (SELECT sum(n * m) / sum(n) FROM g), 2)) AS ssb, "
        f"sum((n - 1) * COALESCE(v, 0.0)) AS ssw FROM g), "
        f"f AS (SELECT *, (ssb / (k - 1)) / (ssw / dfw) AS f FROM s), "
        f"src AS (SELECT 0 AS id, dfw / 2.0 AS a, (k - 1) / 2.0 AS b, ssb / ssw AS z FROM f WHERE k > 1), "
        f"{beta_tail('src', 'tail')}\n"
        f"SELECT '{factor}' AS factor, k AS n_groups, k - 1 AS df_between, dfw AS df_within, {sig('f')} AS f_stat, "
        f"{sig('p')} AS p_value, p < {alpha} AS significant, "
        f"CASE WHEN k < 2 THEN 'not enough groups' WHEN p < {alpha} THEN 'group means differ' "
        f"WHEN p >= {alpha} THEN 'no significant difference' END AS verdict FROM f LEFT JOIN tail ON true")


def _ols_ctes(x: str) -> str:
    """d (the rows), e (sums, slope, intercept, residual variance) and t (coefficients) of y ~ x."""
    return with_views("est") + (
        f", d AS (SELECT est_id, CAST({x} AS DOUBLE) AS x, annual_pay AS y FROM ({_large()}) b "
        f"WHERE {x} IS NOT NULL AND annual_pay IS NOT NULL AND NOT isnan(annual_pay)), "
        f"s AS (SELECT CAST(regr_count(y, x) AS DOUBLE) AS n, regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0, "
        f"regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, regr_avgx(y, x) AS mx FROM d), "
        f"e AS (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS s2, n - 2.0::DOUBLE AS nu FROM s), "
        f"t AS (SELECT 0 AS id, 'const' AS term, b0 AS coef, sqrt(s2 * (1.0 / n + mx * mx / sxx)) AS se, nu FROM e "
        f"UNION ALL SELECT 1 AS id, '{x}' AS term, b1 AS coef, sqrt(s2 / sxx) AS se, nu FROM e)")


def _ols_simple(x: str) -> str:
    return _ols_ctes(x) + f"\nSELECT term, {sig('coef')} AS coef, {sig('se')} AS std_err, {sig('coef / se')} AS t_stat FROM t"


def _ols_report(x: str) -> str:
    return _ols_ctes(x) + (
        f", src AS (SELECT id, nu / 2 AS a, 0.5 AS b, pow(coef / se, 2) / nu AS z FROM t), {beta_tail('src', 'tail')}, "
        f"{t_quantile('e', 'crit')}\n"
        f"SELECT term, {sig('coef')} AS coef, {sig('se')} AS std_err, {sig('coef / se')} AS t_stat, {sig('p')} AS p_value, "
        f"{sig('coef - crit.t * se')} AS ci_low, {sig('coef + crit.t * se')} AS ci_high FROM t JOIN tail USING (id), crit")


def _ols_fit(x: str) -> str:
    """Long form: one row a statistic.  Residual moments, the omnibus transformations and Durbin-Watson by est_id."""
    stats = {
        "n_obs": "n", "df_model": "1", "df_resid": "nu", "r_squared": "r2", "adj_r_squared": "1 - (1 - r2) * (n - 1) / nu",
        "f_statistic": "f", "f_pvalue": "p", "log_likelihood": "ll", "aic": "4 - 2 * ll", "bic": "2 * ln(n) - 2 * ll",
        "omnibus": "zs * zs + zk * zk", "omnibus_pvalue": "exp(-(zs * zs + zk * zk) / 2)", "skew": "skew", "kurtosis": "kurt",
        "jarque_bera": "jb", "jb_pvalue": "exp(-jb / 2)", "durbin_watson": "dw", "cond_no": "cond", "singular": "0"}
    rows = " UNION ALL ".join(f"SELECT '{k}' AS statistic, CAST({v} AS DOUBLE) AS v FROM z" for k, v in stats.items())
    return _ols_ctes(x) + (
        ", r AS (SELECT est_id, y - b0 - b1 * x AS r FROM d, e), "
        "l AS (SELECT r, r - lag(r) OVER (ORDER BY est_id) AS step FROM r), "
        "m0 AS (SELECT avg(r) AS mu FROM r), "
        "m AS (SELECT avg(pow(r - mu, 2)) AS m2, avg(pow(r - mu, 3)) AS m3, avg(pow(r - mu, 4)) AS m4 FROM r, m0), "
        "w AS (SELECT sum(step * step) / sum(r * r) AS dw FROM l), "
        "h AS (SELECT *, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurt, sxy * sxy / (sxx * syy) AS r2, s2 * nu AS ssr, "
        "n * (1 + mx * mx) + sxx AS trace FROM e, m, w), "
        "i AS (SELECT *, r2 / ((1 - r2) / nu) AS f, -n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1) AS ll, "
        "n / 6.0 * (skew * skew + pow(kurt - 3, 2) / 4) AS jb, "
        "(trace + sqrt(trace * trace - 4 * n * sxx)) / 2 / sqrt(n * sxx) AS cond, "
        # skewness to a normal score: Johnson S_U with the moments of the skewness under normality
        "skew * sqrt((n + 1.0) * (n + 3) / (6.0 * (n - 2))) AS ys, "
        "sqrt(2 * (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS ws, "
        # kurtosis to a normal score: cube root of a scaled chi-square
        "(kurt - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) * (n + 1) * (n + 3) * (n + 5))) AS yk, "
        "6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3))) AS sk FROM h), "
        "j AS (SELECT *, 6 + 8 / sk * (2 / sk + sqrt(1 + 4 / (sk * sk))) AS ak FROM i), "
        "src AS (SELECT 0 AS id, nu / 2 AS a, 0.5 AS b, f / nu AS z FROM j), " + beta_tail("src", "tail") + ", "
        "z AS (SELECT *, asinh(ys / sqrt(2 / (ws - 1))) / sqrt(ln(ws) / 2) AS zs, "
        "(1 - 2 / (9 * ak) - cbrt((1 - 2 / ak) / (1 + yk * sqrt(2 / (ak - 4))))) / sqrt(2 / (9 * ak)) AS zk FROM j, tail)\n"
        f"SELECT statistic, {sig('v')} AS value FROM ({rows}) u")


def _ols_line(x: str, points: int = 100) -> str:
    half = "crit.t * sqrt(s2 * (1.0 / n + pow(x - mx, 2) / sxx))"
    return _ols_ctes(x) + (
        f", {t_quantile('e', 'crit')}, "
        f"grid AS (SELECT lo + (hi - lo) * i / {points - 1}.0 AS x FROM (SELECT min(x) AS lo, max(x) AS hi FROM d) b, range({points}) r(i))\n"
        f"SELECT {sig('x')} AS {x}, {sig('(b0 + b1 * x) / 10000')} AS fit, {sig(f'(b0 + b1 * x - {half}) / 10000')} AS lower, "
        f"{sig(f'(b0 + b1 * x + {half}) / 10000')} AS upper FROM grid, e, crit")


def _ols_line_boot(x: str, points: int = 100, replicates: int = 1000, seed: int = 42) -> str:
    """Replicates drawn row by row as in ``operators/stats/bootstrap.py``: same prime, constants and Poisson quantiles."""
    p = bootstrap.PRIME

    def md5_mod(text: str) -> str:
        return f"('0x' || substr(md5({text}), 1, 15))::BIGINT % {p}"
    weight = " + ".join(f"CAST(u >= {t} AS INTEGER)" for t in bootstrap.thresholds())
    return _ols_ctes(x) + (
        f", k AS (SELECT x - mx AS x, y - my AS y, {md5_mod('CAST(est_id AS VARCHAR)')} AS k FROM d, (SELECT avg(x) AS mx, avg(y) AS my FROM d) c), "
        f"c AS (SELECT CAST(i AS INTEGER) AS replicate, 1 + ({md5_mod(f"'a:' || i || ':{seed}'")}) % {p - 1} AS a, {md5_mod(f"'b:' || i || ':{seed}'")} AS b "
        f"FROM range({replicates}) r(i)), "
        f"w AS (SELECT replicate, x, y, CAST({weight} AS DOUBLE) AS w FROM (SELECT replicate, x, y, (k * a + b) % {p} AS u FROM k, c) u), "
        "g AS (SELECT replicate, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM w GROUP BY replicate), "
        "f AS (SELECT *, (n * sxy - sx * sy) / NULLIF(n * sxx - sx * sx, 0) AS slope FROM g), "
        "l AS (SELECT slope, (sy - slope * sx) / n + my - slope * mx AS intercept FROM f, (SELECT avg(x) AS mx, avg(y) AS my FROM d) m WHERE slope IS NOT NULL), "
        f"grid AS (SELECT lo + (hi - lo) * i / {points - 1}.0 AS x FROM (SELECT min(x) AS lo, max(x) AS hi FROM d) b, range({points}) r(i)), "
        "band AS (SELECT x, quantile_cont(intercept + slope * x, 0.025) AS lower, quantile_cont(intercept + slope * x, 0.975) AS upper FROM grid, l GROUP BY x)\n"
        f"SELECT {sig('x')} AS {x}, {sig('(b0 + b1 * x) / 10000')} AS fit, {sig('lower / 10000')} AS lower, {sig('upper / 10000')} AS upper FROM band, e")


def _ols_firm_effects() -> str:
    """The two slopes from deviations from the firms' means (a 2 x 2 system), each firm's coefficient from its means."""
    return with_views("est") + (
        f", d AS (SELECT est_name AS g, CAST(headcount AS DOUBLE) AS x1, CAST(year(start_date) AS DOUBLE) AS x2, {PAY_WON} AS y FROM est "
        "WHERE status_code = 1 AND headcount >= 1 AND start_date IS NOT NULL AND billed_amount IS NOT NULL), "
        "m AS (SELECT g, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM d GROUP BY g), "
        "s AS (SELECT sum((x1 - m1) * (x1 - m1)) AS a, sum((x1 - m1) * (x2 - m2)) AS b, sum((x2 - m2) * (x2 - m2)) AS c, "
        "sum((x1 - m1) * (y - my)) AS p, sum((x2 - m2) * (y - my)) AS q, sum((y - my) * (y - my)) AS yy, count(*) AS n FROM d JOIN m USING (g)), "
        "f AS (SELECT *, (c * p - b * q) / (a * c - b * b) AS b1, (a * q - b * p) / (a * c - b * b) AS b2, a * c - b * b AS det FROM s), "
        "e AS (SELECT *, (yy - b1 * p - b2 * q) / (n - (SELECT count(*) FROM m) - 2) AS s2 FROM f), "
        "r AS (SELECT n AS nr, m1 AS r1, m2 AS r2, my AS ry FROM m ORDER BY g LIMIT 1), "
        "t AS (SELECT CASE WHEN g = (SELECT min(g) FROM m) THEN 'const' ELSE 'firm_' || g END AS term, "
        "CASE WHEN g = (SELECT min(g) FROM m) THEN my - b1 * m1 - b2 * m2 ELSE my - ry - b1 * (m1 - r1) - b2 * (m2 - r2) END AS coef, "
        "CASE WHEN g = (SELECT min(g) FROM m) THEN 0 ELSE 1.0 / nr END + 1.0 / m.n AS inv_n, "
        "CASE WHEN g = (SELECT min(g) FROM m) THEN m1 ELSE m1 - r1 END AS v1, CASE WHEN g = (SELECT min(g) FROM m) THEN m2 ELSE m2 - r2 END AS v2, "
        "s2, a, b, c, det FROM m, r, e "
        "UNION ALL SELECT 'headcount', b1, 0, 1, 0, s2, a, b, c, det FROM e UNION ALL SELECT 'year', b2, 0, 0, 1, s2, a, b, c, det FROM e), "
        "z AS (SELECT term, coef, sqrt(s2 * (inv_n + (c * v1 * v1 - 2 * b * v1 * v2 + a * v2 * v2) / det)) AS se FROM t)\n"
        f"SELECT term, {sig('coef')} AS coef, {sig('se')} AS std_err, {sig('coef / se')} AS t_stat FROM z")


def _multi_ctes() -> str:
    """Normal equations of the centred columns, solved and inverted by Gauss-Jordan steps in a recursive query."""
    base = _large(f"AND industry_code IN ({_in(P['summary_industries'])}) AND region_code IN ({_in(P['summary_regions'])})")
    return "WITH RECURSIVE " + with_views("est").removeprefix("WITH ") + (
        f", b AS (SELECT est_id, annual_pay AS y, CAST(headcount AS DOUBLE) AS h, year, CAST(industry_code AS VARCHAR) AS ind, CAST(region_code AS VARCHAR) AS reg "
        f"FROM ({base}) b0 WHERE annual_pay IS NOT NULL AND year IS NOT NULL), "
        "lv AS (SELECT list_sort(list(DISTINCT ind)) AS li, list_sort(list(DISTINCT reg)) AS lr FROM b), "
        "nm AS (SELECT ['headcount', 'year'] || ['industry_code_' || v FOR v IN li[2:]] || ['region_code_' || v FOR v IN lr[2:]] AS names FROM lv), "
        "rw AS (SELECT est_id, y, [h, year] || [CAST(ind = v AS DOUBLE) FOR v IN li[2:]] || [CAST(reg = v AS DOUBLE) FOR v IN lr[2:]] AS x FROM b, lv), "
        "k AS (SELECT CAST(len(names) AS INTEGER) AS k FROM nm), "
        "lg AS (SELECT CAST(j AS INTEGER) AS j, CASE WHEN j <= k THEN x[j] ELSE y END AS v, r FROM (SELECT *, row_number() OVER () AS r FROM rw) q, k, range(1, 1000) g(j) WHERE j <= k + 1), "
        "mu AS (SELECT j, avg(v) AS mu, count(*) AS n FROM lg GROUP BY j), "
        "cn AS (SELECT lg.j, r, v - mu AS v FROM lg JOIN mu USING (j)), "
        "gm AS (SELECT a.j AS i, b.j AS j, sum(a.v * b.v) AS v FROM cn a JOIN cn b USING (r) GROUP BY a.j, b.j), "
        "ls AS (SELECT i, list(v ORDER BY j) AS v FROM gm, k WHERE i <= k GROUP BY i), "
        # [S | s_y | identity]
        "gj AS (SELECT 0 AS step, list(v || [CAST(q = i AS DOUBLE) FOR q IN range(1, k + 1)] ORDER BY i) AS m FROM ls, k "
        "UNION ALL SELECT step + 1, [[CASE WHEN i = step + 1 THEN m[i][j] / m[step + 1][step + 1] ELSE m[i][j] - m[i][step + 1] * m[step + 1][j] / m[step + 1][step + 1] END "
        "FOR j IN range(1, 2 * k + 2)] FOR i IN range(1, k + 1)] FROM gj, k WHERE step < k), "
        "sv AS (SELECT m, k FROM gj, k WHERE step = k), "
        "co AS (SELECT CAST(i AS INTEGER) AS id, m[i][k + 1] AS coef, m[i][k + 1 + i] AS v FROM sv, range(1, 1000) g(i) WHERE i <= k), "
        "st AS (SELECT (SELECT v FROM gm, k WHERE i = k + 1 AND j = k + 1) - (SELECT sum(coef * v2.v) FROM co JOIN (SELECT i, v FROM gm, k WHERE j = k + 1) v2 ON v2.i = co.id) AS ssr, "
        "CAST((SELECT min(n) FROM mu) - k - 1 AS DOUBLE) AS nu, (SELECT min(n) FROM mu) AS n FROM k), "
        "e AS (SELECT *, ssr / nu AS s2 FROM st), "
        "iv AS (SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, m[i][k + 1 + j] AS v FROM sv, range(1, 1000) g(i), range(1, 1000) h(j) WHERE i <= k AND j <= k), "
        "cs AS (SELECT (SELECT mu FROM mu, k WHERE j = k + 1) - (SELECT sum(coef * mu) FROM co JOIN mu ON mu.j = co.id) AS coef, "
        "(SELECT sum(iv.v * a.mu * b.mu) FROM iv JOIN mu a ON a.j = iv.i JOIN mu b ON b.j = iv.j) + 1.0 / (SELECT n FROM st) AS v), "
        "t AS (SELECT 0 AS id, 'const' AS term, cs.coef, sqrt(s2 * cs.v) AS se, nu FROM cs, e UNION ALL SELECT id, names[id], coef, sqrt(s2 * v), nu FROM co, nm, e)")


def _ols_multi() -> str:
    return _multi_ctes() + (
        f", src AS (SELECT id, nu / 2 AS a, 0.5 AS b, pow(coef / se, 2) / nu AS z FROM t), {beta_tail('src', 'tail')}, {t_quantile('e', 'crit')}\n"
        f"SELECT term, {sig('coef')} AS coef, {sig('se')} AS std_err, {sig('coef / se')} AS t_stat, {sig('p')} AS p_value, "
        f"{sig('coef - crit.t * se')} AS ci_low, {sig('coef + crit.t * se')} AS ci_high FROM t JOIN tail USING (id), crit")


def _largest_eigenvalue(matrix: str, name: str, steps: int = 60) -> str:
    """CTE ``name`` (ev) by power iteration on the matrix in CTE ``matrix`` (m: list of rows)."""
    product = "[list_sum([m[i][j] * x[j] FOR j IN range(1, len(x) + 1)]) FOR i IN range(1, len(x) + 1)]"
    return (f"{name}_p AS (SELECT 0 AS step, m, [1.0 / i FOR i IN range(1, len(m) + 1)] AS x, 0.0::DOUBLE AS ev FROM {matrix} "
            f"UNION ALL SELECT step + 1, m, [v / n FOR v IN y], n FROM (SELECT step, m, y, sqrt(list_sum([v * v FOR v IN y])) AS n "
            f"FROM (SELECT step, m, {product} AS y FROM {name}_p WHERE step < {steps}) q) r), "
            f"{name} AS (SELECT ev FROM {name}_p WHERE step = {steps})")


def _ols_multi_fit() -> str:
    """Long form, as ``_ols_fit``; the condition number from the largest eigenvalues of X'X and of its inverse."""
    return _multi_ctes() + (
        ", fitted AS (SELECT est_id, y, list_sum([x[i] * c[i] FOR i IN range(1, len(x) + 1)]) + cs.coef AS f "
        "FROM rw, cs, (SELECT list(coef ORDER BY id) AS c FROM co) l), "
        "r AS (SELECT est_id, y - f AS r FROM fitted), l AS (SELECT r, r - lag(r) OVER (ORDER BY est_id) AS step FROM r), m0 AS (SELECT avg(r) AS mu FROM r), "
        "m AS (SELECT avg(pow(r - mu, 2)) AS m2, avg(pow(r - mu, 3)) AS m3, avg(pow(r - mu, 4)) AS m4 FROM r, m0), "
        "w AS (SELECT sum(step * step) / sum(r * r) AS dw FROM l), "
        # the uncentred X'X and its inverse, the constant first
        "dsg AS (SELECT r, CAST(i AS INTEGER) AS i, CASE WHEN i = 0 THEN 1 ELSE x[i] END AS v FROM (SELECT *, row_number() OVER () AS r FROM rw) q, k, range(0, 1000) g(i) WHERE i <= k), "
        "xx AS (SELECT list(v ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS v FROM ("
        "SELECT a.i, b.j, sum(a.v * b.v) AS v FROM dsg a JOIN (SELECT r, i AS j, v FROM dsg) b USING (r) GROUP BY a.i, b.j) q GROUP BY i) p), "
        "vm AS (SELECT i, sum(v * mu) AS v FROM iv JOIN mu ON mu.j = iv.j GROUP BY i), "
        "iu AS (SELECT 0 AS i, 0 AS j, cs.v FROM cs UNION ALL SELECT i, 0, -v FROM vm UNION ALL SELECT 0, i, -v FROM vm UNION ALL SELECT i, j, v FROM iv), "
        "ix AS (SELECT list(v ORDER BY i) AS m FROM (SELECT i, list(v ORDER BY j) AS v FROM iu GROUP BY i) p), "
        + _largest_eigenvalue("xx", "hi") + ", " + _largest_eigenvalue("ix", "low") + ", "
        "sst AS (SELECT v AS sst FROM gm, k WHERE i = k + 1 AND j = k + 1), "
        "h AS (SELECT n, nu, k, ssr, 1 - ssr / sst AS r2, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurt, dw, sqrt(hi.ev * low.ev) AS cond "
        "FROM e, k, m, w, sst, hi, low), " + _fit_tail("k", "nu / 2 AS a, k / 2.0 AS b, f * k / nu AS z"))


def _fit_tail(p: str, tail: str) -> str:
    """From CTE h (n, nu, ssr, r2, skew, kurt, dw, cond and what ``p`` and ``tail`` use) to the long table of statistics."""
    stats = {
        "n_obs": "n", "df_model": p, "df_resid": "nu", "r_squared": "r2", "adj_r_squared": "1 - (1 - r2) * (n - 1) / nu",
        "f_statistic": "f", "f_pvalue": "p", "log_likelihood": "ll", "aic": f"2 * ({p} + 1) - 2 * ll", "bic": f"({p} + 1) * ln(n) - 2 * ll",
        "omnibus": "zs * zs + zk * zk", "omnibus_pvalue": "exp(-(zs * zs + zk * zk) / 2)", "skew": "skew", "kurtosis": "kurt",
        "jarque_bera": "jb", "jb_pvalue": "exp(-jb / 2)", "durbin_watson": "dw", "cond_no": "cond", "singular": "0"}
    rows = " UNION ALL ".join(f"SELECT '{name}' AS statistic, CAST({v} AS DOUBLE) AS v FROM z" for name, v in stats.items())
    return (
        f"i AS (SELECT *, (r2 / {p}) / ((1 - r2) / nu) AS f, -n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1) AS ll, "
        "n / 6.0 * (skew * skew + pow(kurt - 3, 2) / 4) AS jb, "
        "skew * sqrt((n + 1.0) * (n + 3) / (6.0 * (n - 2))) AS ys, "
        "sqrt(2 * (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS ws, "
        "(kurt - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) * (n + 1) * (n + 3) * (n + 5))) AS yk, "
        "6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3))) AS sk FROM h), "
        "jj AS (SELECT *, 6 + 8 / sk * (2 / sk + sqrt(1 + 4 / (sk * sk))) AS ak FROM i), "
        f"src AS (SELECT 0 AS id, {tail} FROM jj), " + beta_tail("src", "tail") + ", "
        "z AS (SELECT *, asinh(ys / sqrt(2 / (ws - 1))) / sqrt(ln(ws) / 2) AS zs, "
        "(1 - 2 / (9 * ak) - cbrt((1 - 2 / ak) / (1 + yk * sqrt(2 / (ak - 4))))) / sqrt(2 / (9 * ak)) AS zk FROM jj, tail)\n"
        f"SELECT statistic, {sig('v')} AS value FROM ({rows}) u")


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    v = with_views("est")
    ind = _large(f"AND industry_code IN ({_in(P['summary_industries'])})")
    reg = _large(f"AND region_code IN ({_in(P['summary_regions'])})")
    q["anova_industry"] = _anova(v, ind, "industry_code", "annual_pay", "industry_code")
    q["anova_region"] = _anova(v, reg, "region_code", "annual_pay_10k", "region_code")
    q["anova_rater"] = _anova(with_views("ratings"), RATERS, "rater_id", "rating_score", "rater_id")
    q["tukey_industry"] = _tukey(v, ind, "industry_code", "annual_pay")
    q["tukey_region"] = _tukey(v, reg, "region_code", "annual_pay_10k")
    q["anova_industry_test"] = _anova_test(v, ind, "industry_code", "annual_pay", "industry_code")
    q["anova_region_test"] = _anova_test(v, reg, "region_code", "annual_pay_10k", "region_code")
    q["anova_rater_test"] = _anova_test(with_views("ratings"), RATERS, "rater_id", "rating_score", "rater_id")
    for x in ("year", "headcount"):
        q[f"ols_{x}"] = _ols_simple(x)
        q[f"ols_{x}_report"] = _ols_report(x)
        q[f"ols_{x}_fit"] = _ols_fit(x)
    q["ols_line"] = _ols_line("headcount")
    q["ols_line_boot"] = _ols_line_boot("headcount")
    q["ols_firm_effects"] = _ols_firm_effects()
    q["ols_multi"] = _ols_multi()
    q["ols_multi_fit"] = _ols_multi_fit()
    return q
