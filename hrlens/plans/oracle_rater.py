"""DuckDB text of the rater model: the derivative of the profile REML likelihood, bisected in a recursive query.

With W = [1, X, y] (centred), T = sum of W'W, s_g a rater's sum of W and U_n the sum of s_g s_g' over raters of n rows,
``M(theta) = T - sum of theta / (1 + n theta) U_n`` holds the normal equations [A b; b' c].  One step of the recursion is a
Gauss-Jordan pivot of [A | b | I]; after the last pivot the derivative tells which half of the bracket of log theta holds
the maximum, and the next theta's matrix is set up.
"""

from __future__ import annotations

from .oracle_stats import RATERS
from .oracle_views import sig, with_views
from .rater import BIAS_CUTOFF, LENIENCY, NEUTRAL, SEVERITY

NUMERIC = ["performance_true", "goal_difficulty", "age", "tenure_years"]
Z975 = 1.959963984540054
HALVINGS = 55


def _model(full: bool) -> str:
    """CTEs up to ``sol``: one row with p, n, th, a (solved matrix), rss, s2; ``gs``: sums by rater; ``mu``; ``names``."""
    dummies = "[CAST(department = v AS DOUBLE) FOR v IN ld[2:]] || [CAST(job_level = v AS DOUBLE) FOR v IN lj[2:]] || "
    x = dummies + "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in NUMERIC) + "] || " if full else ""
    names = ("['Intercept'] || ['C(department)[T.' || v || ']' FOR v IN ld[2:]] || ['C(job_level)[T.' || v || ']' FOR v IN lj[2:]] || ["
             + ", ".join(f"'{c}'" for c in NUMERIC) + "]") if full else "['Intercept']"

    def flat(i: str, j: str) -> str:
        return f"(({i}) - 1) * (p + 1) + {j}"

    def m(i: str, j: str, th: str) -> str:
        q = flat(i, j)
        return f"(t[{q}] - list_sum([{th} / (1 + e.n * {th}) * e.u[{q}] FOR e IN b]))"

    def dm(i: str, j: str) -> str:
        return f"(-list_sum([e.u[{flat(i, j)}] / pow(1 + e.n * th, 2) FOR e IN b]))"

    def matrix(th: str) -> str:
        return f"[[{m('i', 'j', th)} FOR j IN range(1, p + 2)] || [CAST(q = i AS DOUBLE) FOR q IN range(1, p + 1)] FOR i IN range(1, p + 1)]"
    beta = "[a[i][p + 1] FOR i IN range(1, p + 1)]"
    rss = f"({m('p + 1', 'p + 1', 'th')} - list_sum([beta[i] * {m('i', 'p + 1', 'th')} FOR i IN range(1, p + 1)]))"
    drss = (f"({dm('p + 1', 'p + 1')} - 2 * list_sum([beta[i] * {dm('i', 'p + 1')} FOR i IN range(1, p + 1)]) "
            f"+ list_sum([list_sum([beta[i] * beta[j] * {dm('i', 'j')} FOR j IN range(1, p + 1)]) FOR i IN range(1, p + 1)]))")
    trace = f"list_sum([list_sum([a[i][p + 1 + j] * {dm('i', 'j')} FOR j IN range(1, p + 1)]) FOR i IN range(1, p + 1)])"
    slope = f"-(list_sum([e.c * e.n / (1 + e.n * th) FOR e IN b]) + (n - p) * {drss} / {rss} + {trace})"
    pivot = ("[[CASE WHEN i = piv + 1 THEN a[i][j] / a[piv + 1][piv + 1] ELSE a[i][j] - a[i][piv + 1] * a[piv + 1][j] / a[piv + 1][piv + 1] END "
             "FOR j IN range(1, 2 * p + 2)] FOR i IN range(1, p + 1)]")
    return "WITH RECURSIVE " + with_views("ratings").removeprefix("WITH ") + (
        f", d AS MATERIALIZED ({RATERS}), lv AS (SELECT list_sort(list(DISTINCT department)) AS ld, list_sort(list(DISTINCT job_level)) AS lj FROM d), "
        f"nm AS (SELECT {names} AS names FROM lv), "
        f"rw AS MATERIALIZED (SELECT rater_id, {x}[CAST(rating_score AS DOUBLE)] AS x FROM d, lv), "
        "mu AS MATERIALIZED (SELECT list(v ORDER BY j) AS mu FROM (SELECT j, avg(x[j]) AS v FROM rw, range(1, 50) g(j) WHERE j <= len(x) GROUP BY j) q), "
        "wc AS MATERIALIZED (SELECT rater_id, [1.0::DOUBLE] || [x[j] - mu[j] FOR j IN range(1, len(x) + 1)] AS w FROM rw, mu), "
        "tt AS (SELECT list(v ORDER BY i, j) AS t FROM (SELECT i, j, sum(w[i] * w[j]) AS v FROM wc, range(1, 50) g(i), range(1, 50) h(j) "
        "WHERE i <= len(w) AND j <= len(w) GROUP BY i, j) q), "
        "gs AS MATERIALIZED (SELECT rater_id, CAST(any_value(n) AS DOUBLE) AS n, list(s ORDER BY i) AS s FROM "
        "(SELECT rater_id, i, count(*) AS n, sum(w[i]) AS s FROM wc, range(1, 50) g(i) WHERE i <= len(w) GROUP BY rater_id, i) q GROUP BY rater_id), "
        "bk AS (SELECT n, any_value(c) AS c, list(v ORDER BY i, j) AS u FROM (SELECT n, i, j, CAST(count(*) AS DOUBLE) AS c, sum(s[i] * s[j]) AS v "
        "FROM gs, range(1, 50) g(i), range(1, 50) h(j) WHERE i <= len(s) AND j <= len(s) GROUP BY n, i, j) q GROUP BY n), "
        "cs AS MATERIALIZED (SELECT CAST(len(names) AS INTEGER) AS p, (SELECT CAST(count(*) AS DOUBLE) FROM rw) AS n, t, "
        "(SELECT list({'n': n, 'c': c, 'u': u}) FROM bk) AS b FROM nm, tt), "
        f"it AS (SELECT 0 AS step, 0 AS piv, -18.0::DOUBLE AS lo, 9.0::DOUBLE AS hi, th, {matrix('th')} AS a FROM cs, (SELECT exp(-4.5::DOUBLE) AS th) z "
        f"UNION ALL SELECT CASE WHEN piv < p THEN step ELSE step + 1 END, CASE WHEN piv < p THEN piv + 1 ELSE 0 END, nlo, nhi, nth, "
        f"CASE WHEN piv < p THEN {pivot} ELSE {matrix('nth')} END FROM ("
        "SELECT *, CASE WHEN piv < p THEN th ELSE exp((nlo + nhi) / 2) END AS nth FROM ("
        "SELECT *, CASE WHEN piv = p AND slope > 0 THEN (lo + hi) / 2 ELSE lo END AS nlo, CASE WHEN piv = p AND NOT slope > 0 THEN (lo + hi) / 2 ELSE hi END AS nhi FROM ("
        f"SELECT *, CASE WHEN piv = p THEN {slope} END AS slope FROM (SELECT it.*, cs.*, {beta} AS beta FROM it, cs WHERE step < {HALVINGS} OR piv < p) q0) q1) q2) q3), "
        f"sol AS MATERIALIZED (SELECT *, rss / (n - p) AS s2 FROM (SELECT *, {rss} AS rss FROM (SELECT p, n, t, b, th, a, {beta} AS beta FROM it, cs "
        f"WHERE step = {HALVINGS} AND piv = p) q) r)")


def _mixed() -> str:
    inv = "a[i][p + 1 + j]"
    var0 = ("(a[1][p + 2] - 2 * list_sum([a[1][p + 1 + j] * mu[j - 1] FOR j IN range(2, p + 1)]) "
            f"+ list_sum([list_sum([{inv} * mu[i - 1] * mu[j - 1] FOR j IN range(2, p + 1)]) FOR i IN range(2, p + 1)]))")
    return _model(True) + (
        ", co AS (SELECT CAST(i AS INTEGER) AS i, names[i] AS term, "
        "CASE WHEN i = 1 THEN mu[p] + beta[1] - list_sum([beta[j] * mu[j - 1] FOR j IN range(2, p + 1)]) ELSE beta[i] END AS coef, "
        f"sqrt(s2 * CASE WHEN i = 1 THEN {var0} ELSE a[i][p + 1 + i] END) AS se FROM sol, nm, mu, range(1, 50) g(i) WHERE i <= p), "
        # the normal tail past z: exp(-z z / 2) times the integral of exp(-v z - v v / 2)
        "tl AS (SELECT i, exp(-any_value(z * z) / 2) * 2 / sqrt(2 * pi()) * sum(wt * exp(-v * z - v * v / 2)) * 12.0 / 6000 / 3 AS p FROM ("
        "SELECT i, abs(coef / se) AS z, q * 12.0 / 6000 AS v, CASE WHEN q = 0 OR q = 6000 THEN 1 WHEN q % 2 = 1 THEN 4 ELSE 2 END AS wt FROM co, range(6001) r(q)) s GROUP BY i)\n"
        f"SELECT term, {sig('coef')} AS coef, {sig('se')} AS std_err, {sig('coef / se')} AS z, round(p * 1e9) / 1e9 AS p_value, "
        f"{sig(f'coef - {Z975} * se')} AS ci_low, {sig(f'coef + {Z975} * se')} AS ci_high FROM co JOIN tl USING (i) "
        f"UNION ALL SELECT 'Group Var', {sig('th * s2')}, NULL, NULL, NULL, NULL, NULL FROM sol")


def _icc() -> str:
    return _model(False) + (f"\nSELECT {sig('th * s2')} AS tau2, {sig('s2')} AS sigma2, {sig('th * s2 / (th * s2 + s2)')} AS icc, "
                            "(SELECT count(*) FROM gs) AS n_raters, CAST(n AS BIGINT) AS n_obs FROM sol")


EFFECTS = (", ef AS (SELECT rater_id, th / (1 + gs.n * th) * (s[p + 1] - list_sum([beta[i] * s[i] FOR i IN range(1, p + 1)])) AS e FROM gs, sol)")


def sql() -> dict[str, str]:
    return {
        "rater_mixed": _mixed(),
        "rater_icc": _icc(),
        "rater_bias": _model(True) + EFFECTS + (
            f"\nSELECT rater_id, {sig('e')} AS random_effect, CASE WHEN {sig('e')} > {BIAS_CUTOFF} THEN '{LENIENCY}' WHEN {sig('e')} < -{BIAS_CUTOFF} THEN '{SEVERITY}' "
            f"ELSE '{NEUTRAL}' END AS bias_type FROM ef"),
        "rater_adjusted": _model(True) + EFFECTS + (
            f"\nSELECT employee_id, rater_id, rating_score, {sig('e')} AS random_effect, {sig('rating_score - e')} AS adjusted_rating_score FROM d JOIN ef USING (rater_id)"),
    }
