"""Random-intercept linear mixed model by REML, from distributed sums (M7–M9).

Model: y = Xβ + u_g + e,  u_g ~ N(0, τ²),  e ~ N(0, σ²);  θ = τ²/σ².
With W = [X, y]:  T = Σ W'W over all rows, s_g = Σ_{i∈g} W_i, and

    M(θ) = T − Σ_g θ/(1+n_gθ) · s_g s_g'

holds every quantity the REML likelihood needs.  Groups of equal size n share
the weight θ/(1+nθ), so Spark reduces Σ_{g: n_g=n} s_g s_g' per distinct size
(a second ``groupBy``); the driver receives one (p+1)² matrix per distinct
group size — never a row or a group (but for the one row whose values the sums are taken relative to).  The profile REML log-likelihood is

    ℓ(θ) = −½[(N−p)(log 2πσ̂² + 1) + Σ_g log(1+n_gθ) + log|A|],
    A = M_XX, β = A⁻¹M_Xy, σ̂² = (M_yy − β'M_Xy)/(N−p),

maximised over log θ (a grid brackets the maximum, then its derivative is
bisected, which fixes θ to the last digits as a flat maximum alone does not)
and compared with the boundary θ = 0.  Columns are centred first (a reparametrisation; the intercept is
recovered afterwards) so sums of squares stay well scaled.  Random effects
(BLUPs) are θ/(1+n_gθ)·(s_g,y − s_g,X'β), evaluated by Spark on the per-group
sums table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..persist import materialize
from .dist import norm_sf2

Z975 = 1.959963984540054


@dataclass
class MixedFit:
    terms: list[str]
    beta: np.ndarray
    cov: np.ndarray
    tau2: float
    sigma2: float
    theta: float
    n: int
    n_groups: int
    loglik: float
    beta_centered: np.ndarray
    means: dict
    extra: dict = field(default_factory=dict)

    @property
    def std_err(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.cov), 0.0))


def _prep(df: DataFrame, group: str, y: str, xs: list[str]) -> tuple[DataFrame, dict]:
    """The complete rows with their values taken relative to those of one row, and these values."""
    cols = xs + [y]
    d = df.select(group, *[F.col(c).cast("double").alias(c) for c in cols])
    cond = F.col(group).isNotNull()
    for c in cols:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(c)
    d = d.where(cond)
    one = d.select(*cols).first()
    shift = {c: float(one[c]) for c in cols} if one else {}
    return d.select(group, F.lit(1.0).alias("__one"), *[(F.col(c) - F.lit(shift.get(c, 0.0))).alias(c) for c in cols]), shift


def _pairs(cols: list[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]


def _sym(vals, k: int, pairs) -> np.ndarray:
    m = np.zeros((k, k))
    for (i, j), v in zip(pairs, vals):
        m[i, j] = m[j, i] = float(v or 0.0)
    return m


def centred_stats(T: np.ndarray, buckets) -> tuple[np.ndarray, list, np.ndarray]:
    """T and Σ s_g s_g' of the columns taken relative to their means, and these means (0 for the column of ones, the first).

    With s_g1 = n: Σ (s − n m)(s − n m)' = U − n (Σs m' + m Σs') + (number of groups) n² m m', and n Σs is U's first column.
    """
    m = T[0] / T[0, 0] if T[0, 0] else np.zeros(len(T))
    m[0] = 0.0
    out = [(n, count, U - np.outer(U[:, 0], m) - np.outer(m, U[:, 0]) + count * n * n * np.outer(m, m)) for n, count, U in buckets]
    return T - np.outer(T[:, 0], m) - np.outer(m, T[:, 0]) + T[0, 0] * np.outer(m, m), out, m


def sufficient_stats(shifted: DataFrame, group: str, cols: list[str]):
    """T (k×k), and per distinct group size n: (n, number of groups, Σ s_g s_g').

    One pass over the rows: the per-group aggregate carries s_g and the group's
    own Σ W'W; the per-size aggregate then sums both, so T is the sum of the
    size buckets.  The per-group table (one row per group) is written once —
    it also feeds the BLUPs.
    """
    k = len(cols)
    pairs = _pairs(cols)
    gs = shifted.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_g"), *[F.sum(c).alias(c) for c in cols],
        *[F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"w{i}_{j}") for i, j in pairs])
    gs = materialize(gs, repartition=False)
    b = gs.groupBy("n_g").agg(F.count(F.lit(1)).alias("n_groups"),
                              *[F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"u{i}_{j}") for i, j in pairs],
                              *[F.sum(f"w{i}_{j}").alias(f"t{i}_{j}") for i, j in pairs])
    rows = b.collect()
    T = sum((_sym([r[f"t{i}_{j}"] for i, j in pairs], k, pairs) for r in rows), np.zeros((k, k)))
    buckets = [(int(r["n_g"]), int(r["n_groups"]), _sym([r[f"u{i}_{j}"] for i, j in pairs], k, pairs))
               for r in rows]
    return T, buckets, gs.select(group, "n_g", *cols)


def reml_profile(T: np.ndarray, buckets, n_total: int, theta: float):
    """(loglik, β, A⁻¹, σ̂²) at θ for W = [X, y] sums (y is the last column)."""
    M = T.copy()
    logdet_v = 0.0
    for n_g, cnt, U in buckets:
        w = theta / (1.0 + n_g * theta)
        M -= w * U
        logdet_v += cnt * math.log1p(n_g * theta)
    p = T.shape[0] - 1
    A = M[:p, :p]
    b = M[:p, p]
    try:
        Ainv = np.linalg.inv(A)
    except np.linalg.LinAlgError:
        Ainv = np.linalg.pinv(A)
    beta = Ainv @ b
    rss = float(M[p, p] - beta @ b)
    dfr = n_total - p
    s2 = rss / dfr if dfr > 0 else float("nan")
    if not s2 > 0:  # perfect fit or no residual df: the likelihood is unbounded/undefined
        return float("-inf"), beta, Ainv, s2
    sign, logdet_a = np.linalg.slogdet(A)
    ll = -0.5 * (dfr * (math.log(2 * math.pi * s2) + 1.0) + logdet_v + logdet_a)
    return ll, beta, Ainv, s2


def reml_slope(T: np.ndarray, buckets, n_total: int, theta: float) -> float:
    """dℓ/dθ: with M' = −Σ U/(1+nθ)², −½[Σ n/(1+nθ) + (N−p) RSS'/RSS + tr(A⁻¹A')], RSS' = (−β, 1) M' (−β, 1)'."""
    p = T.shape[0] - 1
    _, beta, Ainv, s2 = reml_profile(T, buckets, n_total, theta)
    d, logdet = np.zeros_like(T), 0.0
    for n_g, cnt, U in buckets:
        d -= U / (1.0 + n_g * theta) ** 2
        logdet += cnt * n_g / (1.0 + n_g * theta)
    v = np.append(-beta, 1.0)
    return -0.5 * (logdet + float(v @ d @ v) / s2 + float(np.sum(Ainv * d[:p, :p])))


def fit_random_intercept(df: DataFrame, group: str, y: str, xs: list[str],
                         term_names: list[str] | None = None) -> tuple[MixedFit, DataFrame]:
    """REML fit; returns the fit and the per-group sums table (for BLUPs).

    The rows are read once, by one ``groupBy``: values are summed relative to those of some row, so that little cancels,
    and the means that follow from the sums centre them afterwards.
    """
    shifted, shift = _prep(df, group, y, xs)
    if not shift:
        raise ValueError("mixed model: no complete rows")
    cols = ["__one"] + xs + [y]
    T, buckets, gs = sufficient_stats(shifted, group, cols)
    n = int(round(T[0, 0]))
    T, buckets, m = centred_stats(T, buckets)
    means = {c: shift[c] + float(v) for c, v in zip(cols[1:], m[1:], strict=True)}
    gs = gs.select(group, "n_g", F.col("__one"), *[(F.col(c) - F.col("n_g") * float(v)).alias(c) for c, v in zip(cols[1:], m[1:], strict=True)])
    n_groups = sum(c for _, c, _ in buckets)

    def ll(u):
        return reml_profile(T, buckets, n, math.exp(u))[0]

    grid = np.linspace(-18.0, 9.0, 55)
    vals = [ll(u) for u in grid]
    i = int(np.argmax(vals))
    lo, hi = grid[max(0, i - 1)], grid[min(len(grid) - 1, i + 1)]
    for _ in range(60):
        mid = (lo + hi) / 2
        if reml_slope(T, buckets, n, math.exp(mid)) > 0:
            lo = mid
        else:
            hi = mid
    theta = math.exp((lo + hi) / 2)
    ll_best = ll((lo + hi) / 2)
    ll0 = reml_profile(T, buckets, n, 0.0)[0]
    if ll0 >= ll_best:
        theta, ll_best = 0.0, ll0
    _, beta_c, Ainv, s2 = reml_profile(T, buckets, n, theta)
    # back to the uncentred parametrisation: β0 = ȳ + γ0 − Σβⱼx̄ⱼ
    p = len(xs) + 1
    L = np.eye(p)
    xbar = np.array([means[c] for c in xs])
    L[0, 1:] = -xbar
    beta = L @ beta_c
    beta[0] += means[y]
    cov = L @ (s2 * Ainv) @ L.T
    names = term_names or (["Intercept"] + xs)
    fit = MixedFit(names, beta, cov, theta * s2, s2, theta, n, n_groups, ll_best, beta_c, means)
    fit.extra["cols"] = cols
    return fit, gs


def coef_rows(fit: MixedFit) -> list[tuple]:
    se = fit.std_err
    rows = []
    for t, b, s in zip(fit.terms, fit.beta, se):
        z = b / s if s > 0 else float("nan")
        rows.append((t, float(b), float(s), float(z), norm_sf2(z) if not math.isnan(z) else float("nan"),
                     float(b - Z975 * s), float(b + Z975 * s)))
    rows.append(("Group Var", float(fit.tau2), None, None, None, None, None))
    return rows


def random_effects(fit: MixedFit, gs: DataFrame, group: str) -> DataFrame:
    """M9: BLUP per group, θ/(1+n_gθ)·(s_g,y − s_g,X'β), computed by Spark."""
    cols = fit.extra["cols"]
    y = cols[-1]
    r = F.col(y)
    for c, b in zip(cols[:-1], fit.beta_centered):
        r = r - F.lit(float(b)) * F.col(c)
    w = F.lit(fit.theta) / (F.lit(1.0) + F.col("n_g") * F.lit(fit.theta))
    return gs.select(F.col(group), (w * r).alias("random_effect"))
