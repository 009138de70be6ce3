"""Distribution tails used by the test reports (F, t, χ², normal, studentized range).

These run on the driver (or inside a pandas UDF) on a handful of numbers —
test statistics and degrees of freedom — never on rows.  Algorithms are the
textbook ones: the continued fraction of the regularised incomplete beta
function, Gauss–Legendre quadrature for the studentized range (Tukey).
"""

from __future__ import annotations

import math

import numpy as np


# incomplete beta ------------------------------------------------------------
def _stirling_rest(x: float) -> float:
    """ln Γ(x) minus its leading terms (x - 1/2) ln x - x + ln(2π)/2, by the asymptotic series."""
    r = 1.0 / (x * x)
    return (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / x


def log_beta(a: float, b: float) -> float:
    """ln B(a, b); with a large argument ln Γ is differenced term by term, so no digits cancel at any df."""
    small, large = sorted((a, b))
    if large < 32.0:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    total = small + large
    if small < 32.0:
        return (math.lgamma(small) + small - small * math.log(total) - (large - 0.5) * math.log1p(small / large)
                + _stirling_rest(large) - _stirling_rest(total))
    return (0.5 * math.log(2.0 * math.pi) + (small - 0.5) * math.log(small / total) - 0.5 * math.log(total)
            - (large - 0.5) * math.log1p(small / large)
            + _stirling_rest(small) + _stirling_rest(large) - _stirling_rest(total))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """1 / (1 + d1/(1 + d2/(1 + ...))) of the incomplete beta function (DLMF 8.17.22), run until it stands still.

    Numerators and denominators of successive convergents follow the fundamental recurrence; both are
    divided by the newest denominator each step, which leaves their ratio as it is.
    """
    num, den, num_before, den_before = 1.0, 1.0, 0.0, 1.0
    value, j = 1.0, 0
    while True:
        j += 1
        m = j // 2
        if j % 2:
            d = -(a + m) / (a + 2 * m) * ((a + b + m) / (a + 2 * m + 1)) * x
        else:
            d = m / (a + 2 * m - 1) * ((b - m) / (a + 2 * m)) * x
        num, num_before = num + d * num_before, num
        den, den_before = den + d * den_before, den
        if den == 0.0:
            continue
        num, num_before, den_before, den = num / den, num_before / den, den_before / den, 1.0
        if d == 0.0 or abs(num - value) <= 1e-16 * abs(num):
            return num
        value = num


def betainc_reg(a: float, b: float, x: float, rest: float | None = None) -> float:
    """Regularised incomplete beta I_x(a, b); ``rest`` is 1 - x, for callers that know it more exactly."""
    y = 1.0 - x if rest is None else rest
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    log_x = math.log1p(-y) if y < 0.5 else math.log(x)
    log_y = math.log1p(-x) if x < 0.5 else math.log(y)
    front = math.exp(a * log_x + b * log_y - log_beta(a, b))
    if (b + 1.0) * x < (a + 1.0) * y:
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, y) / b


# tails ----------------------------------------------------------------------
def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for F(d1, d2)."""
    if f is None or d1 is None or d2 is None or d1 <= 0 or d2 <= 0:
        return float("nan")
    if math.isnan(f):
        return float("nan")
    if math.isinf(f):
        return 0.0
    if f <= 0:
        return 1.0
    return betainc_reg(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f))


def t_sf2(t: float, nu: float) -> float:
    """Two-sided P(|T| > |t|) for Student t with nu degrees of freedom."""
    if t is None or nu is None or nu <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc_reg(nu / 2.0, 0.5, nu / (nu + t * t), t * t / (nu + t * t))


def t_cdf(t: float, nu: float) -> float:
    p2 = t_sf2(t, nu)
    return 1.0 - p2 / 2.0 if t >= 0 else p2 / 2.0


def t_ppf(p: float, nu: float) -> float:
    """Quantile of Student t (bisection on the CDF, the bracket found by doubling)."""
    lo, hi = -1.0, 1.0
    while t_cdf(lo, nu) > p and math.isfinite(lo):
        lo *= 2.0
    while t_cdf(hi, nu) < p and math.isfinite(hi):
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if t_cdf(mid, nu) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def norm_sf2(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_sf_2df(x: float) -> float:
    """P(χ²₂ > x) = exp(-x/2) (the Jarque–Bera and omnibus tests have 2 df)."""
    return math.exp(-x / 2.0) if x > 0 else 1.0


# studentized range ----------------------------------------------------------
_Z_NODES, _Z_W = np.polynomial.legendre.leggauss(200)
_S_NODES, _S_W = np.polynomial.legendre.leggauss(160)
_erfc = np.frompyfunc(math.erfc, 1, 1)


def _phi_cdf(x: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(-x / math.sqrt(2.0)).astype(float)


def _range_cdf_inf(w: np.ndarray, k: int) -> np.ndarray:
    """P(range of k iid N(0,1) < w) for each w (vector), by quadrature over z."""
    z = 8.0 * _Z_NODES  # z ∈ [-8, 8]
    wz = 8.0 * _Z_W
    phi = np.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi)
    big_phi = _phi_cdf(z)
    diff = big_phi[None, :] - _phi_cdf(z[None, :] - w[:, None])
    diff = np.clip(diff, 0.0, 1.0)
    return k * np.sum(wz[None, :] * phi[None, :] * diff ** (k - 1), axis=1)


def ptukey(q: float, k: int, nu: float) -> float:
    """P(Q < q) for the studentized range with k groups and nu error df."""
    if q is None or math.isnan(q) or k is None or k < 2 or (nu is not None and not nu > 0):
        return float("nan")
    if q <= 0:
        return 0.0
    if nu is None or math.isinf(nu):
        return float(_range_cdf_inf(np.array([q]), k)[0])
    # e = chi_nu / sqrt(nu) - 1, integrated over its bulk; its density is scaled by its own sum, so neither
    # a gamma function nor a difference of large terms is needed at any df
    sd = 1.0 / math.sqrt(2.0 * nu)
    lo = max(1e-9 - 1.0, -12.0 * sd) if nu > 20 else 1e-9 - 1.0
    hi = 12.0 * sd if nu > 20 else 14.0 * max(sd, 0.15) + (8.0 if nu < 5 else 0.0)
    e = lo + (hi - lo) * (_S_NODES + 1.0) / 2.0
    dens = _S_W * np.exp((nu - 1.0) * np.log1p(e) - nu * (e + e * e / 2.0))
    inner = _range_cdf_inf(q * (1.0 + e), k)
    return float(min(1.0, max(0.0, np.sum(dens * inner) / np.sum(dens))))


def psturng(q: float, k: int, nu: float) -> float:
    """P(Q > q) — the Tukey adjusted p-value (NaN stays NaN)."""
    c = ptukey(q, k, nu)
    return c if math.isnan(c) else max(0.0, 1.0 - c)


def qtukey(p: float, k: int, nu: float) -> float:
    """Quantile of the studentized range (bisection); NaN without error df."""
    if nu is None or not nu > 0 or k is None or k < 2:
        return float("nan")
    lo, hi = 0.0, 100.0
    while hi < 1e9 and ptukey(hi, k, nu) < p:
        hi *= 2.0
    for _ in range(60):
        mid = (lo + hi) / 2.0
        if ptukey(mid, k, nu) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0
