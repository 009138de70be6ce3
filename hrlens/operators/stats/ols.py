"""Ordinary least squares with a full report (M3–M5) from a distributed QR.

One pass folds all rows into the R factor of ``[1, X, y]`` (``qr.r_factor``); the driver solves the triangular system,
which is accurate for ill-scaled columns such as calendar years.  Collinear columns (a dummy level that others
explain) are named and the shortest solution is taken.  A second pass over a range partitioning by the order key sums
the residual moments for skew, kurtosis, Jarque–Bera and the omnibus test and, stitched at the partitions' borders, the
Durbin–Watson sum (no global window, no row on the driver).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..persist import materialize
from . import qr
from .dist import chi2_sf_2df, f_sf, t_ppf, t_sf2


@dataclass
class OlsFit:
    terms: list[str]
    coef: np.ndarray
    cov: np.ndarray
    n: int
    df_model: int
    df_resid: int
    ssr: float
    sst: float
    means: dict
    extra: dict = field(default_factory=dict)

    @property
    def sigma2(self) -> float:
        return self.ssr / self.df_resid if self.df_resid > 0 else float("nan")

    @property
    def std_err(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.cov), 0.0))

    @property
    def r2(self) -> float:
        return 1.0 - self.ssr / self.sst if self.sst > 0 else float("nan")


def _clean(df: DataFrame, y: str, xs: list[str], keep: list[str] | None = None) -> DataFrame:
    cols = [y] + xs
    out = df.select(*(keep or []), *[F.col(c).cast("double").alias(c) for c in cols])
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull() & ~F.isnan(c)
        cond = ok if cond is None else cond & ok
    return out.where(cond)


def ols_fit(df: DataFrame, y: str, xs: list[str], order_key: str | None = None,
            diagnostics: bool = True, checkpoint: bool = True) -> OlsFit:
    """Fit y ~ 1 + xs on all rows with finite values (P9 dropna semantics).

    With diagnostics the cleaned design is checkpointed for the second pass; pass ``checkpoint=False`` when the
    input is already a written table.  ``extra["collinear"]`` names the columns that others explain.
    """
    keep = [order_key] if (diagnostics and order_key is not None) else []
    d = _clean(df, y, xs, keep=keep)
    if checkpoint and diagnostics:
        d = materialize(d, repartition=False)
    n, r = qr.r_factor(d, xs + [y])
    if n == 0:
        raise ValueError("OLS: no complete rows")
    s = qr.solve(r)
    df_resid = n - s.rank
    s2 = s.ssr / df_resid if df_resid > 0 else float("nan")
    terms = ["const"] + xs
    means = {c: float(r[0, j] / r[0, 0]) for j, c in enumerate(xs + [y], 1)}
    fit = OlsFit(terms, s.coef, s2 * s.inverse, n, s.rank - 1, df_resid, s.ssr, float((r[1:, -1] ** 2).sum()), means)
    fit.extra.update(singular=bool(s.collinear), collinear=[terms[j] for j in s.collinear], cond_no=s.cond)
    if diagnostics:
        fit.extra.update(residual_report(d.select(*keep, resid_expr(y, xs, fit).alias("e")), n, order_key))
    return fit


def resid_expr(y: str, xs: list[str], fit: OlsFit):
    e = F.col(y) - F.lit(float(fit.coef[0]))
    for c, b in zip(xs, fit.coef[1:]):
        e = e - F.lit(float(b)) * F.col(c)
    return e


def residual_report(residuals: DataFrame, n: int, order_key: str | None = None) -> dict:
    """Moments and tests of the column ``e``, and Σ(e_t − e_{t−1})² / Σe² in ``order_key`` order, in one pass.

    Rows are range-partitioned by key and sorted within partitions; each partition returns its power sums, its inner
    sum of squared steps and its border residuals; the driver stitches the (#partitions) border pairs in key order.
    """
    if order_key is not None:
        parts = max(1, int(residuals.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        residuals = residuals.select(F.col(order_key).alias("k"), "e").repartitionByRange(parts, "k").sortWithinPartitions("k")
        kind = residuals.schema["k"].dataType.simpleString()
    else:
        residuals, kind = residuals.select(F.lit(0).alias("k"), "e"), "int"

    def per_part(it):
        # streams the partition batch by batch; only sums and border values are kept
        first_key = first_e = last_e = None
        ssd, sums = 0.0, np.zeros(4)
        for pdf in it:
            if pdf.empty:
                continue
            e = pdf["e"].to_numpy(dtype="float64")
            if first_e is None:
                first_key, first_e = pdf["k"].iloc[0], e[0]
            else:
                ssd += (e[0] - last_e) ** 2
            ssd += float(np.sum(np.diff(e) ** 2))
            sums += [e.sum(), (e ** 2).sum(), (e ** 3).sum(), (e ** 4).sum()]
            last_e = e[-1]
        if first_e is not None:
            yield pd.DataFrame({"first_key": [first_key], "first_e": [first_e], "last_e": [last_e], "ssd": [ssd],
                                **{f"s{i + 1}": [v] for i, v in enumerate(sums)}})

    schema = f"first_key {kind}, first_e double, last_e double, ssd double, s1 double, s2 double, s3 double, s4 double"
    rows = sorted(residuals.mapInPandas(per_part, schema).collect(), key=lambda r: (r["first_key"] is not None, r["first_key"]))
    s1, s2, s3, s4 = (math.fsum(r[f"s{i}"] for r in rows) for i in range(1, 5))
    out = _moments(n, s1, s2, s3, s4)
    if order_key is not None:
        ssd = math.fsum(r["ssd"] for r in rows) + math.fsum((b["first_e"] - a["last_e"]) ** 2 for a, b in zip(rows, rows[1:]))
        out["durbin_watson"] = ssd / s2 if s2 > 0 else float("nan")
    return out


def _moments(n: int, s1: float, s2: float, s3: float, s4: float) -> dict:
    mu = s1 / n
    m2 = s2 / n - mu ** 2
    m3 = s3 / n - 3 * mu * s2 / n + 2 * mu ** 3
    m4 = s4 / n - 4 * mu * s3 / n + 6 * mu ** 2 * s2 / n - 3 * mu ** 4
    skew = m3 / m2 ** 1.5 if m2 > 0 else float("nan")
    kurt = m4 / m2 ** 2 if m2 > 0 else float("nan")
    jb = n / 6.0 * (skew ** 2 + (kurt - 3.0) ** 2 / 4.0)
    omni = _skew_z(skew, n) ** 2 + _kurt_z(kurt, n) ** 2
    return {"skew": skew, "kurtosis": kurt, "jarque_bera": jb, "jb_pvalue": chi2_sf_2df(jb), "omnibus": omni,
            "omnibus_pvalue": chi2_sf_2df(omni) if not math.isnan(omni) else float("nan")}


def _skew_z(b2: float, n: int) -> float:
    """D'Agostino's transformation of the sample skewness to N(0,1)."""
    if n < 8 or math.isnan(b2):
        return float("nan")
    y = b2 * math.sqrt(((n + 1) * (n + 3)) / (6.0 * (n - 2)))
    beta2 = (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1.0 + math.sqrt(2.0 * (beta2 - 1.0))
    delta = 1.0 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2.0 / (w2 - 1.0))
    y = 1.0 if y == 0 else y
    return delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1.0))


def _kurt_z(b2: float, n: int) -> float:
    """Anscombe–Glynn transformation of the sample kurtosis (non-excess) to N(0,1)."""
    if n < 5 or math.isnan(b2):
        return float("nan")
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1.0) * (n + 3) * (n + 5))
    x = (b2 - e) / math.sqrt(varb2)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt((6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + math.sqrt(1 + 4.0 / (sb1 ** 2)))
    t1 = 1 - 2 / (9.0 * a)
    den = 1 + x * math.sqrt(2 / (a - 4.0))
    if den == 0:
        return float("nan")
    t2 = math.copysign(1.0, den) * ((1 - 2.0 / a) / abs(den)) ** (1 / 3.0)
    return (t1 - t2) / math.sqrt(2 / (9.0 * a))


# report tables ------------------------------------------------------------------
def coef_frame(fit: OlsFit, alpha: float = 0.05, with_tests: bool = True) -> pd.DataFrame:
    se = fit.std_err
    t = fit.coef / se
    rows = {"term": fit.terms, "coef": fit.coef, "std_err": se, "t_stat": t}
    if with_tests:
        tc = t_ppf(1 - alpha / 2, fit.df_resid)
        rows["p_value"] = [t_sf2(v, fit.df_resid) for v in t]
        rows["ci_low"] = fit.coef - tc * se
        rows["ci_high"] = fit.coef + tc * se
    return pd.DataFrame(rows)


def fit_frame(fit: OlsFit) -> pd.DataFrame:
    n, p = fit.n, fit.df_model
    r2 = fit.r2
    adj = 1 - (1 - r2) * (n - 1) / fit.df_resid if fit.df_resid > 0 else float("nan")
    fstat = (r2 / p) / ((1 - r2) / fit.df_resid) if p > 0 and fit.df_resid > 0 and r2 < 1 else float("nan")
    ll = -n / 2.0 * (math.log(2 * math.pi) + math.log(fit.ssr / n) + 1) if fit.ssr > 0 else float("nan")
    k = p + 1  # estimated parameters
    stats = {
        "n_obs": float(n), "df_model": float(p), "df_resid": float(fit.df_resid),
        "r_squared": r2, "adj_r_squared": adj, "f_statistic": fstat,
        "f_pvalue": f_sf(fstat, p, fit.df_resid) if not math.isnan(fstat) else float("nan"),
        "log_likelihood": ll, "aic": -2 * ll + 2 * k, "bic": -2 * ll + k * math.log(n),
        "omnibus": fit.extra.get("omnibus", float("nan")),
        "omnibus_pvalue": fit.extra.get("omnibus_pvalue", float("nan")),
        "skew": fit.extra.get("skew", float("nan")), "kurtosis": fit.extra.get("kurtosis", float("nan")),
        "jarque_bera": fit.extra.get("jarque_bera", float("nan")),
        "jb_pvalue": fit.extra.get("jb_pvalue", float("nan")),
        "durbin_watson": fit.extra.get("durbin_watson", float("nan")),
        "cond_no": fit.extra.get("cond_no", float("nan")),
        # 1 when columns were collinear (e.g. a dummy level without rows) and the shortest solution was taken
        "singular": 1.0 if fit.extra.get("singular") else 0.0,
    }
    return pd.DataFrame({"statistic": list(stats), "value": [float(v) for v in stats.values()]})


def band_frame(fit: OlsFit, x: str, lo: float, hi: float, points: int = 100,
               alpha: float = 0.05, scale: float = 1.0) -> pd.DataFrame:
    """M5: fitted line and analytic (1-α) confidence band on an even x grid."""
    grid = np.linspace(lo, hi, points)
    i = fit.terms.index(x)
    fitted = fit.coef[0] + fit.coef[i] * grid
    var = fit.cov[0, 0] + 2 * grid * fit.cov[0, i] + grid ** 2 * fit.cov[i, i]
    tc = t_ppf(1 - alpha / 2, fit.df_resid)
    half = tc * np.sqrt(np.maximum(var, 0))
    return pd.DataFrame({"x": grid, "fit": fitted / scale, "lower": (fitted - half) / scale,
                         "upper": (fitted + half) / scale})
