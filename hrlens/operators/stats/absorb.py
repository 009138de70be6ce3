"""Least squares with a factor of any number of levels (M4, M6, M12) by block elimination.

The normal equations of y ~ X + one coefficient a level have a diagonal block for the levels.  Eliminating it leaves the
equations of X and y with their level means taken out, so the fit is one aggregate by level, one join of the rows with
their level's means (AQE broadcasts a small side and splits a hot level), and one QR of the few columns of X.  Each
level's coefficient and its variance then follow from the level's means alone: a DataFrame with a row a level, never a
column a level, and nothing of that size on the driver.

The result is that of dummy coding with the first level as reference.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..persist import materialize
from . import qr
from .dist import t_ppf, t_sf2


@dataclass
class AbsorbedFit:
    terms: list[str]
    coef: np.ndarray
    cov: np.ndarray
    n: int
    n_levels: int
    df_resid: int
    ssr: float
    sst: float
    collinear: list[str]
    #: factor, n, y, and a mean per term: one row a level
    means: DataFrame
    factor: str

    @property
    def sigma2(self) -> float:
        return self.ssr / self.df_resid if self.df_resid > 0 else float("nan")


def _complete(df: DataFrame, y: str, xs: list[str], factor: str, keep: list[str]) -> DataFrame:
    out = df.select(F.col(factor).alias("level"), *keep, *[F.col(c).cast("double").alias(c) for c in (*xs, y)])
    for c in (*xs, y):
        out = out.where(F.col(c).isNotNull() & ~F.isnan(c))
    return out.where(F.col("level").isNotNull())


def fit_absorbed(df: DataFrame, y: str, xs: list[str], factor: str) -> AbsorbedFit:
    """Fit y ~ 1 + xs + levels of ``factor`` on all complete rows; NaN counts as missing.

    A column of ``xs`` that is constant within every level cannot be told from the levels: it is named in
    ``collinear`` and gets the coefficient of the shortest solution, zero.
    """
    rows = materialize(_complete(df, y, xs, factor, []), repartition=False)
    columns = [*xs, y]
    means = materialize(rows.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.var_pop(y).alias("var"), *[F.avg(c).alias(f"mean_{c}") for c in columns]),
                        repartition=False)
    grand = means.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col(f"mean_{y}")) / F.sum("n")).alias("m"), F.count(F.lit(1)).alias("k")).first()
    if not grand["n"]:
        raise ValueError("no complete rows")
    spread = means.agg(F.sum(F.col("n") * (F.col("var") + F.pow(F.col(f"mean_{y}") - grand["m"], 2)))).first()[0]
    inner = rows.join(means.select("level", *[f"mean_{c}" for c in columns]), "level")
    # a column without spread inside the levels leaves rounding only; relative to the column it is no information
    size = rows.agg(*[F.max(F.abs(c)).alias(c) for c in columns]).first()
    n, r = qr.r_factor(inner.select(*[_inner(c, size[c]).alias(c) for c in columns]), columns, intercept=False)
    s = qr.solve(r)
    df_resid = n - grand["k"] - s.rank
    s2 = s.ssr / df_resid if df_resid > 0 else float("nan")
    return AbsorbedFit(xs, s.coef, s2 * s.inverse, n, grand["k"], df_resid, s.ssr, float(spread), [xs[j] for j in s.collinear], means, factor)


def _inner(c: str, size: float) -> Column:
    d = F.col(c) - F.col(f"mean_{c}")
    return F.when(F.abs(d) > 1e-13 * (size or 0.0), d).otherwise(0.0)


def level_effects(fit: AbsorbedFit) -> DataFrame:
    """level, n, coef, std_err: each level's own intercept."""
    return _against(fit, None)


def _against(fit: AbsorbedFit, reference) -> DataFrame:
    y = next(c[5:] for c in reversed(fit.means.columns) if c.startswith("mean_"))
    cov = np.nan_to_num(fit.cov) if fit.df_resid <= 0 else fit.cov
    m = [F.col(f"mean_{c}") - (F.lit(0.0) if reference is None else F.lit(float(reference[f"mean_{c}"]))) for c in fit.terms]
    top = F.col(f"mean_{y}") - (F.lit(0.0) if reference is None else F.lit(float(reference[f"mean_{y}"])))
    coef, var = top, fit.sigma2 / F.col("n")
    if reference is not None:
        var = var + fit.sigma2 / float(reference["n"])
    for i, a in enumerate(m):
        coef = coef - float(fit.coef[i]) * a
        for j, b in enumerate(m):
            var = var + float(cov[i, j]) * a * b
    return fit.means.select("level", "n", coef.alias("coef"), F.sqrt(var).alias("std_err"))


@F.pandas_udf(StructType([StructField("p_value", DoubleType()), StructField("t_crit", DoubleType())]))
def _t_tests(t: pd.Series, nu: pd.Series) -> pd.DataFrame:
    crit = {v: t_ppf(0.975, v) for v in nu.unique()}
    return pd.DataFrame({"p_value": [t_sf2(a, v) if a == a else None for a, v in zip(t, nu, strict=True)], "t_crit": nu.map(crit)})


def coef_table(fit: AbsorbedFit, prefix: str | None = None) -> DataFrame:
    """term, coef, std_err, t_stat, p_value, ci_low, ci_high as dummy coding reports them.

    ``const`` is the first level in string order; every other level is a term ``{prefix}_{level}``.
    """
    spark = fit.means.sparkSession
    prefix = prefix or fit.factor
    name = F.col("level").cast("string")
    first = fit.means.orderBy(name, "level").first()
    own = level_effects(fit).where(F.col("level") == F.lit(first["level"])).select(F.lit("const").alias("term"), "coef", "std_err")
    slopes = spark.createDataFrame([(t, float(b), float(np.sqrt(max(v, 0.0)))) for t, b, v in zip(fit.terms, fit.coef, np.diag(fit.cov), strict=True)],
                                   "term string, coef double, std_err double")
    others = _against(fit, first).where(F.col("level") != F.lit(first["level"])).select(F.concat(F.lit(f"{prefix}_"), name).alias("term"), "coef", "std_err")
    out = own.unionByName(slopes).unionByName(others).withColumn("t_stat", F.try_divide("coef", "std_err"))
    tests = _t_tests(F.col("t_stat"), F.lit(float(fit.df_resid)))
    out = out.withColumn("tests", tests)
    return out.select("term", "coef", "std_err", "t_stat", F.col("tests.p_value").alias("p_value"),
                      (F.col("coef") - F.col("tests.t_crit") * F.col("std_err")).alias("ci_low"),
                      (F.col("coef") + F.col("tests.t_crit") * F.col("std_err")).alias("ci_high"))
