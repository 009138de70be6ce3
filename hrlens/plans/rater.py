"""Rater-bias analysis: random-intercept model, ICC, bias classes, adjusted scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.clean import round_sig, sig_sql
from ..operators.stats.design import add_dummies, all_levels
from ..operators.persist import materialize
from ..operators.stats.mixed import coef_rows, fit_random_intercept, random_effects
from ..sources.tables import ratings
from .memo import memo
from .stats import RATER_COLUMNS

# Bias classes and their cut-offs on the rater effect.
LENIENCY, SEVERITY, NEUTRAL = "Leniency (관대화)", "Severity (엄격화)", "Neutral (중립)"
BIAS_CUTOFF = 0.1
NUMERIC = ["performance_true", "goal_difficulty", "age", "tenure_years"]
CATEGORICAL = ["department", "job_level"]

COEF_SCHEMA = StructType([StructField("term", StringType()), StructField("coef", DoubleType()),
                          StructField("std_err", DoubleType()), StructField("z", DoubleType()),
                          StructField("p_value", DoubleType()), StructField("ci_low", DoubleType()),
                          StructField("ci_high", DoubleType())])


def design_df(raters: DataFrame):
    """Fixed-effect design of the rater model from a complete rater table (FIXTURES A5 columns)."""
    d = raters
    xs, names = [], ["Intercept"]
    found = all_levels(d, CATEGORICAL)
    for c in CATEGORICAL:
        d, cols = add_dummies(d, c, drop_first=True, lv=found[c], prefix=f"__{c}")
        xs += cols
        names += [f"C({c})[T.{n[len(c) + 3:]}]" for n in cols]
    xs += NUMERIC
    names += NUMERIC
    return d, xs, names


def complete_raters(raters: DataFrame) -> DataFrame:
    """The A5 columns with incomplete rows dropped, written once for the multi-pass fits."""
    return materialize(raters.select(*RATER_COLUMNS).na.drop(), repartition=False)


def fit_rater_model(raters: DataFrame, complete: DataFrame | None = None):
    """The full rater model on any rater table: (written design, fit, per-rater sums).

    ``raters`` must hold the A5 columns; incomplete rows are dropped first.
    """
    complete = complete_raters(raters) if complete is None else complete
    d, xs, names = design_df(complete)
    fit, gs = fit_random_intercept(d, "rater_id", "rating_score", xs, names)
    return d, fit, gs


def rater_reports(raters: DataFrame) -> dict:
    """Every rater-bias table for any rater table: mixed, icc, bias, adjusted."""
    spark = raters.sparkSession
    d, fit, gs = fit_rater_model(raters)
    null_fit, _ = fit_random_intercept(d, "rater_id", "rating_score", [], ["Intercept"])
    e = random_effects(fit, gs, "rater_id")
    return {"mixed": _mixed_df(spark, fit), "icc": _icc_df(spark, null_fit), "bias": _bias_df(e),
            "adjusted": _adjusted_df(d, e)}


def _complete(spark, sf_dir):
    return memo(spark, sf_dir, "rater_complete", lambda: complete_raters(ratings(spark, sf_dir)))


def full_model(spark, sf_dir):
    return memo(spark, sf_dir, "rater_full", lambda: fit_rater_model(None, _complete(spark, sf_dir)))


def _mixed_df(spark, fit):
    t = spark.createDataFrame(coef_rows(fit), COEF_SCHEMA)
    # a tail far out follows the last digits of z: nine decimals of it are what the fit fixes
    return t.select("term", *[(F.round(F.col(c) * 1e9) / 1e9 if c == "p_value" else round_sig(c)).alias(c) for c in t.columns if c != "term"])


def _icc_df(spark, fit):
    icc = fit.tau2 / (fit.tau2 + fit.sigma2) if fit.tau2 + fit.sigma2 > 0 else float("nan")
    t = spark.createDataFrame([(float(fit.tau2), float(fit.sigma2), float(icc), fit.n_groups, fit.n)],
                              "tau2 double, sigma2 double, icc double, n_raters long, n_obs long")
    return t.select(*[round_sig(c).alias(c) for c in ("tau2", "sigma2", "icc")], "n_raters", "n_obs")


def _bias_df(e: DataFrame) -> DataFrame:
    return (e.select("rater_id", F.expr(sig_sql("random_effect")).alias("random_effect"),
                     bias_class(F.col("random_effect")).alias("bias_type"))
             .orderBy(F.col("random_effect").desc(), "rater_id"))


def _adjusted_df(d: DataFrame, e: DataFrame) -> DataFrame:
    # no broadcast hint: AQE broadcasts the per-rater table when its runtime size
    # is small and splits a hot rater's partition
    j = d.select("employee_id", "rater_id", "rating_score").join(e, "rater_id", "left")
    return j.select("employee_id", "rater_id", "rating_score",
                    F.expr(sig_sql("random_effect")).alias("random_effect"),
                    F.expr(sig_sql("rating_score - random_effect")).alias("adjusted_rating_score"))


def rater_mixed(spark, sf_dir):
    """Fixed effects with z tests and the group (rater) variance."""
    _, fit, _ = full_model(spark, sf_dir)
    return _mixed_df(spark, fit)


def rater_icc(spark, sf_dir):
    """ICC = τ² / (τ² + σ²) of the intercept-only model."""
    fit, _ = fit_random_intercept(_complete(spark, sf_dir), "rater_id", "rating_score", [], ["Intercept"])
    return _icc_df(spark, fit)


def bias_class(effect):
    """P20: leniency above +0.1, severity below −0.1, else neutral."""
    return (F.when(effect > BIAS_CUTOFF, LENIENCY).when(effect < -BIAS_CUTOFF, SEVERITY)
             .otherwise(NEUTRAL))


def rater_bias(spark, sf_dir):
    """Per rater the random effect and its bias class, largest first."""
    _, fit, gs = full_model(spark, sf_dir)
    return _bias_df(random_effects(fit, gs, "rater_id"))


def rater_adjusted(spark, sf_dir):
    """Every rating minus its rater's effect (left join on rater)."""
    d, fit, gs = full_model(spark, sf_dir)
    return _adjusted_df(d, random_effects(fit, gs, "rater_id"))
