"""Registry and rater statistics: ANOVA, Tukey HSD, OLS reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import code_to_text, date_column, round_sig
from ..functions.pay import with_annual_pay
from ..operators.persist import materialize
from ..operators.stats import absorb, anova, bootstrap, ols
from ..operators.stats.design import add_dummies
from ..sources.tables import establishments, ratings
from .registry import ACTIVE, PARAMS

RATER_COLUMNS = ["employee_id", "rater_id", "rating_score", "department", "job_level",
                 "performance_true", "goal_difficulty", "age", "tenure_years"]


def large_active_df(est: DataFrame, min_headcount: int) -> DataFrame:
    """Active establishments with at least ``min_headcount``, with pay and year (any registry)."""
    base = est.where((F.col("status_code") == ACTIVE) & (F.col("headcount") >= min_headcount))
    return (with_annual_pay(base)
            .withColumn("year", F.year(date_column(base, "start_date", "yyyy-MM-dd"))))


def large_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return large_active_df(establishments(spark, sf_dir), PARAMS["summary_min_headcount"])


def _industry(spark, sf_dir):
    return large_active(spark, sf_dir).where(F.col("industry_code").isin(*PARAMS["summary_industries"]))


def _region(spark, sf_dir):
    return large_active(spark, sf_dir).where(F.col("region_code").isin(*PARAMS["summary_regions"]))


def rater_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rater table with complete rows only (``dropna()``)."""
    return ratings(spark, sf_dir).select(*RATER_COLUMNS).na.drop()



# ANOVA -------------------------------------------------------------------------
def anova_industry(spark, sf_dir):
    return anova.anova_table(_industry(spark, sf_dir), "industry_code", "annual_pay", "industry_code")


def anova_industry_test(spark, sf_dir):
    return anova.anova_test(_industry(spark, sf_dir), "industry_code", "annual_pay", "industry_code")


def anova_region(spark, sf_dir):
    return anova.anova_table(_region(spark, sf_dir), "region_code", "annual_pay_10k", "region_code")


def anova_region_test(spark, sf_dir):
    return anova.anova_test(_region(spark, sf_dir), "region_code", "annual_pay_10k", "region_code")


def anova_rater(spark, sf_dir):
    return anova.anova_table(rater_table(spark, sf_dir), "rater_id", "rating_score", "rater_id")


def anova_rater_test(spark, sf_dir):
    return anova.anova_test(rater_table(spark, sf_dir), "rater_id", "rating_score", "rater_id")


# Tukey -------------------------------------------------------------------------
def tukey_industry(spark, sf_dir):
    return anova.tukey_table(_industry(spark, sf_dir), "industry_code", "annual_pay")


def tukey_industry_test(spark, sf_dir):
    return anova.tukey_hsd(_industry(spark, sf_dir), "industry_code", "annual_pay", only_after_anova=True)


def tukey_region(spark, sf_dir):
    return anova.tukey_table(_region(spark, sf_dir), "region_code", "annual_pay_10k")


def tukey_region_test(spark, sf_dir):
    return anova.tukey_hsd(_region(spark, sf_dir), "region_code", "annual_pay_10k", only_after_anova=True)


# OLS ---------------------------------------------------------------------------
def _coef_df(spark, fit, with_tests: bool) -> DataFrame:
    pdf = ols.coef_frame(fit, with_tests=with_tests)
    df = spark.createDataFrame(pdf)
    return df.select("term", *[round_sig(c).alias(c) for c in pdf.columns if c != "term"])


def _fit_df(spark, fit) -> DataFrame:
    return spark.createDataFrame(ols.fit_frame(fit)).select("statistic", round_sig("value").alias("value"))


def _simple(spark, sf_dir, x: str, diagnostics: bool = True):
    d = large_active(spark, sf_dir).select("est_id", x, "annual_pay")
    return ols.ols_fit(d, "annual_pay", [x], order_key="est_id" if diagnostics else None,
                       diagnostics=diagnostics)


def ols_year(spark, sf_dir):
    return _coef_df(spark, _simple(spark, sf_dir, "year", diagnostics=False), with_tests=False)


def ols_year_report(spark, sf_dir):
    return _coef_df(spark, _simple(spark, sf_dir, "year", diagnostics=False), with_tests=True)


def ols_year_fit(spark, sf_dir):
    return _fit_df(spark, _simple(spark, sf_dir, "year"))


def ols_headcount(spark, sf_dir):
    return _coef_df(spark, _simple(spark, sf_dir, "headcount", diagnostics=False), with_tests=False)


def ols_headcount_report(spark, sf_dir):
    return _coef_df(spark, _simple(spark, sf_dir, "headcount", diagnostics=False), with_tests=True)


def ols_headcount_fit(spark, sf_dir):
    return _fit_df(spark, _simple(spark, sf_dir, "headcount"))


def ols_line(spark, sf_dir):
    """M5: fitted pay (10k won) over headcount with the analytic 95 % band."""
    d = large_active(spark, sf_dir).select("headcount", "annual_pay")
    fit = ols.ols_fit(d, "annual_pay", ["headcount"], diagnostics=False)
    rng = d.where(F.col("annual_pay").isNotNull()).agg(F.min("headcount"), F.max("headcount")).first()
    pdf = ols.band_frame(fit, "headcount", float(rng[0]), float(rng[1]), scale=10000.0)
    df = spark.createDataFrame(pdf).withColumnRenamed("x", "headcount")
    return df.select(*[round_sig(c).alias(c) for c in df.columns])


def ols_line_boot(spark, sf_dir):
    """M5: fitted pay (10k won) over headcount with the band of 1,000 Poisson bootstrap replicates."""
    d = large_active(spark, sf_dir).select("est_id", "headcount", "annual_pay")
    d = materialize(d.where(F.col("headcount").isNotNull() & F.col("annual_pay").isNotNull() & ~F.isnan("annual_pay")), repartition=False)
    fit = ols.ols_fit(d, "annual_pay", ["headcount"], diagnostics=False)
    lo, hi = d.agg(F.min("headcount"), F.max("headcount")).first()
    lines = bootstrap.line_replicates(d, "headcount", "annual_pay", "est_id")
    pdf = bootstrap.bootstrap_band(lines, float(lo), float(hi), scale=10000.0)
    pdf.insert(1, "fit", (fit.coef[0] + fit.coef[1] * pdf["x"]) / 10000.0)
    df = spark.createDataFrame(pdf).withColumnRenamed("x", "headcount")
    return df.select(*[round_sig(c).alias(c) for c in df.columns])


def firm_effects(spark, sf_dir) -> absorb.AbsorbedFit:
    """Pay of every active establishment ~ headcount + year + one effect a firm, however many firms there are."""
    active = large_active_df(establishments(spark, sf_dir), 1)
    return absorb.fit_absorbed(active, "annual_pay", ["headcount", "year"], "est_name")


def ols_firm_effects(spark, sf_dir):
    """M4/M12 with a factor of any cardinality: dummy-coded coefficients with their errors, a row a firm."""
    t = absorb.coef_table(firm_effects(spark, sf_dir), "firm")
    return t.select("term", *[round_sig(c).alias(c) for c in ("coef", "std_err", "t_stat")])


def multi_design_df(large: DataFrame, industries, regions):
    """Multiple-regression and model design: pay ~ headcount + year + industry and region dummies (drop first).

    ``large`` is ``large_active_df`` of any registry; returns (design, feature names).
    """
    base = large.where(F.col("industry_code").isin(*industries) & F.col("region_code").isin(*regions))
    base = (base.select("est_id", "annual_pay", "headcount", "year",
                        code_to_text("industry_code").alias("industry_code"),
                        code_to_text("region_code").alias("region_code")).na.drop())
    base = materialize(base, repartition=False)
    d, ind = add_dummies(base, "industry_code", drop_first=True)
    d, reg = add_dummies(d, "region_code", drop_first=True)
    return d, ["headcount", "year"] + ind + reg


def multi_design(spark, sf_dir):
    return multi_design_df(large_active(spark, sf_dir), PARAMS["summary_industries"], PARAMS["summary_regions"])


def ols_multi(spark, sf_dir):
    d, xs = multi_design(spark, sf_dir)
    fit = ols.ols_fit(d, "annual_pay", xs, diagnostics=False, checkpoint=False)
    return _coef_df(spark, fit, with_tests=True)


def ols_multi_fit(spark, sf_dir):
    d, xs = multi_design(spark, sf_dir)
    fit = ols.ols_fit(d, "annual_pay", xs, order_key="est_id", checkpoint=False)
    return _fit_df(spark, fit)
