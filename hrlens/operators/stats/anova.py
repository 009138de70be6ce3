"""One-way ANOVA (M1) and Tukey–Kramer pairwise comparisons (M2).

Both read only per-group sufficient statistics (n, mean, sample variance),
computed by one partially-aggregated ``groupBy``; groups never get collected
as value lists.  The grand mean is a scalar subquery over the group table and
the sums of squares are a second aggregate over it, so even a table with
millions of groups (raters) is reduced by Spark, not by the driver.  p-values
come from a pandas UDF applied to the small result rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ...functions.clean import round_sig
from .dist import f_sf, psturng, qtukey


@F.pandas_udf(DoubleType())
def f_pvalue_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_sf(a, b, c) if pd.notna(a) else None for a, b, c in zip(f, d1, d2)],
                     dtype="float64")


@F.pandas_udf(StructType([StructField("p_adj", DoubleType()), StructField("q_crit", DoubleType())]))
def tukey_udf(q: pd.Series, k: pd.Series, nu: pd.Series, alpha: pd.Series) -> pd.DataFrame:
    """Adjusted p-value and critical value per pair, one Python pass (q_crit cached per (α, k, ν))."""
    crit: dict = {}
    p_adj, q_crit = [], []
    for a, b, c, al in zip(q, k, nu, alpha):
        key = (al, int(b), c)
        if key not in crit:
            crit[key] = qtukey(1.0 - al, int(b), c)
        q_crit.append(crit[key])
        p_adj.append(psturng(a, int(b), c) if pd.notna(a) else None)
    return pd.DataFrame({"p_adj": pd.Series(p_adj, dtype="float64"), "q_crit": pd.Series(q_crit, dtype="float64")})


def clean_groups(df: DataFrame, group_col: str, value: Column | str) -> DataFrame:
    """Rows with a group and a finite value (D16: NULL/NaN dropped first)."""
    v = F.col(value) if isinstance(value, str) else value
    return (df.select(F.col(group_col).alias("grp"), v.cast("double").alias("y"))
              .where(F.col("grp").isNotNull() & F.col("y").isNotNull() & ~F.isnan("y")))


def group_moments(df: DataFrame, group_col: str, value: Column | str) -> DataFrame:
    """Per group n, mean, sample variance (NULL for a one-row group)."""
    return (clean_groups(df, group_col, value).groupBy("grp")
            .agg(F.count("y").alias("n"), F.avg("y").alias("mean"), F.var_samp("y").alias("var")))


def anova_oneway(df: DataFrame, group_col: str, value: Column | str) -> DataFrame:
    """One row: k, N, SSB, SSW, df, MS and F (F NULL when MSW is 0 or df is 0)."""
    g = group_moments(df, group_col, value)
    grand = g.agg(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).scalar()
    t = g.agg(F.count(F.lit(1)).alias("n_groups"),
              F.sum("n").alias("n_total"),
              F.sum(F.col("n") * F.pow(F.col("mean") - grand, 2)).alias("ss_between"),
              F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ss_within"))
    t = (t.withColumn("df_between", F.col("n_groups") - 1)
          .withColumn("df_within", F.col("n_total") - F.col("n_groups"))
          .withColumn("ms_between", F.try_divide("ss_between", "df_between"))
          .withColumn("ms_within", F.try_divide("ss_within", "df_within"))
          .withColumn("f_stat", F.try_divide("ms_between", "ms_within")))
    return t


def anova_table(df: DataFrame, group_col: str, value: Column | str, factor: str) -> DataFrame:
    """The F table (oracle-checkable part)."""
    t = anova_oneway(df, group_col, value)
    return t.select(F.lit(factor).alias("factor"), "n_groups", "n_total", "df_between", "df_within",
                    *[round_sig(c).alias(c) for c in ("ss_between", "ss_within", "ms_between",
                                                      "ms_within", "f_stat")])


def anova_test(df: DataFrame, group_col: str, value: Column | str, factor: str,
               alpha: float = 0.05) -> DataFrame:
    """F, p-value and verdict; only meaningful with more than one group."""
    t = anova_oneway(df, group_col, value)
    p = F.when(F.col("n_groups") > 1, f_pvalue_udf("f_stat", "df_between", "df_within"))
    return (t.withColumn("p_value", p)
             .select(F.lit(factor).alias("factor"), "n_groups", "df_between", "df_within",
                     round_sig("f_stat").alias("f_stat"), round_sig("p_value").alias("p_value"),
                     (F.col("p_value") < alpha).alias("significant"),
                     F.when(F.col("n_groups") < 2, "not enough groups").when(F.col("p_value") < alpha, "group means differ")
                     .when(F.col("p_value") >= alpha, "no significant difference").alias("verdict")))


def _compared(df: DataFrame, group_col: str, value: Column | str) -> DataFrame:
    """One row: the k group summaries ``g`` in one sorted array, ``k``, ``ms_within``, ``df_within`` and ``f_stat``.

    The table is read once; what ANOVA and the comparisons need comes from the array.  Tukey's result has
    k(k-1)/2 rows, so its groups are few by construction (``anova_oneway`` takes any number).
    """
    packed = group_moments(df, group_col, value).agg(F.sort_array(F.collect_list(F.struct("grp", "n", "mean", "var"))).alias("g"))

    def total(term):
        return F.aggregate(F.transform("g", term), F.lit(0.0), lambda acc, v: acc + v)
    t = packed.select("g", F.size("g").cast("long").alias("k"),
                      F.aggregate("g", F.lit(0).cast("long"), lambda acc, r: acc + r["n"]).alias("n_total"),
                      total(lambda r: r["n"] * r["mean"]).alias("sum"),
                      total(lambda r: (r["n"] - 1) * F.coalesce(r["var"], F.lit(0.0))).alias("ss_within"))
    t = t.withColumn("grand", F.try_divide("sum", "n_total")).withColumn("df_within", F.col("n_total") - F.col("k"))
    t = t.withColumn("ss_between", total(lambda r: r["n"] * F.pow(r["mean"] - F.col("grand"), 2)))
    t = t.withColumn("ms_within", F.try_divide("ss_within", "df_within"))
    return t.select("g", "k", "ms_within", "df_within",
                    F.try_divide(F.try_divide("ss_between", F.col("k") - 1), "ms_within").alias("f_stat"))


def _pairs(compared: DataFrame) -> DataFrame:
    """All k(k-1)/2 pairs of groups, group1 < group2, made with array functions: no join."""
    k_ = F.size("g")

    def later(i):
        return F.when(i + 1 < k_, F.sequence(i + 1, k_ - 1)).otherwise(F.array().cast("array<int>"))

    idx = F.when(k_ > 1, F.sequence(F.lit(0), k_ - 2)).otherwise(F.array().cast("array<int>"))
    pair_arr = F.flatten(F.transform(idx, lambda i: F.transform(
        later(i), lambda j: F.struct(F.col("g")[i].alias("a"), F.col("g")[j].alias("b")))))
    pairs = compared.select("k", "ms_within", "df_within", F.explode(pair_arr).alias("p")).select(
        "k", "ms_within", "df_within",
        F.col("p.a.grp").alias("group1"), F.col("p.a.n").alias("n1"), F.col("p.a.mean").alias("mean1"),
        F.col("p.b.grp").alias("group2"), F.col("p.b.n").alias("n2"), F.col("p.b.mean").alias("mean2"))
    se = F.sqrt(F.col("ms_within") / 2 * (F.lit(1.0) / F.col("n1") + F.lit(1.0) / F.col("n2")))
    return (pairs.withColumn("meandiff", F.col("mean2") - F.col("mean1"))
                 .withColumn("std_pair", se)
                 .withColumn("q_stat", F.try_divide(F.abs(F.col("meandiff")), F.col("std_pair"))))


def tukey_table(df: DataFrame, group_col: str, value: Column | str) -> DataFrame:
    """Pairwise mean differences and their studentized statistics (oracle part)."""
    p = _pairs(_compared(df, group_col, value))
    return p.select("group1", "group2", "n1", "n2", round_sig("meandiff").alias("meandiff"),
                    round_sig("std_pair").alias("std_pair"), round_sig("q_stat").alias("q_stat")) \
            .orderBy("group1", "group2")


def tukey_hsd(df: DataFrame, group_col: str, value: Column | str, alpha: float = 0.05,
              only_after_anova: bool = False) -> DataFrame:
    """Tukey HSD: group1, group2, meandiff, p-adj, lower, upper, reject (α = 0.05).

    With ``only_after_anova`` the pairs are compared only if the F test rejects at ``alpha``, else there are no rows.
    """
    c = _compared(df, group_col, value)
    if only_after_anova:
        c = c.where("k > 1").where(f_pvalue_udf("f_stat", F.col("k") - 1, "df_within") < alpha)
    p = _pairs(c)
    t = tukey_udf(F.col("q_stat"), F.col("k"), F.col("df_within"), F.lit(alpha))
    p = (p.withColumn("t", t)
          .withColumn("q_crit", F.col("t.q_crit"))
          .withColumn("p_adj", F.col("t.p_adj"))
          .withColumn("lower", F.col("meandiff") - F.col("q_crit") * F.col("std_pair"))
          .withColumn("upper", F.col("meandiff") + F.col("q_crit") * F.col("std_pair")))
    return p.select("group1", "group2", round_sig("meandiff").alias("meandiff"),
                    F.round("p_adj", 4).alias("p_adj"), round_sig("lower").alias("lower"),
                    round_sig("upper").alias("upper"),
                    (F.col("q_stat") > F.col("q_crit")).alias("reject")).orderBy("group1", "group2")
