"""Registry analyses: pay estimates, top-k lists, closures, benchmarks.

Each ``*_df`` function takes the establishment table (any source with the
FIXTURES A1 aliases: a cp949 CSV through ``sources.registry_csv`` or the
stand-in view) and returns a lazy DataFrame.  The query keys in ``catalog`` bind
them to the test tables with the stand-in parameters below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import contains_text, date_column, round_sig, trunc_to_long
from ..functions.pay import annual_pay, to_10k, trunc_10k, with_annual_pay
from ..operators.topk import rank_of, top_k
from ..sources.tables import establishments

# Fixed values of the registry: status codes.
ACTIVE, WITHDRAWN = 1, 2

# Stand-in parameters.  The analyses name Korean industry/region codes and
# company names that do not exist in the test tables; these are the equivalents
# there (FIXTURES B: industry = market segment, region = nation key, name =
# customer name).  The reference values are kept next to them for users of
# the real registry.
PARAMS = {
    "large_headcount": 200,            # reference: 2000 (testdata has none that large)
    "top_k": 10,
    "topk_regions": (1, 4),            # reference: (11, 41)
    "industry": "MACHINERY",           # reference: 300100
    "target_name": "Customer#000000001",   # reference: the benchmarked company
    "peer_names": ("Customer#000000001", "Customer#000000002",
                   "Customer#000000004", "Customer#000000007"),
    "affiliate_substring": "#00000001",    # reference: the group's name prefix
    "affiliate_target": "Customer#000000012",
    "closure_year": 1999,              # reference: 2025
    "summary_min_headcount": 200,
    "summary_industries": ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"),
    "summary_regions": (1, 4, 7, 10),  # reference: (41, 11, 28, 52)
}


def _est(spark: SparkSession, sf_dir: str) -> DataFrame:
    return establishments(spark, sf_dir)


# pay top-k of large active establishments ---------------------------------------
def pay_topk_large_df(est: DataFrame, min_headcount: int, k: int) -> DataFrame:
    base = (est.where((F.col("status_code") == ACTIVE) & (F.col("headcount") >= min_headcount))
               .select("est_id", "est_name", "headcount",
                       trunc_10k(annual_pay()).alias("annual_pay_10k"))
               .where(F.col("annual_pay_10k").isNotNull()))
    out = top_k(base, k, [F.col("annual_pay_10k").desc(), "est_name", "est_id"])
    return out.select("rank", "est_id", "est_name", "headcount", "annual_pay_10k")


def pay_topk_large(spark, sf_dir):
    return pay_topk_large_df(_est(spark, sf_dir), PARAMS["large_headcount"], PARAMS["top_k"])


# headcount top-k in two regions --------------------------------------------------
def headcount_topk_region_df(est: DataFrame, regions, k: int) -> DataFrame:
    base = (est.where(F.col("region_code").isin(*regions) & F.col("headcount").isNotNull())
               .select("est_id", "est_name", "region_code", "headcount"))
    out = top_k(base, k, [F.col("headcount").desc(), "est_name", "est_id"])
    return out.select("rank", "est_id", "est_name", "region_code", "headcount")


def headcount_topk_region(spark, sf_dir):
    return headcount_topk_region_df(_est(spark, sf_dir), PARAMS["topk_regions"], PARAMS["top_k"])


# closures per month of one year --------------------------------------------------
def closures_by_month_df(est: DataFrame, year: int, all_months: bool = False) -> DataFrame:
    """Closures per month of ``year``; ``all_months`` adds zero rows for empty months (A8 axis)."""
    end = date_column(est, "end_date")
    # year filter written as a date range so a stored date column prunes files
    closed = (est.where(F.col("status_code") == WITHDRAWN)
                 .select(end.alias("end_date"))
                 .where((F.col("end_date") >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
                        & (F.col("end_date") < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1)))))
    counts = (closed.groupBy(F.month("end_date").alias("close_month"))
                    .agg(F.count(F.lit(1)).alias("n_closed")))
    if all_months:
        spine = est.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("close_month"))
        counts = (spine.join(counts, "close_month", "left")
                       .select("close_month", F.coalesce("n_closed", F.lit(0).cast("bigint")).alias("n_closed")))
    return counts.orderBy("close_month")


def closures_by_month(spark, sf_dir):
    return closures_by_month_df(_est(spark, sf_dir), PARAMS["closure_year"])


# net inflow top-k within one industry ---------------------------------------------
def net_inflow_topk_df(est: DataFrame, industry, k: int) -> DataFrame:
    base = (est.where((F.col("status_code") == ACTIVE) & (F.col("industry_code") == F.lit(industry)))
               .select("est_id", "est_name", (F.col("joiners") - F.col("leavers")).alias("net_inflow"))
               .where(F.col("net_inflow").isNotNull()))
    out = top_k(base, k, [F.col("net_inflow").desc(), "est_name", "est_id"])
    return out.select("rank", "est_id", "est_name", "net_inflow")


def net_inflow_topk(spark, sf_dir):
    return net_inflow_topk_df(_est(spark, sf_dir), PARAMS["industry"], PARAMS["top_k"])


# one company against its industry mean ------------------------------------------
def pay_vs_industry_df(est: DataFrame, industry, target_name: str) -> DataFrame:
    """Industry mean pay and the company's pay (its first row by est_id), one pass."""
    peers = (est.where((F.col("status_code") == ACTIVE) & (F.col("industry_code") == F.lit(industry)))
                .select("est_id", "est_name", to_10k(annual_pay()).alias("pay_10k")))
    is_target = F.col("est_name") == F.lit(target_name)
    agg = peers.agg(
        F.avg("pay_10k").alias("industry_avg_10k"),
        F.min_by("pay_10k", F.when(is_target, F.col("est_id"))).alias("company_pay_10k"),
        F.count("pay_10k").alias("n_peers"))
    return agg.select(F.lit(target_name).alias("target_name"),
                      round_sig("industry_avg_10k").alias("industry_avg_10k"),
                      round_sig("company_pay_10k").alias("company_pay_10k"),
                      "n_peers")


def pay_vs_industry(spark, sf_dir):
    return pay_vs_industry_df(_est(spark, sf_dir), PARAMS["industry"], PARAMS["target_name"])


# mean pay of named peers ---------------------------------------------------------
def peer_pay_df(est: DataFrame, names) -> DataFrame:
    return (est.where((F.col("status_code") == ACTIVE) & F.col("est_name").isin(*names))
               .groupBy("est_name")
               .agg(F.avg(to_10k(annual_pay())).alias("avg_pay_10k_raw"))
               .select("est_name", trunc_to_long("avg_pay_10k_raw").alias("avg_pay_10k"))
               .orderBy(F.col("avg_pay_10k").desc_nulls_last(), "est_name"))


def peer_pay(spark, sf_dir):
    return peer_pay_df(_est(spark, sf_dir), PARAMS["peer_names"])


# affiliates by name substring -----------------------------------------------------
def _affiliates(est: DataFrame, substring: str) -> DataFrame:
    return (est.where((F.col("status_code") == ACTIVE) & contains_text("est_name", substring))
               .groupBy("est_name")
               .agg(F.coalesce(F.sum("headcount"), F.lit(0).cast("bigint")).alias("total_headcount"),
                    F.avg(to_10k(annual_pay())).alias("avg_pay_10k_raw")))


def affiliate_pay_df(est: DataFrame, substring: str) -> DataFrame:
    return (_affiliates(est, substring)
            .select("est_name", "total_headcount",
                    trunc_to_long("avg_pay_10k_raw").alias("avg_pay_10k"))
            .orderBy(F.col("avg_pay_10k").desc_nulls_last(), "est_name"))


def affiliate_pay(spark, sf_dir):
    return affiliate_pay_df(_est(spark, sf_dir), PARAMS["affiliate_substring"])


def affiliate_rank_df(est: DataFrame, substring: str, target: str) -> DataFrame:
    g = _affiliates(est, substring)
    r = rank_of(g, "est_name", target, "avg_pay_10k_raw")
    return r.select("est_name", round_sig("avg_pay_10k_raw").alias("avg_pay_10k"),
                    "rank", F.col("n_total").alias("n_affiliates"))


def affiliate_rank(spark, sf_dir):
    return affiliate_rank_df(_est(spark, sf_dir), PARAMS["affiliate_substring"],
                             PARAMS["affiliate_target"])


# count and mean pay per group ----------------------------------------------------
def pay_summary_df(est: DataFrame, group_col: str, values, min_headcount: int) -> DataFrame:
    base = (with_annual_pay(
        est.where((F.col("status_code") == ACTIVE) & (F.col("headcount") >= min_headcount)
                  & F.col(group_col).isin(*values))))
    return (base.groupBy(group_col)
                .agg(F.count("est_name").alias("n_establishments"),
                     F.avg("annual_pay_10k").alias("avg_raw"))
                .select(group_col, "n_establishments", trunc_to_long("avg_raw").alias("avg_pay_10k"))
                .orderBy(group_col))


def pay_summary_industry(spark, sf_dir):
    return pay_summary_df(_est(spark, sf_dir), "industry_code", PARAMS["summary_industries"],
                          PARAMS["summary_min_headcount"])


def pay_summary_region(spark, sf_dir):
    return pay_summary_df(_est(spark, sf_dir), "region_code", PARAMS["summary_regions"],
                          PARAMS["summary_min_headcount"])
