"""Query keys → Spark plan builders, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import boosting, csv_types, hr, ml, payloads, rater, registry, stats, vectors

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "pay_topk_large": registry.pay_topk_large,
        "headcount_topk_region": registry.headcount_topk_region,
        "closures_by_month": registry.closures_by_month,
        "net_inflow_topk": registry.net_inflow_topk,
        "pay_vs_industry": registry.pay_vs_industry,
        "peer_pay": registry.peer_pay,
        "affiliate_pay": registry.affiliate_pay,
        "affiliate_rank": registry.affiliate_rank,
        "pay_summary_industry": registry.pay_summary_industry,
        "pay_summary_region": registry.pay_summary_region,
        "csv_types": csv_types.csv_types,
        "first_in_file": csv_types.first_in_file,
        "turnover_monthly": hr.turnover_monthly,
        "exit_reason_share": hr.exit_reason_share,
        "attrition_dept_role": hr.attrition_dept_role,
        "attrition_heatmap": hr.attrition_heatmap,
        "attrition_by_rating": hr.attrition_by_rating,
        "anova_industry": stats.anova_industry,
        "anova_industry_test": stats.anova_industry_test,
        "anova_region": stats.anova_region,
        "anova_region_test": stats.anova_region_test,
        "anova_rater": stats.anova_rater,
        "anova_rater_test": stats.anova_rater_test,
        "tukey_industry": stats.tukey_industry,
        "tukey_industry_test": stats.tukey_industry_test,
        "tukey_region": stats.tukey_region,
        "tukey_region_test": stats.tukey_region_test,
        "ols_year": stats.ols_year,
        "ols_year_report": stats.ols_year_report,
        "ols_year_fit": stats.ols_year_fit,
        "ols_headcount": stats.ols_headcount,
        "ols_headcount_report": stats.ols_headcount_report,
        "ols_headcount_fit": stats.ols_headcount_fit,
        "ols_line": stats.ols_line,
        "ols_line_boot": stats.ols_line_boot,
        "ols_firm_effects": stats.ols_firm_effects,
        "ols_multi": stats.ols_multi,
        "ols_multi_fit": stats.ols_multi_fit,
        "pay_api_topk": payloads.pay_api_topk,
        "pay_growth_topk": payloads.pay_growth_topk,
        "api_status_gate": payloads.api_status_gate,
        "news_rss": payloads.news_rss,
        "news_json": payloads.news_json,
        "news_dates": payloads.news_dates,
        "news_clean": payloads.news_clean,
        "page_links_topn": payloads.page_links_topn,
        "news_search_urls": payloads.news_search_urls,
        "person_centroids": vectors.person_centroids,
        "person_match": vectors.person_match,
        "person_match_all": vectors.person_match_all,
        "vector_match": vectors.vector_match,
        "largest_box": vectors.largest_box,
        "split_check": vectors.split_check,
        "split_exact": vectors.split_exact,
        "rater_mixed": rater.rater_mixed,
        "rater_icc": rater.rater_icc,
        "rater_bias": rater.rater_bias,
        "rater_adjusted": rater.rater_adjusted,
        "pay_model_compare": ml.pay_model_compare,
        "pay_model_compare_default": ml.pay_model_compare_default,
        "pay_model_compare_min_child5": ml.pay_model_compare_min_child5,
        "pay_importance": ml.pay_importance,
        "pay_shap": ml.pay_shap,
        "pay_shap_summary": ml.pay_shap_summary,
        "pay_gradient_histogram": boosting.pay_gradient_histogram,
        "pay_leafwise_tree": boosting.pay_leafwise_tree,
        "pay_newton_tree": boosting.pay_newton_tree,
        "pay_boosted": boosting.pay_boosted,
        "pay_forest": boosting.pay_forest,
        "activity_forest": boosting.activity_forest,
        "attrition_svm": ml.attrition_svm,
        "attrition_whatif": ml.attrition_whatif,
        "activity_rf": ml.activity_rf,
        "activity_importance": ml.activity_importance,
    }
    return q


def oracle_sql() -> dict[str, str]:
    from . import oracle_boost, oracle_hr, oracle_payloads, oracle_rater, oracle_registry, oracle_stats, oracle_vectors
    out: dict[str, str] = {}
    out.update(oracle_registry.sql())
    out.update(oracle_hr.sql())
    out.update(oracle_stats.sql())
    out.update(oracle_payloads.sql())
    out.update(oracle_vectors.sql())
    out.update(oracle_boost.sql())
    out.update(csv_types.sql())
    out.update(oracle_rater.sql())
    return out
