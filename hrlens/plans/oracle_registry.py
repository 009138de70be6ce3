"""DuckDB oracle SQL for the registry keys (same parameters as plans/registry.py)."""

from __future__ import annotations

from .oracle_views import PAY_10K, sig, trunc_sql, with_views
from .registry import PARAMS as P


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _topk(select_cols: str, base: str, order: str, k: int) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, {select_cols} "
            f"FROM (SELECT * FROM ({base}) b ORDER BY {order} LIMIT {k}) t")


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    pay_base = (f"SELECT est_id, est_name, headcount, {trunc_sql(PAY_10K)} AS annual_pay_10k FROM est "
                f"WHERE status_code = 1 AND headcount >= {P['large_headcount']}")
    q["pay_topk_large"] = with_views("est") + _topk(
        "est_id, est_name, headcount, annual_pay_10k",
        f"SELECT * FROM ({pay_base}) x WHERE annual_pay_10k IS NOT NULL",
        "annual_pay_10k DESC, est_name, est_id", P["top_k"])

    q["headcount_topk_region"] = with_views("est") + _topk(
        "est_id, est_name, region_code, headcount",
        f"SELECT est_id, est_name, region_code, headcount FROM est "
        f"WHERE region_code IN ({_in(P['topk_regions'])}) AND headcount IS NOT NULL",
        "headcount DESC, est_name, est_id", P["top_k"])

    y = P["closure_year"]
    q["closures_by_month"] = with_views("est") + (
        f"SELECT CAST(month(end_date) AS INTEGER) AS close_month, count(*) AS n_closed FROM est "
        f"WHERE status_code = 2 AND end_date >= DATE '{y}-01-01' AND end_date < DATE '{y + 1}-01-01' "
        f"GROUP BY 1 ORDER BY 1")

    q["net_inflow_topk"] = with_views("est") + _topk(
        "est_id, est_name, net_inflow",
        f"SELECT est_id, est_name, joiners - leavers AS net_inflow FROM est "
        f"WHERE status_code = 1 AND industry_code = '{P['industry']}' AND joiners - leavers IS NOT NULL",
        "net_inflow DESC, est_name, est_id", P["top_k"])

    t = P["target_name"]
    q["pay_vs_industry"] = with_views("est") + (
        f"SELECT '{t}' AS target_name, {sig('a')} AS industry_avg_10k, {sig('c')} AS company_pay_10k, n_peers "
        f"FROM (SELECT avg(pay_10k) AS a, arg_min(pay_10k, est_id) FILTER (WHERE est_name = '{t}') AS c, "
        f"count(pay_10k) AS n_peers FROM (SELECT est_id, est_name, {PAY_10K} AS pay_10k FROM est "
        f"WHERE status_code = 1 AND industry_code = '{P['industry']}') p) s")

    q["peer_pay"] = with_views("est") + (
        f"SELECT est_name, {trunc_sql('avg(' + PAY_10K + ')')} AS avg_pay_10k FROM est "
        f"WHERE status_code = 1 AND est_name IN ({_in(P['peer_names'])}) GROUP BY est_name "
        f"ORDER BY avg_pay_10k DESC, est_name")

    aff = (f"SELECT est_name, COALESCE(SUM(headcount), 0) AS total_headcount, avg({PAY_10K}) AS v "
           f"FROM est WHERE status_code = 1 AND contains(est_name, '{P['affiliate_substring']}') "
           f"GROUP BY est_name")
    q["affiliate_pay"] = with_views("est") + (
        f"SELECT est_name, CAST(total_headcount AS BIGINT) AS total_headcount, {trunc_sql('v')} AS avg_pay_10k "
        f"FROM ({aff}) g ORDER BY avg_pay_10k DESC, est_name")

    at = P["affiliate_target"]
    q["affiliate_rank"] = with_views("est") + (
        f"SELECT '{at}' AS est_name, {sig('tv')} AS avg_pay_10k, "
        f"CASE WHEN tv IS NOT NULL THEN CAST(n_larger + 1 AS BIGINT) END AS rank, n_affiliates FROM ("
        f"SELECT (SELECT max(v) FROM ({aff}) g2 WHERE est_name = '{at}') AS tv, "
        f"count(*) FILTER (WHERE v > (SELECT max(v) FROM ({aff}) g3 WHERE est_name = '{at}')) AS n_larger, "
        f"count(*) AS n_affiliates FROM ({aff}) g) s")

    for key, col, vals in (("pay_summary_industry", "industry_code", P["summary_industries"]),
                           ("pay_summary_region", "region_code", P["summary_regions"])):
        q[key] = with_views("est") + (
            f"SELECT {col}, count(est_name) AS n_establishments, {trunc_sql('avg(' + PAY_10K + ')')} AS avg_pay_10k "
            f"FROM est WHERE status_code = 1 AND headcount >= {P['summary_min_headcount']} "
            f"AND {col} IN ({_in(vals)}) GROUP BY {col} ORDER BY {col}")
    return q
