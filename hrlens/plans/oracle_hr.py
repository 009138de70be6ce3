"""DuckDB oracle SQL for the HR keys (range-join form of the monthly loop)."""

from __future__ import annotations

from .oracle_views import sig, with_views

# The job roles of the stand-in HR view (order priorities of the test tables).
STANDIN_JOB_ROLES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["turnover_monthly"] = with_views("emp", extra="""b AS (SELECT min(hire_date) AS lo, max(termination_date) AS hi FROM emp),
m AS (SELECT CAST(g AS DATE) AS ms, CAST(g + INTERVAL 1 MONTH AS DATE) AS next_ms
      FROM b, unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP),
                                     CAST(date_trunc('month', hi) AS TIMESTAMP), INTERVAL 1 MONTH)) AS t(g)
      WHERE lo IS NOT NULL AND hi IS NOT NULL),
c AS (SELECT m.ms,
        count(*) FILTER (WHERE e.hire_date < m.next_ms
                         AND (e.termination_date IS NULL OR e.termination_date >= m.ms)) AS active,
        count(*) FILTER (WHERE e.termination_date >= m.ms AND e.termination_date < m.next_ms) AS terminated
      FROM m CROSS JOIN emp e GROUP BY m.ms),
r AS (SELECT ms, active, terminated,
        CASE WHEN active > 0 THEN CAST(terminated AS DOUBLE) / CAST(active AS DOUBLE) * 100 ELSE 0.0 END AS rate
      FROM c WHERE ms > (SELECT max(ms) FROM m) - INTERVAL 36 MONTH)""") + (
        f"SELECT strftime(ms, '%Y-%m') AS month, active, terminated, {sig('rate')} AS turnover_rate "
        f"FROM r ORDER BY month")

    q["exit_reason_share"] = with_views("emp") + (
        f"SELECT status, n, {sig('CAST(n AS DOUBLE) / CAST(tot AS DOUBLE) * 100')} AS share_pct FROM ("
        f"SELECT status, count(*) AS n, sum(count(*)) OVER () AS tot FROM emp "
        f"WHERE status IN ('Voluntary', 'Involuntary') GROUP BY status) s ORDER BY n DESC, status")

    flag = "CASE WHEN termination_date IS NOT NULL THEN 1 ELSE 0 END"
    q["attrition_dept_role"] = with_views("emp") + (
        f"SELECT department, job_role, {sig(f'avg({flag}) * 100')} AS turnover_rate_pct FROM emp "
        f"WHERE department IS NOT NULL AND job_role IS NOT NULL GROUP BY department, job_role "
        f"ORDER BY department, job_role")
    cells = ", ".join(
        f"{sig(f'avg(CASE WHEN job_role = {chr(39)}{r}{chr(39)} THEN {flag} END) * 100')} AS \"{r}\""
        for r in STANDIN_JOB_ROLES)
    q["attrition_heatmap"] = with_views("emp") + (
        f"SELECT department, {cells} FROM emp WHERE department IS NOT NULL AND job_role IS NOT NULL "
        f"GROUP BY department ORDER BY department")
    q["attrition_by_rating"] = with_views("emp") + (
        f"SELECT performance_rating, {sig(f'avg({flag}) * 100')} AS turnover_rate_pct FROM emp "
        f"WHERE performance_rating IS NOT NULL GROUP BY performance_rating ORDER BY performance_rating")
    return q
