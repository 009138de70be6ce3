"""DuckDB text of the stand-in views (FIXTURES.md part B) and shared SQL pieces.

The driver runs ``oracle_sql()`` entries in DuckDB with the parquet tables
registered as views; the stand-in views are therefore inlined as CTEs.  This is
test-oracle text only — the Spark jobs never parse SQL from here.
"""

from __future__ import annotations

from ..functions.clean import sig_sql

CTE = {
    "li_by_order": """li_by_order AS (
  SELECT l_orderkey, CAST(SUM(l_quantity) AS BIGINT) AS headcount,
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS joiners,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS leavers
  FROM lineitem GROUP BY l_orderkey)""",
    "est": """est AS (
  SELECT o.o_orderkey AS est_id, c.c_name AS est_name,
         CASE o.o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS status_code,
         c.c_mktsegment AS industry_code, c.c_nationkey AS region_code,
         li.headcount, o.o_totalprice AS billed_amount, li.joiners, li.leavers,
         CAST(o.o_orderdate AS DATE) AS start_date,
         CASE WHEN o.o_orderstatus = 'F'
              THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_custkey % 720 AS INTEGER) END AS end_date,
         o.o_orderpriority
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN li_by_order li ON li.l_orderkey = o.o_orderkey)""",
    "emp": """emp AS (
  SELECT est_id AS employee_id, start_date AS hire_date,
         CASE WHEN status_code <> 1 THEN start_date + CAST(est_id % 720 AS INTEGER) END AS termination_date,
         CASE WHEN status_code = 1 THEN 'Active' WHEN est_id % 3 = 0 THEN 'Involuntary'
              ELSE 'Voluntary' END AS status,
         industry_code AS department, o_orderpriority AS job_role,
         1 + region_code % 5 AS performance_rating, billed_amount AS salary,
         COALESCE(headcount, 0) AS work_hours,
         CASE WHEN status_code = 1 THEN 0 ELSE 1 END AS left_flag
  FROM est)""",
    "ratings": """ratings AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS employee_id, l.l_suppkey AS rater_id,
         l.l_quantity / 10 + (l.l_suppkey % 7 - 3) * 0.25E0 AS rating_score,
         l.l_returnflag AS department, l.l_linestatus AS job_level,
         l.l_extendedprice / 10000 AS performance_true, l.l_discount AS goal_difficulty,
         l.l_tax AS age, p.p_size AS tenure_years
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)""",
    "pay_by_year": """pay_by_year AS (
  SELECT c_name AS org_name, year(o_orderdate) AS pay_year,
         format('{:,.1f}', avg(o_totalprice)) AS avg_pay_text
  FROM orders JOIN customer ON c_custkey = o_custkey
  GROUP BY c_name, year(o_orderdate))""",
}

_DEPS = {"est": ["li_by_order"], "emp": ["li_by_order", "est"]}


def with_views(*names: str, extra: str = "") -> str:
    """``WITH`` clause holding the named stand-in views (dependencies first)."""
    order: list[str] = []
    for n in names:
        for d in _DEPS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    parts = [CTE[n] for n in order]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


# Pay expressions in the same evaluation order as functions/pay.py.
PAY_WON = "((billed_amount / NULLIF(headcount, 0)) / CAST(0.095 AS DOUBLE)) * 12"
PAY_10K = f"({PAY_WON} / 10000)"


def trunc_sql(expr: str) -> str:
    """``astype(int)``: truncate toward zero (DuckDB's cast would round)."""
    return f"CAST(trunc({expr}) AS BIGINT)"


def sig(expr: str) -> str:
    return sig_sql(expr)
