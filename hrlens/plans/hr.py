"""HR analyses: monthly turnover, exit reasons, attrition by group."""

from __future__ import annotations


from ..operators.hr import attrition_matrix, attrition_rate, termination_flag, turnover_by_month, value_share
from ..sources.tables import employees

# Exit statuses compared in the exit-reason share.
EXIT_STATUSES = ("Voluntary", "Involuntary")
LAST_MONTHS = 36


def turnover_monthly(spark, sf_dir):
    return turnover_by_month(employees(spark, sf_dir), last_n=LAST_MONTHS)


def exit_reason_share(spark, sf_dir):
    return value_share(employees(spark, sf_dir), "status", EXIT_STATUSES)


def attrition_dept_role(spark, sf_dir):
    return attrition_rate(employees(spark, sf_dir), ["department", "job_role"], termination_flag())


def attrition_heatmap(spark, sf_dir):
    return attrition_matrix(employees(spark, sf_dir), "department", "job_role", termination_flag())


def attrition_by_rating(spark, sf_dir):
    return attrition_rate(employees(spark, sf_dir), ["performance_rating"], termination_flag())
