"""The cleaning and pay expressions as SQL functions (U2), for ``spark.sql`` users.

``CREATE TEMPORARY FUNCTION … RETURN <expr>`` defines SQL functions that
Catalyst inlines into the plan like any built-in expression — no Python runs.
Bodies are built from the same constants as the Column helpers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .clean import HTML_ENTITIES_IN_ORDER
from .pay import CONTRIBUTION_RATE, MONTHS_PER_YEAR, WON_PER_10K


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _clean_body() -> str:
    body = "regexp_replace(s, '<[^\\\\n]*?>', '')"
    for ent, ch in HTML_ENTITIES_IN_ORDER:
        body = f"replace({body}, {_sql_str(ent)}, {_sql_str(ch)})"
    return body


FUNCTIONS = {
    "clean_html": ("s STRING", "STRING", _clean_body()),
    "annual_pay": ("billed DOUBLE, headcount DOUBLE", "DOUBLE",
                   f"(try_divide(billed, headcount) / {CONTRIBUTION_RATE}D) * {MONTHS_PER_YEAR}"),
    "annual_pay_10k": ("billed DOUBLE, headcount DOUBLE", "BIGINT",
                       f"try_cast(((try_divide(billed, headcount) / {CONTRIBUTION_RATE}D) * {MONTHS_PER_YEAR})"
                       f" / {WON_PER_10K} AS BIGINT)"),
    "money_to_long": ("s STRING", "BIGINT", "try_cast(split_part(replace(s, ',', ''), '.', 1) AS BIGINT)"),
    "bias_class": ("effect DOUBLE", "STRING",
                   "CASE WHEN effect > 0.1 THEN 'Leniency (관대화)' WHEN effect < -0.1 THEN 'Severity (엄격화)' ELSE 'Neutral (중립)' END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(FUNCTIONS)
