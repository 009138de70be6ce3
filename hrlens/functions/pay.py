"""Pay-estimate expressions over the establishment registry.

The registry reports the pension contribution billed for the month and the
headcount; the yearly pay estimate divides the per-capita amount by the
contribution rate and multiplies by twelve.  The evaluation order below is the
one the analyses use, so doubles agree digit for digit with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import safe_div, trunc_to_long

# Contribution rate, months per year, currency unit steps.
CONTRIBUTION_RATE = 0.095
MONTHS_PER_YEAR = 12
WON_PER_10K = 10000
THOUSAND_PER_10K = 10


def per_capita(billed: str | Column = "billed_amount", headcount: str | Column = "headcount") -> Column:
    """Billed amount / headcount, NULL when the headcount is 0 or NULL."""
    return safe_div(billed, headcount)


def annual_pay(billed: str | Column = "billed_amount", headcount: str | Column = "headcount",
               rate: float = CONTRIBUTION_RATE) -> Column:
    """(per-capita / rate) * 12, in won."""
    return (per_capita(billed, headcount) / F.lit(rate)) * F.lit(MONTHS_PER_YEAR)


def to_10k(c: Column) -> Column:
    """Won → 10k won."""
    return c / F.lit(WON_PER_10K)


def with_annual_pay(df: DataFrame, rate: float = CONTRIBUTION_RATE) -> DataFrame:
    """The shared prefix of the registry analyses.

    Adds ``annual_pay`` (won) and ``annual_pay_10k`` (10k won, not truncated).
    """
    return (df.withColumn("annual_pay", annual_pay(rate=rate))
              .withColumn("annual_pay_10k", to_10k(F.col("annual_pay"))))


def trunc_10k(c: Column) -> Column:
    """P15+P16: won → whole 10k won, truncated toward zero."""
    return trunc_to_long(to_10k(c))
