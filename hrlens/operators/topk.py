"""Sorting, top-k and ranking operators.

Rows have no order in Spark, so every top-k takes an explicit tie-break list
(SURVEY D8/D9).  ``top_k`` compiles to ``TakeOrderedAndProject``: each task keeps
its own k best rows and only k·tasks rows reach the final merge — no global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = Sequence[Column | str]


def _cols(spec: OrderSpec) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in spec]


def top_k(df: DataFrame, k: int, order: OrderSpec, rank_col: str | None = "rank") -> DataFrame:
    """The first ``k`` rows under ``order`` with a 1-based rank column.

    The rank window runs on the k-row result only (bounded, one partition).
    """
    order_cols = _cols(order)
    out = df.orderBy(*order_cols).limit(k)
    if rank_col:
        out = out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order_cols)))
    return out


def rank_of(df: DataFrame, key_col: str, key_value, value_col: str) -> DataFrame:
    """1 + number of rows with a larger value than the named entity's.

    The entity's value is a scalar subquery (evaluated once, no join), then one
    aggregate pass counts the larger values.  Returns one row
    (key, value, rank, n_total); value and rank are NULL if the entity is absent.
    """
    target = df.where(F.col(key_col) == F.lit(key_value)).agg(F.max(value_col)).scalar()
    return df.agg(
        F.lit(key_value).alias(key_col),
        target.alias(value_col),
        F.when(target.isNotNull(), F.count_if(F.col(value_col) > target) + 1)
         .cast("bigint").alias("rank"),
        F.count(F.lit(1)).alias("n_total"))
