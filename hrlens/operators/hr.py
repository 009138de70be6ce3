"""HR operators: monthly turnover (R1), attrition rates, shares and pivots.

Monthly turnover in the analyses loops over months and masks the whole table
twice per month (O(months × rows)).  Here every employee emits at most three
(month, Δactive, terminated) events; a partial aggregation folds them to one
row per month before the only shuffle, and a running sum over the month spine
turns deltas into head counts.  The spine holds one row per calendar month
between the first hire and the last exit — its size depends on the date range,
never on the number of employees — so the ordered window over it is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import not_null_flag, round_sig
from .persist import materialize


def month_spine(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    """G1: one row per month start from month(lo) to month(hi) (from a one-row frame).

    An inverted range (last exit before the first hire) gives no months.
    """
    bounds = bounds.where(F.trunc(lo, "MM") <= F.trunc(hi, "MM"))
    return bounds.select(F.explode(F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"),
                                              F.expr("INTERVAL 1 MONTH"))).alias("month_start"))


def turnover_by_month(emp: DataFrame, hire: str = "hire_date", term: str = "termination_date",
                      last_n: int | None = 36) -> DataFrame:
    """J3/R1 + A11 + F14: active, terminated and turnover rate per month.

    active(m)     = rows with hire <= end(m) and (term is NULL or term >= start(m))
    terminated(m) = rows with start(m) <= term <= end(m)   (hire not tested)
    rate          = terminated / active * 100, or 0 when nobody is active.
    """
    h = F.trunc(F.col(hire), "MM")
    t = F.trunc(F.col(term), "MM")
    # the exit delta lands the month after the last active month; a spell that
    # ends before it starts cancels in the hire month
    exit_m = F.greatest(F.add_months(t, 1), h)
    ev = F.array(
        F.struct(F.when(F.col(hire).isNotNull(), h).alias("m"), F.lit(1).alias("d"), F.lit(0).alias("x")),
        F.struct(F.when(F.col(hire).isNotNull() & F.col(term).isNotNull(), exit_m).alias("m"),
                 F.lit(-1).alias("d"), F.lit(0).alias("x")),
        F.struct(t.alias("m"), F.lit(0).alias("d"), F.lit(1).alias("x")),
    )
    deltas = (emp.select(F.inline(ev)).where(F.col("m").isNotNull())
                 .groupBy("m").agg(F.sum("d").alias("d_active"), F.sum("x").alias("n_term")))
    bounds = emp.agg(F.min(hire).alias("lo"), F.max(term).alias("hi"))
    spine = month_spine(bounds.where(F.col("lo").isNotNull() & F.col("hi").isNotNull()), "lo", "hi")
    w = Window.orderBy("month_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # deltas hold one row per month with events (bounded by the date range, ≤ 12 per year)
    joined = (spine.join(F.broadcast(deltas), spine.month_start == deltas.m, "left")
                   .select("month_start",
                           F.sum(F.coalesce("d_active", F.lit(0))).over(w).cast("bigint").alias("active"),
                           F.coalesce("n_term", F.lit(0)).cast("bigint").alias("terminated")))
    if last_n:
        last = spine.agg(F.max("month_start")).scalar()
        joined = joined.where(F.col("month_start") > F.add_months(last, -last_n))
    rate = F.when(F.col("active") > 0, F.col("terminated") / F.col("active") * 100).otherwise(F.lit(0.0))
    return (joined.withColumn("turnover_rate", rate)
                  .select(F.date_format("month_start", "yyyy-MM").alias("month"), "active", "terminated",
                          round_sig("turnover_rate").alias("turnover_rate"))
                  .orderBy("month"))


def value_share(df: DataFrame, col: str, values=None) -> DataFrame:
    """A7 + A9: counts per value (NULL dropped), descending, with percent of total.

    The total is a scalar subquery over the aggregated counts (no global window).
    """
    base = df.where(F.col(col).isNotNull())
    if values is not None:
        base = base.where(F.col(col).isin(*values))
    counts = base.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / counts.agg(F.sum("n")).scalar() * 100
    return (counts.withColumn("share_pct", share)
                  .select(col, "n", round_sig("share_pct").alias("share_pct"))
                  .orderBy(F.col("n").desc(), col))


def rate_pct(flag: Column) -> Column:
    """A2: mean of a 0/1 flag × 100."""
    return F.avg(flag) * 100


def attrition_rate(df: DataFrame, keys: list[str], flag: Column) -> DataFrame:
    """A2: attrition rate in percent per key group; NULL keys dropped."""
    base = df
    for k in keys:
        base = base.where(F.col(k).isNotNull())
    return (base.groupBy(*keys).agg(rate_pct(flag).alias("rate"))
                .select(*keys, round_sig("rate").alias("turnover_rate_pct"))
                .orderBy(*keys))


def attrition_matrix(df: DataFrame, row_key: str, col_key: str, flag: Column,
                     col_values: list | None = None) -> DataFrame:
    """Pivot of the attrition rate, row_key × col_key, missing cell → NULL.

    Pass ``col_values`` to skip the distinct-values job.
    """
    base = df.where(F.col(row_key).isNotNull() & F.col(col_key).isNotNull())
    cells = base.groupBy(row_key, col_key).agg(rate_pct(flag).alias("__rate"))
    if col_values is None:
        # the cells are written once; finding the columns and pivoting read them, not the table
        cells = materialize(cells, repartition=False)
    g = cells.groupBy(row_key)
    p = g.pivot(col_key, col_values) if col_values is not None else g.pivot(col_key)
    wide = p.agg(F.first("__rate", ignorenulls=True))
    cols = [c for c in wide.columns if c != row_key]
    return wide.select(row_key, *[round_sig(c).alias(c) for c in cols]).orderBy(row_key)


def termination_flag(term: str = "termination_date") -> Column:
    """1 when an exit date is present."""
    return not_null_flag(term)
