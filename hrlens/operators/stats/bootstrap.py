"""Poisson bootstrap of a regression line (M5).

Resampling n rows gives each row a binomial weight, which is Poisson(1) in the limit; drawn row by row, the weights need
no knowledge of n.  Row and replicate decide a weight by arithmetic alone, so a replicate is the same on any cluster and
in SQL: with the prime p = 2**31 - 1, k the row key's md5 modulo p and a, b the replicate's constants,
``u = (a k + b) mod p``, and the weight is the number of Poisson quantiles at or below u / p.

One pass keeps the sums of 1, x, y, x*x, x*y of every replicate; a task returns one row a replicate.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
#: Weights above this have a probability below 1 / PRIME.
MOST = 12
#: Weights held at once.
TOGETHER = 1 << 20


def thresholds() -> list[int]:
    """u from which on the weight is at least 1, 2, ..., MOST."""
    total, out = 0.0, []
    for w in range(MOST):
        total += math.exp(-1.0) / math.factorial(w)
        out.append(math.ceil(total * PRIME))
    return out


def md5_mod(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % PRIME


def constants(replicates: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    a = [1 + md5_mod(f"a:{b}:{seed}") % (PRIME - 1) for b in range(replicates)]
    return np.array(a, np.int64), np.array([md5_mod(f"b:{b}:{seed}") for b in range(replicates)], np.int64)


def key_mod(key: Column) -> Column:
    digits = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("bigint")
    return F.pmod(digits, F.lit(PRIME))


def line_replicates(df: DataFrame, x: str, y: str, key: str, replicates: int = 1000, seed: int = 42) -> DataFrame:
    """replicate, intercept, slope: the least-squares line of every replicate (NULL where a replicate has no line).

    Rows with a NULL or NaN x, y or key take no part.  x and y are taken relative to their means, so that the sums
    cancel little.
    """
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), key_mod(F.col(key)).alias("k"))
    d = d.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("k").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    centre = d.agg(F.avg("x").alias("x"), F.avg("y").alias("y")).first()
    mx, my = centre["x"] or 0.0, centre["y"] or 0.0
    a, b = constants(replicates, seed)
    limits = np.array(thresholds(), np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((replicates, 5))
        step = max(1, TOGETHER // replicates)
        for batch in batches:
            xs, ys, ks = batch["x"].to_numpy() - mx, batch["y"].to_numpy() - my, batch["k"].to_numpy(np.int64)
            m = np.column_stack([np.ones(len(xs)), xs, ys, xs * xs, xs * ys])
            for i in range(0, len(ks), step):
                u = (ks[i:i + step, None] * a + b) % PRIME
                sums += np.searchsorted(limits, u, side="right").T.astype(np.float64) @ m[i:i + step]
        yield pd.DataFrame(sums, columns=["n", "sx", "sy", "sxx", "sxy"]).assign(replicate=np.arange(replicates, dtype=np.int32))
    names = ["n", "sx", "sy", "sxx", "sxy"]
    parts = d.mapInPandas(run, ", ".join(f"{c} double" for c in names) + ", replicate int")
    s = parts.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in names])
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    s = s.withColumn("slope", slope)
    intercept = F.try_divide(F.col("sy") - F.col("slope") * F.col("sx"), F.col("n")) + my - F.col("slope") * mx
    return s.select("replicate", intercept.alias("intercept"), "slope")


def bootstrap_band(lines: DataFrame, lo: float, hi: float, points: int = 100, level: float = 0.95, scale: float = 1.0) -> pd.DataFrame:
    """x, lower, upper on an even grid: percentiles over the replicates' lines (one row a replicate comes to the driver)."""
    r = lines.where("slope is not null").select("intercept", "slope").toPandas()
    grid = np.linspace(lo, hi, points)
    at = r["intercept"].to_numpy()[:, None] + r["slope"].to_numpy()[:, None] * grid
    tail = (1 - level) / 2
    low, high = np.quantile(at, [tail, 1 - tail], axis=0) if len(r) else np.full((2, points), np.nan)
    return pd.DataFrame({"x": grid, "lower": low / scale, "upper": high / scale})
