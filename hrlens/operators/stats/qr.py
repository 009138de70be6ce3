"""Tall-skinny QR: the R factor of a distributed design, merged in a tree.

Every task folds its rows into one triangular factor, batch by batch; the tasks' factors are dealt to a few tasks that
fold them again, and one last task folds those.  A task holds one k x k factor and a batch, the driver gets one factor,
whatever the number of rows.  R holds all that least squares needs, without squaring the condition number as a Gram
matrix does, and one path serves any number of columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relative length left of a scaled column below which it is a combination of the columns before it.
COLLINEAR = 1e-10


def fold(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Triangular factor (non-negative diagonal) of ``r`` with more rows below it."""
    out = np.linalg.qr(np.vstack([r, rows]), mode="r")
    sign = np.where(np.diag(out) < 0, -1.0, 1.0)
    return out * sign[:, None]


def r_factor(d: DataFrame, columns: list[str], intercept: bool = True) -> tuple[int, np.ndarray]:
    """Number of rows and R of the columns (doubles without NULL), a column of ones first if ``intercept``."""
    k = len(columns) + intercept

    def of_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r, n = np.empty((0, k)), 0
        for batch in batches:
            if len(batch):
                x = batch.to_numpy(dtype=np.float64)
                r = fold(r, np.hstack([np.ones((len(x), 1)), x]) if intercept else x)
                n += len(x)
        if n:
            yield pd.DataFrame({"n": [n], "first": [float(r[0, -1])], "r": [r.tobytes()]})

    def of_factors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r, n = np.empty((0, k)), 0
        for batch in batches:
            for m, blob in zip(batch["n"], batch["r"], strict=True):
                r = fold(r, np.frombuffer(blob).reshape(-1, k))
                n += m
        if n:
            yield pd.DataFrame({"n": [n], "first": [float(r[0, -1])], "r": [r.tobytes()]})
    schema = "n long, first double, r binary"
    parts = d.select(*columns).mapInPandas(of_rows, schema)
    merged = parts.repartition("n", "first").mapInPandas(of_factors, schema)  # as many tasks as the factors' bytes call for
    found = merged.repartition(1).mapInPandas(of_factors, schema).collect()
    r = np.zeros((k, k))
    if not found:
        return 0, r
    part = np.frombuffer(found[0]["r"]).reshape(-1, k)
    r[:len(part)] = part
    return int(found[0]["n"]), r


def independent_columns(r: np.ndarray) -> list[int]:
    """Columns of ``r`` that no others explain, by pivoting: always the one with most length left, relative to its own.

    Ties go to the earlier column, so of collinear columns the later ones are named as such.
    """
    length = np.sqrt((r * r).sum(axis=0))
    left = r / np.where(length > 0, length, 1.0)
    chosen: list[int] = []
    for _ in range(r.shape[1]):
        rest = np.sqrt((left * left).sum(axis=0))
        rest[chosen] = -1.0
        best = int(np.argmax(rest > 0.999999 * rest.max()))
        if rest[best] <= COLLINEAR:
            break
        chosen.append(best)
        q = left[:, best] / rest[best]
        for _ in range(2):  # the second pass takes away what rounding left of the first
            left = left - np.outer(q, q @ left)
    return sorted(chosen)


@dataclass
class Solution:
    coef: np.ndarray
    #: (X'X)^-1 or its pseudo-inverse
    inverse: np.ndarray
    ssr: float
    rank: int
    cond: float
    collinear: list[int]


def solve(r: np.ndarray) -> Solution:
    """Least squares of the last column on the others; the shortest solution where columns are collinear."""
    k = r.shape[1] - 1
    rx, ry = r[:k, :k], r[:k, k]
    kept = independent_columns(rx)
    if len(kept) == k:
        inv = np.linalg.solve(rx, np.eye(k)) if k else np.zeros((0, 0))
        rest, cond = 0.0, float(np.linalg.norm(rx, 2) * np.linalg.norm(inv, 2)) if k else 1.0
    else:
        u, s, vt = np.linalg.svd(rx)
        m = len(kept)
        inv = (vt[:m].T / s[:m]) @ u[:, :m].T
        rest, cond = float(((ry - u[:, :m] @ (u[:, :m].T @ ry)) ** 2).sum()), float("inf")
    return Solution(inv @ ry, inv @ inv.T, rest + float(r[k, k]) ** 2, len(kept), cond, [j for j in range(k) if j not in kept])
