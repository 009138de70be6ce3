"""Path-dependent SHAP values of a forest whose subtrees are a table.

A leaf is a box: of each feature an interval (the cuts met on the way) and the share ``z`` of the training weight that
stays when the feature is unknown.  Its part in a row's values depends only on the pattern of intervals that hold the
row (``treeshap.py``).  Few intervals of a fine feature hold a given row.  So of the feature with the most different
values, the leaf's part with the row outside that interval is summed once for each combination of the other features,
and only the rows inside it are met one by one.

Equal rows are explained once.  Spark brings each subtree together with each group of some ``POINTS`` rows, and sums
over the subtrees; no task holds the forest or all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..persist import materialize
from .forest import Forest
from .treeshap import _patterns_phi

#: Different rows that meet a subtree at a time.
POINTS = 10_000
#: Leaves times combinations, or times rows inside, that are handled at a time.
CELLS = 200_000


def boxes(tree: dict, k: int, root: tuple | None = None) -> tuple[np.ndarray, ...]:
    """lo, hi, z (nodes x features; a box holds lo < x <= hi, NaN: no bound) and which nodes are leaves."""
    feature, cut, left, right, cover = (np.asarray(tree[c]) for c in ("feature", "cut", "left", "right", "cover"))
    n = len(feature)
    lo, hi, z = np.full((n, k), np.nan), np.full((n, k), np.nan), np.ones((n, k))
    if root is not None:
        lo[0], hi[0], z[0] = root
    level = np.array([0])
    while len(level := level[left[level] >= 0]):
        f = feature[level]
        for child, bound in ((left[level], hi), (right[level], lo)):
            for a in (lo, hi, z):
                a[child] = a[level]
            bound[child, f] = cut[level]
            z[child, f] *= cover[child] / cover[level]
        level = np.concatenate([left[level], right[level]])
    return lo, hi, z, left < 0


def _holds(lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether intervals (n) hold values (m); a missing value is right of every cut."""
    return ~(x[None, :] <= lo[:, None]) & (np.isnan(hi)[:, None] | (x[None, :] <= hi[:, None]))


def box_shap(lo: np.ndarray, hi: np.ndarray, z: np.ndarray, value: np.ndarray, x: np.ndarray) -> np.ndarray:
    """SHAP values (rows x features) that the boxes with these values give to the rows of x."""
    n, k = x.shape
    fine = int(np.argmax([len(np.unique(x[:, j])) for j in range(k)]))
    others = [j for j in range(k) if j != fine]
    order = np.argsort(x[:, fine], kind="stable")  # a missing value last
    v = x[order, fine]
    combos, of = np.unique(x[order][:, others], axis=0, return_inverse=True)
    of, m = of.reshape(-1), len(combos)
    outside, inside = np.zeros((m, k)), np.zeros((n, k))
    bounded = ~(np.isnan(lo[:, fine]) & np.isnan(hi[:, fine]))
    start = np.where(np.isnan(lo[:, fine]), 0, np.searchsorted(v, lo[:, fine], side="right"))
    stop = np.where(np.isnan(hi[:, fine]), n, np.searchsorted(v, hi[:, fine], side="right"))
    met = np.where(bounded, np.maximum(stop - start, 0), 0)
    at = 0
    while at < len(value):
        some = np.cumsum(met[at:at + max(1, CELLS // m)])
        end = at + max(1, int(np.searchsorted(some, max(CELLS, n), side="right")))
        b = slice(at, end)
        # patterns of the other features by (box, combination), numbered within the block
        pattern = np.repeat(np.arange(end - at)[:, None], m, axis=1)
        for i, j in enumerate(others):
            pattern = 2 * pattern + _holds(lo[b, j], hi[b, j], combos[:, i])
            if i % 30 == 29:
                pattern = np.unique(pattern, return_inverse=True)[1].reshape(pattern.shape)
        _, first, number = np.unique(pattern, return_index=True, return_inverse=True)
        number = number.reshape(pattern.shape)
        box, combo = first // m, first % m
        o = np.ones((len(first), k))
        for i, j in enumerate(others):
            o[:, j] = ~(combos[combo, i] <= lo[b][box, j]) & (np.isnan(hi[b][box, j]) | (combos[combo, i] <= hi[b][box, j]))
        o[:, fine] = ~bounded[b][box]
        out = _patterns_phi(z[b][box], o, value[b][box])
        where = np.broadcast_to(np.arange(m), number.shape).ravel()
        for j in range(k):
            outside[:, j] += np.bincount(where, out[number.ravel(), j], m)
        count = met[b]
        if count.sum():
            o[:, fine] = 1.0
            more = _patterns_phi(z[b][box], o, value[b][box]) - out
            leaf = np.repeat(np.arange(end - at), count)
            row = np.arange(len(leaf)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start[b], count)
            which = number[leaf, of[row]]
            for j in range(k):
                inside[:, j] += np.bincount(row, more[which, j], n)
        at = end
    phi = np.empty((n, k))
    phi[order] = inside + outside[of]
    return phi


def _tops(model: Forest) -> tuple[dict, list[dict]]:
    """The box of each node of the upper levels where a subtree begins, and the leaves there as subtrees of one node."""
    k, roots, leaves = len(model.features), {}, []
    for t, top in enumerate(model.tops):
        lo, hi, z, ends = boxes(vars(top), k)
        for i in np.flatnonzero(ends).tolist():
            roots[t, i] = lo[i], hi[i], z[i]
            if top.value[i] is not None:
                leaves.append({"tree": t, "node": i, "feature": [-1], "cut": [0.0], "left": [-1], "right": [-1], "value": [top.value[i]],
                               "gain": [0.0] * k, "cover": [top.cover[i]]})
    return roots, leaves


def _subtrees(model: Forest, leaves: list[dict]) -> DataFrame:
    if not leaves:
        return model.subtrees
    spark = model.subtrees.sparkSession
    return model.subtrees.unionByName(spark.createDataFrame(leaves, model.subtrees.schema))


def forest_base(model: Forest) -> float:
    """Mean prediction over the training weight: each tree's mean of its leaves, averaged."""
    def leaf_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch.itertuples():
                leaf = np.asarray(s.left) < 0
                w = np.asarray(s.cover)[leaf]
                yield pd.DataFrame({"tree": [s.tree], "w": [w.sum()], "s": [w @ np.array([v[0] for v in s.value])[leaf]]})
    sums = _subtrees(model, _tops(model)[1]).mapInPandas(leaf_sums, "tree int, w double, s double")
    means = sums.groupBy("tree").agg((F.sum("s") / F.sum("w")).alias("mean"))
    return float(means.agg(F.avg("mean")).first()[0] or 0.0)


def forest_shap(df: DataFrame, id_col: str, model: Forest, points_together: int = POINTS) -> DataFrame:
    """(id, feature, feature_value, shap_value) for every row of ``df``; the forest predicts a number."""
    k = len(model.features)
    names, parts = [f"f{j}" for j in range(k)], [f"s{j}" for j in range(k)]
    rows = df.select(id_col, *[F.col(f"`{f}`").cast("double").alias(n) for f, n in zip(model.features, names, strict=True)])
    points = materialize(rows.select(*names).distinct().withColumn("point", F.monotonically_increasing_id()), repartition=False)
    groups = max(1, math.ceil(points.count() / points_together))
    grouped = points.withColumn("part", F.pmod(F.xxhash64("point"), F.lit(groups)).cast("int"))
    roots, leaves = _tops(model)
    trees = max(1, _subtrees(model, leaves).select("tree").distinct().count())  # a tree without a drawn row has no vote
    subtrees = _subtrees(model, leaves).drop("gain").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    places = model.subtrees.sparkSession.createDataFrame(sorted(roots), "tree int, node int")

    def explain(points_: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if points_.empty or tree.empty:
            return pd.DataFrame(columns=["point", *parts])
        s = tree.iloc[0]
        lo, hi, z, leaf = boxes(s, k, roots[int(s["tree"]), int(s["node"])])
        value = np.array([v[0] for v in s["value"]])[leaf] / trees
        phi = box_shap(lo[leaf], hi[leaf], z[leaf], value, points_[names].to_numpy(np.float64, na_value=np.nan))
        return pd.DataFrame({"point": points_["point"].to_numpy(), **{c: phi[:, j] for j, c in enumerate(parts)}})
    met = grouped.crossJoin(F.broadcast(places))  # places: the upper levels, at most some 2 n / group_rows a tree
    each = met.groupBy("tree", "node", "part").cogroup(subtrees.groupBy("tree", "node", "part")).applyInPandas(
        explain, "point long, " + ", ".join(f"{c} double" for c in parts))
    sums = each.groupBy("point").agg(*[F.sum(c).alias(c) for c in parts])
    known = points.join(sums, "point").select(*[F.col(n).alias(f"p_{n}") for n in names], *parts)
    same = [F.col(n).eqNullSafe(F.col(f"p_{n}")) for n in names]
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(n).alias("feature_value"), F.col(c).alias("shap_value"))
                                for f, n, c in zip(model.features, names, parts, strict=True)])).alias("cell")
    return rows.join(known, same).select(id_col, cells).select(id_col, "cell.*")
