"""Second-order gradient boosting from distributed histograms.

Features are cut into bins at quantiles (mergeable sketches, one aggregate for all features) and the binned rows are
written once, rows of equal bins as one cell with their number and sum of labels: they share every node and score.  A
tree needs, of each node, the sums of gradient and hessian by (feature, bin).  Each task adds up those of its cells in
the nodes in question, Spark adds up the tasks', and the driver holds only these sums (nodes x features x bins).  Of two
siblings the smaller one is summed, the other is parent minus sibling.

A split's gain is Newton's: ``GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)``, a leaf's value ``-G / (H + l2)``.
Nodes are split best gain first, up to ``max_leaves`` and ``max_depth``: with a bound on leaves trees grow leaf-wise,
with a bound on depth only they grow depth-wise.  The children of all nodes that may still be split are summed in one
job, so a tree takes about as many jobs as it is deep, though it is grown one leaf at a time.

Missing values have a bin of their own and go to the side with the larger gain.  Ties of gain (to nine digits) go to
the lower node, feature and bin.  After each tree the cells' scores are written as the next round's table.

Bins bound the number of cells, whatever the number of rows.  As long as they are no more than a task can hold, counted
beforehand, one task grows all trees from them with the same steps, instead of some eight Spark jobs a tree.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..persist import Rounds

#: Ranks of the quantile sketch are off by at most rows / ACCURACY.
ACCURACY = 100_000
#: Numbers (bins, label, rows, score, place) of the cells that one task may hold.
HELD = 1 << 25


@dataclass(frozen=True)
class Params:
    rounds: int = 100
    rate: float = 0.1
    max_leaves: int | None = 31
    max_depth: int | None = None
    l2: float = 0.0
    min_rows: int = 20
    min_hessian: float = 1e-3
    min_gain: float = 0.0
    bins: int = 255
    loss: str = "squared"


#: Leaf-wise with 31 leaves, and depth-wise with a penalty on the leaf values, as in the analyses.
LEAF_WISE = Params()
DEPTH_WISE = Params(rate=0.3, max_leaves=None, max_depth=6, l2=1.0, min_rows=1, min_hessian=1.0, bins=256)


@dataclass
class Node:
    depth: int
    n: int
    value: float
    hist: np.ndarray | None = None        # features x bins x (gradient, hessian, rows); bin 0: missing
    feature: int = -1
    bin: int = 0
    missing_left: bool = False
    gain: float = 0.0
    left: int = -1
    right: int = -1
    split: bool = False
    step: int = -1                        # order of the split


@dataclass
class Model:
    features: list[str]
    cuts: list[np.ndarray]
    base: float
    params: Params
    trees: list[list[Node]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Raw scores of rows of feature values."""
        out = np.full(len(x), self.base)
        binned = np.column_stack([bin_of(x[:, j], c) for j, c in enumerate(self.cuts)]) if len(self.cuts) else np.zeros((len(x), 0), int)
        for nodes in self.trees:
            todo = [(0, np.arange(len(x)))]
            while todo:
                i, rows = todo.pop()
                node = nodes[i]
                if not node.split:
                    out[rows] += self.params.rate * node.value
                    continue
                b = binned[rows, node.feature]
                left = np.where(b == 0, node.missing_left, b <= node.bin)
                todo += [(node.left, rows[left]), (node.right, rows[~left])]
        return out

    def importance(self, kind: str = "gain") -> np.ndarray:
        """Share of the features in the total gain, or in the number of splits."""
        out = np.zeros(len(self.features))
        for node in (n for t in self.trees for n in t if n.split):
            out[node.feature] += node.gain if kind == "gain" else 1
        return out / out.sum() if out.sum() else out


def bin_of(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """1 + the number of cuts below x; 0 where x is missing."""
    x = np.asarray(x, np.float64)
    return np.where(np.isnan(x), 0, 1 + np.searchsorted(cuts, x, side="left")).astype(np.int64)


def cut_points(df: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Distinct quantiles of each feature, the largest value left out; at most ``bins`` - 1 a feature."""
    share = [i / bins for i in range(1, bins)]
    kept = [F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")) for f in features]
    row = df.agg(*[F.percentile_approx(c, share, ACCURACY).alias(f"q{j}") for j, c in enumerate(kept)],
                 *[F.max(c).alias(f"m{j}") for j, c in enumerate(kept)]).first()
    return [np.array(sorted({v for v in row[f"q{j}"] or [] if v < row[f"m{j}"]}), np.float64) for j in range(len(features))]


def binned(df: DataFrame, features: list[str], cuts: list[np.ndarray], label: str) -> DataFrame:
    """label and bins of every row with a label."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            b = np.column_stack([bin_of(batch[f"f{j}"].to_numpy(np.float64, na_value=np.nan), c) for j, c in enumerate(cuts)]) if cuts else np.zeros((len(batch), 0))
            yield pd.DataFrame({"label": batch["label"].to_numpy(np.float64), "bins": list(b.astype(np.int16))})
    y = F.col(label).cast("double")
    rows = df.where(y.isNotNull() & ~F.isnan(y)).select(y.alias("label"), *[F.col(f).cast("double").alias(f"f{j}") for j, f in enumerate(features)])
    return rows.mapInPandas(run, "label double, bins array<smallint>")


def cells(rows: DataFrame) -> DataFrame:
    """Rows of label and bins, with those of equal bins as one: bins, n, and label as their sum."""
    return rows.groupBy("bins").agg(F.sum("label").alias("label"), F.count(F.lit(1)).alias("n"))


def derivatives(loss: str, score: np.ndarray, label: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the loss of n rows at their score; ``label`` is the sum of theirs."""
    if loss == "squared":
        return n * score - label, n.astype(np.float64, copy=False)
    if loss == "logistic":
        p = 1 / (1 + np.exp(-score))
        return n * p - label, n * p * (1 - p)
    raise ValueError(f"unknown loss {loss!r}")


def place(nodes: list[Node], bins: np.ndarray) -> np.ndarray:
    """Number of the node that each row of bins has come to."""
    left, right, feature, cut, missing = (np.array([getattr(n, a) for n in nodes]) for a in ("left", "right", "feature", "bin", "missing_left"))
    at = np.zeros(len(bins), np.int64)
    going = np.flatnonzero(left[at] >= 0)
    while len(going):
        node = at[going]
        b = bins[going, feature[node]]
        at[going] = np.where((b <= cut[node]) & ((b > 0) | missing[node]), left[node], right[node])
        going = going[left[at[going]] >= 0]
    return at


def rescored(rows: DataFrame, nodes: list[Node], rate: float) -> DataFrame:
    """The cells with a tree's values added to their scores."""
    value = np.array([rate * n.value for n in nodes])
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = batch.column("bins")
            score = batch.column("score").to_numpy() + value[place(nodes, bins.flatten().to_numpy().reshape(len(bins), -1))]
            yield pa.RecordBatch.from_arrays([pa.array(score) if c == "score" else batch.column(c) for c in names], names=names)
    return rows.mapInArrow(run, rows.schema)


def histograms(rows: DataFrame, nodes: list[Node], wanted: list[int], shape: tuple[int, int], loss: str) -> dict[int, np.ndarray]:
    """Sums of gradient, hessian and rows by (feature, bin) of the wanted nodes; ``rows`` without n are single rows."""
    k, width = shape
    bare = [Node(0, 0, 0.0, feature=n.feature, bin=n.bin, missing_left=n.missing_left, left=n.left, right=n.right) for n in nodes]
    slot = np.full(len(nodes), -1)
    slot[wanted] = np.arange(len(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(wanted) * k * width))
        for batch in batches:
            bins = batch.column("bins").flatten().to_numpy().reshape(-1, k)
            at = slot[place(bare, bins)]
            keep = at >= 0
            bins, at, (score, label, n) = bins[keep], at[keep], (batch.column(c).to_numpy()[keep] for c in ("score", "label", "n"))
            g, h = derivatives(loss, score, label, n)
            cell = (at[:, None] * k + np.arange(k)) * width + bins
            for sums, v in zip(total, (g, h, n), strict=True):
                for j in range(k):
                    sums += np.bincount(cell[:, j], v, len(sums))
        used = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(v[used]) for v in total]], names=["cell", "g", "h", "n"])
    if not k:
        return {i: np.zeros((0, width, 3)) for i in wanted}
    n = F.col("n") if "n" in rows.columns else F.lit(1)
    parts = rows.select("bins", *[F.col(c).cast("double").alias(c) for c in ("score", "label")], n.cast("long").alias("n")).mapInArrow(run, "cell long, g double, h double, n double")
    out = np.zeros((len(wanted) * k * width, 3))
    for r in parts.groupBy("cell").agg(*[F.sum(c).alias(c) for c in "ghn"]).collect():  # at most wanted nodes x features x bins
        out[r["cell"]] = r["g"], r["h"], r["n"]
    return dict(zip(wanted, out.reshape(len(wanted), k, width, 3), strict=True))


def nine_digits(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        unit = 10.0 ** (np.ceil(np.log10(np.abs(x))) - 9)
        return np.where((x == 0) | ~np.isfinite(x), x, np.round(x / unit) * unit)


def best_split(node: Node, p: Params) -> None:
    """Sets the node's feature, bin, direction of missing values and gain (0 without a split)."""
    total = node.hist[0].sum(axis=0)
    missing = node.hist[:, :1, :]
    low = np.cumsum(node.hist[:, 1:, :], axis=1)
    best = None
    for to_left in (False, True):
        left = low + missing if to_left else low
        right = total - left
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left[..., 0] ** 2 / (left[..., 1] + p.l2) + right[..., 0] ** 2 / (right[..., 1] + p.l2) - total[0] ** 2 / (total[1] + p.l2))
        fits = (np.minimum(left[..., 2], right[..., 2]) >= max(1, p.min_rows)) & (np.minimum(left[..., 1], right[..., 1]) >= p.min_hessian)
        gain = nine_digits(np.where(fits, gain, -np.inf))
        k = int(np.argmax(gain))
        if np.isfinite(gain.flat[k]) and (best is None or gain.flat[k] > best[0]):
            f, b = divmod(k, gain.shape[1])
            best = float(gain.flat[k]), f, b + 1, to_left
    if best and best[0] > max(p.min_gain, 0.0):
        node.gain, node.feature, node.bin, node.missing_left = best


def child_sums(node: Node) -> tuple[np.ndarray, np.ndarray]:
    h = node.hist[node.feature]
    left = h[1:node.bin + 1].sum(axis=0) + (h[0] if node.missing_left else 0)
    return left, h.sum(axis=0) - left


def grow(rows: DataFrame | None, p: Params, shape: tuple[int, int], sums_of: Callable[[list[Node], list[int]], dict[int, np.ndarray]] | None = None) -> list[Node]:
    """One tree on cells of label, n, score and bins; ``sums_of`` gives the sums of wanted nodes (default: those of ``rows``)."""
    sums_of = sums_of or (lambda nodes, wanted: histograms(rows, nodes, wanted, shape, p.loss))

    def made(sums: np.ndarray, depth: int, hist: np.ndarray) -> Node:
        node = Node(depth, int(round(sums[2])), float(-sums[0] / (sums[1] + p.l2)) if sums[1] + p.l2 else 0.0, hist)
        if p.max_depth is None or depth < p.max_depth:
            best_split(node, p)
        return node
    root = sums_of([Node(0, 0, 0.0)], [0])[0]
    nodes = [made(root[0].sum(axis=0), 0, root)]
    while True:
        # best first, as far as the children are known
        heap = [(-nodes[0].gain, 0)] if nodes[0].gain else []
        for n in nodes:
            n.split, n.step = False, -1
        leaves, step, open_ = 1, 0, []
        while heap and (p.max_leaves is None or leaves < p.max_leaves):
            _, i = heapq.heappop(heap)
            if nodes[i].left < 0:
                open_ = [i, *(j for _, j in sorted(heap) if nodes[j].left < 0)]
                break
            nodes[i].split, nodes[i].step = True, step
            leaves, step = leaves + 1, step + 1
            for j in (nodes[i].left, nodes[i].right):
                if nodes[j].gain:
                    heapq.heappush(heap, (-nodes[j].gain, j))
        if not open_:
            break
        if p.max_leaves is not None:
            open_ = open_[:p.max_leaves - leaves]
        small = []
        for i in open_:
            left, right = child_sums(nodes[i])
            nodes[i].left, nodes[i].right = len(nodes), len(nodes) + 1
            nodes += [Node(nodes[i].depth + 1, 0, 0.0), Node(nodes[i].depth + 1, 0, 0.0)]
            small.append(nodes[i].left if left[2] <= right[2] else nodes[i].right)
        found = sums_of(nodes, small)
        for i, s in zip(open_, small, strict=True):
            node = nodes[i]
            other = node.right if s == node.left else node.left
            for j, hist in ((s, found[s]), (other, node.hist - found[s])):
                nodes[j] = made(hist[0].sum(axis=0), node.depth + 1, hist)
    return nodes


def _kept(nodes: list[Node]) -> list[Node]:
    """The tree without its sums and without the children of nodes that were not split."""
    return [Node(n.depth, n.n, n.value, None, *((n.feature, n.bin, n.missing_left, n.gain, n.left, n.right, True, n.step) if n.split else ())) for n in nodes]


class Held:
    """Cells in memory: the sums of nodes as ``histograms`` gives them, and scores."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, n: np.ndarray, base: float, p: Params, shape: tuple[int, int]):
        order = np.lexsort(bins.T[::-1]) if bins.shape[1] else np.arange(len(bins))  # the same sums, however Spark dealt the cells
        self.bins, self.label, self.n = np.ascontiguousarray(bins[order].T), label[order], n[order]
        self.score, self.p, self.shape = np.full(len(bins), base), p, shape

    def tree(self) -> list[Node]:
        g, h = derivatives(self.p.loss, self.score, self.label, self.n)
        whole, width = h is self.n, self.shape[1]
        rows = {0: np.arange(len(self.n))}

        def sums(of: np.ndarray) -> np.ndarray:
            out, parts = np.zeros((*self.shape, 3)), [v[of] for v in ((g, self.n) if whole else (g, h, self.n))]
            for j, b in enumerate(self.bins):
                at = b[of].astype(np.intp)
                for i, v in enumerate(parts):
                    out[j, :, 2 if i == len(parts) - 1 else i] = np.bincount(at, v, width)
            if whole:
                out[..., 1] = out[..., 2]
            return out

        def sums_of(nodes: list[Node], wanted: list[int]) -> dict[int, np.ndarray]:
            for i, n in enumerate(nodes):
                if n.left >= 0 and n.left not in rows:
                    of = rows[i]
                    b = self.bins[n.feature][of]
                    left = (b <= n.bin) & ((b > 0) | n.missing_left)
                    rows[n.left], rows[n.right] = of[left], of[~left]
                    rows[i] = of[:0]  # its children hold them now
            return {i: sums(rows[i]) for i in wanted}
        nodes = grow(None, self.p, self.shape, sums_of)
        leaf = np.zeros(len(nodes), np.int64)  # the leaf that the rows of each node came to

        def walk(i: int, to: int | None) -> None:
            to = i if to is None and not nodes[i].split else to
            leaf[i] = i if to is None else to
            for j in (nodes[i].left, nodes[i].right):
                if j >= 0:
                    walk(j, to)
        walk(0, None)
        value = np.array([self.p.rate * n.value for n in nodes])
        for i, of in rows.items():
            self.score[of] += value[leaf[i]]
        return _kept(nodes)


def _fit_held(rows: DataFrame, base: float, p: Params, shape: tuple[int, int]) -> list[list[Node]]:
    """All trees of a model, grown by one task from the cells."""
    names = ["depth", "n", "value", "feature", "bin", "missing_left", "gain", "left", "right", "split", "step"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("bins").flatten().to_numpy().reshape(len(b), -1), b.column("label").to_numpy(), b.column("n").to_numpy()) for b in batches if len(b)]
        bins, label, n = (np.concatenate(v) for v in zip(*parts, strict=True)) if parts else (np.zeros((0, shape[0]), np.int16), np.zeros(0), np.zeros(0))
        held = Held(bins, label, n.astype(np.float64), base, p, shape)
        for k in range(p.rounds):
            out = [(k, i, *(getattr(node, c) for c in names)) for i, node in enumerate(held.tree())]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["tree", "node", *names]), schema=types, preserve_index=False)
    types = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("depth", pa.int32()), ("n", pa.int64()), ("value", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32()),
                       ("missing_left", pa.bool_()), ("gain", pa.float64()), ("left", pa.int32()), ("right", pa.int32()), ("split", pa.bool_()), ("step", pa.int32())])
    schema = "tree int, node int, depth int, n long, value double, feature int, bin int, missing_left boolean, gain double, left int, right int, split boolean, step int"
    trees: list[list[Node]] = [[] for _ in range(p.rounds)]
    for r in sorted(rows.select("bins", "label", "n").repartition(1).mapInArrow(run, schema).collect()):  # the model's nodes
        trees[r["tree"]].append(Node(r["depth"], r["n"], r["value"], None, *r[5:]))
    return trees


def fit(df: DataFrame, features: list[str], label: str, params: Params = LEAF_WISE, base: float | None = None) -> Model:
    """Boosted trees on the rows with a label; the first score is the label's mean (its log odds for ``logistic``).

    Without rows the model is the constant 0; a feature without two different values is never split.
    """
    spark = df.sparkSession
    cuts = cut_points(df, features, params.bins)
    tables = Rounds(spark, "boost")
    rows = tables.write(cells(binned(df, features, cuts, label)))
    totals = rows.agg(F.count(F.lit(1)), F.sum("label") / F.sum("n")).first()
    if base is None:
        mean = totals[1] or 0.0
        base = mean if params.loss == "squared" else math.log(max(mean, 1e-9) / max(1 - mean, 1e-9)) if mean else 0.0
    model = Model(list(features), cuts, float(base), params)
    shape = (len(features), max((len(c) for c in cuts), default=0) + 2)
    rounds = params.rounds if features else 0
    if rounds and totals[0] * (len(features) + 12) <= HELD:
        model.trees = _fit_held(rows, model.base, params, shape)
        rounds = 0
    rows = rows.withColumn("score", F.lit(model.base))
    for k in range(rounds):
        model.trees.append(_kept(grow(rows, params, shape)))
        if k + 1 < rounds:
            rows = tables.write(rescored(rows, model.trees[-1], params.rate))
    tables.drop()
    return model


def predict(model: Model, df: DataFrame, output: str = "prediction") -> DataFrame:
    """The rows with the model's prediction (a probability for ``logistic``)."""
    @F.pandas_udf("double")
    def scored(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns]) if columns else np.zeros((0, 0))
        s = model.score(x)
        return pd.Series(1 / (1 + np.exp(-s)) if model.params.loss == "logistic" else s)
    if not model.features:
        return df.withColumn(output, F.lit(model.base))
    return df.withColumn(output, scored(*[F.col(f).cast("double") for f in model.features]))


def tree_table(spark, model: Model, tree: int = 0) -> DataFrame:
    """The splits of a tree in the order they were made, and its leaves.

    node (1 for the root, children 2i and 2i + 1, as text), step, feature, cut, gain (NULL for leaves), n, value (of leaves).
    """
    out = []

    def walk(i: int, name: int) -> None:
        n = model.trees[tree][i]
        if n.split:
            cut = float(model.cuts[n.feature][n.bin - 1]) if n.bin <= len(model.cuts[n.feature]) else None
            out.append((str(name), n.step, model.features[n.feature], cut, n.gain, n.n, None))
            walk(n.left, 2 * name)
            walk(n.right, 2 * name + 1)
        else:
            out.append((str(name), None, None, None, None, n.n, n.value))
    walk(0, 1)
    return spark.createDataFrame(out, "node string, step int, feature string, cut double, gain double, n long, value double")
