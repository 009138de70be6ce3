"""Hard negatives by a multiway hyperplane tree with distance ranges (GNAT).

Every node of the tree has up to ``FANOUT`` split points; a vector belongs to the child of its nearest one.  For each
split point and each child the node stores the least and largest distance from that point to the vectors of that
child's subtree.  A search looks for rows whose integer inner product with an anchor lies in a window [lo, hi].  With
``|x - q|^2 = |x|^2 + |q|^2 - 2 x.q`` and the child's range of ``|x|^2``, the window is an annulus around the anchor, and
the triangle inequality gives bounds ``max(lo_ij - D_i, D_i - hi_ij) <= d(q, x) <= D_i + hi_ij`` from each split point
i.  A child whose bounds miss the annulus for one split point is out.  Leaves are exact: products of anchors and whole
leaves.

1. The split points come from at most ``SAMPLE`` rows (those of smallest hash).  Every row is put into its leaf by
   the tree; the ranges are aggregated over all rows.  Leaves are packed into chunks in a sorted stream, so a leaf of
   any size (equal vectors cannot be told apart) is many chunks, and chunks meet the anchors by the skew join rule.
2. Positives: each anchor's own leaf gives a first bound of its last positive's score; all leaves that can hold a
   better one are then searched.
3. Negatives: the positives' scores make the windows; all leaves whose annuli they meet are searched.

Chunks report the first few rows of a window only, and a ranked window (which cuts before the shuffle) picks the first
of all.  The tree (``SAMPLE`` bounds it) goes to the tasks as a closure; anchors never do, they are shuffled to the
leaves that they must visit.

Scores are exact: float products are used only where the largest squared norm keeps them so (2**24 and 2**53), else
64-bit integers.  Defined cases: a row with a NULL label, a NULL vector or a NULL component takes no part; shorter
vectors are filled up with zeros; rows that repeat an id are rows of their own, so a repeated anchor is answered once for
each row; a NULL id comes last among ties and is no anchor; ties are broken by id, then by row; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bound_batches, partitions

SAMPLE, FANOUT, LEAF_SAMPLE = 8192, 16, 128
CHUNK_ROWS, CHUNK_VALUES, BLOCK = 1024, 1 << 18, 128
#: Anchors that one task sorts and packs.
ANCHORS_A_TASK = 4096
#: Stands for a NULL id inside the search; sorts behind every id.
NO_ID = (1 << 63) - 1
#: Of squared distances: more than their rounding.
SLACK = 1e-6
FOUND = "row long, window int, score long, other long, other_row long"


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of a and b."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T), 0)


class Node:
    def __init__(self, points: np.ndarray):
        self.points = points
        self.children: list[Node | int] = []
        m = len(points)
        #: by split point and child; norms by child
        self.low, self.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        self.norm_low, self.norm_high = np.full(m, np.inf), np.full(m, -np.inf)


def split_points(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Far apart vectors among three times as many drawn ones; fewer, where fewer differ."""
    drawn = x[rng.permutation(len(x))[:3 * FANOUT]]
    chosen = [0]
    near = squared(drawn, drawn[:1])[:, 0]
    while len(chosen) < FANOUT and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(drawn, drawn[chosen[-1]:chosen[-1] + 1])[:, 0])
    return drawn[chosen]


class Tree:
    def __init__(self, sample: np.ndarray):
        self.nodes: list[Node] = []
        #: (node, child) from the root to each leaf
        self.paths: list[list[tuple[int, int]]] = []
        self.root = self._build(sample, [], np.random.default_rng(0))

    def _build(self, x: np.ndarray, path: list[tuple[int, int]], rng) -> int:
        """Number of the node, or -1 - number of the leaf."""
        points = split_points(x, rng) if len(x) > LEAF_SAMPLE else x[:0]
        if len(points) < 2:
            self.paths.append(path)
            return -len(self.paths)
        number = len(self.nodes)
        node = Node(points)
        self.nodes.append(node)
        at = squared(x, points).argmin(axis=1)
        node.children = [self._build(x[at == j], [*path, (number, j)], rng) for j in range(len(points))]
        return number

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            number, rows = todo.pop()
            if number < 0:
                out[rows] = -1 - number
            elif len(rows):
                node = self.nodes[number]
                at = squared(x[rows], node.points).argmin(axis=1)
                todo += [(child, rows[at == j]) for j, child in enumerate(node.children)]
        return out

    def visits(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``q``) wherever a row's window [low, high] of inner products may have a vector."""
        norm = (q.astype(np.float64) ** 2).sum(axis=1)
        todo = [(self.root, np.arange(len(q)))]
        while todo:
            number, rows = todo.pop()
            if number < 0:
                yield -1 - number, rows
                continue
            node = self.nodes[number]
            d = np.sqrt(squared(q[rows], node.points))
            slack = SLACK * (1 + norm[rows])[:, None]
            with np.errstate(invalid="ignore"):
                inner = node.norm_low + norm[rows][:, None] - 2 * high[rows][:, None] - slack - SLACK * np.abs(node.norm_low)
                outer = node.norm_high + norm[rows][:, None] - 2 * low[rows][:, None] + slack + SLACK * np.abs(node.norm_high)
            inner = np.sqrt(np.maximum(inner, 0))
            alive = (outer >= 0) & np.isfinite(node.norm_low)  # a child without rows has no range
            outer = np.sqrt(np.maximum(outer, 0))
            reach = SLACK * (1 + d)
            for i in range(len(node.points)):
                di, r = d[:, i:i + 1], reach[:, i:i + 1]
                least = np.maximum(node.low[i] - di, di - node.high[i])
                alive &= (least - r <= outer) & (di + node.high[i] + r >= inner)
            todo += [(child, rows[alive[:, j]]) for j, child in enumerate(node.children) if alive[:, j].any()]


class Format:
    """Vectors as bytes of a type in which inner products are exact."""

    def __init__(self, dim: int, norm: float):
        self.dim = dim
        self.dtype = np.dtype("<f4" if norm < 2 ** 24 else "<f8" if norm < 2 ** 53 else "<i8")

    def matrix(self, blobs) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), self.dtype).reshape(-1, self.dim) if self.dim else np.zeros((len(blobs), 0), self.dtype)

    def stack(self, vectors) -> np.ndarray:
        out = np.zeros((len(vectors), self.dim), self.dtype)
        for i, v in enumerate(vectors):
            out[i, :len(v)] = v
        return out


def build_tree(rows: DataFrame, form: Format) -> Tree:
    """Split points from the ``SAMPLE`` rows of smallest hash."""
    sample = rows.select("row", "vector").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).collect()
    return Tree(form.stack([r["vector"] for r in sample]))


def in_leaves(rows: DataFrame, tree: Tree, form: Format) -> DataFrame:
    """The rows with their leaf, the vector as bytes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = form.stack(list(batch["vector"]))
            yield batch.drop(columns="vector").assign(leaf=tree.leaf(x), vector=[v.tobytes() for v in x])
    return rows.select("row", "id", "label", "anchor", "vector").mapInPandas(run, "row long, id long, label long, anchor boolean, leaf int, vector binary")


def packed(rows: DataFrame, form: Format) -> DataFrame:
    """The leaves in chunks of rows."""
    most = max(1, min(CHUNK_ROWS, CHUNK_VALUES // max(1, form.dim)))
    columns = ["leaf", "rows", "ids", "labels", "vectors"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaf, held = None, []

        def chunk() -> tuple:
            rows, ids, labels, vectors = zip(*held, strict=True)
            return leaf, rows, ids, labels, b"".join(vectors)
        for batch in batches:
            out = []
            for f, *values in zip(batch["leaf"], batch["row"], batch["id"], batch["label"], batch["vector"], strict=True):
                if held and (f != leaf or len(held) == most):
                    out.append(chunk())
                    held = []
                leaf = f
                held.append(values)
            if out:
                yield pd.DataFrame(out, columns=columns)
        if held:
            yield pd.DataFrame([chunk()], columns=columns)
    spread = rows.select("leaf", "row", "id", "label", "vector").repartitionByRange(partitions(rows.sparkSession), "leaf", F.xxhash64("row"))
    return spread.sortWithinPartitions("leaf").mapInPandas(run, "leaf int, rows array<long>, ids array<long>, labels array<long>, vectors binary")


def set_ranges(tree: Tree, chunks: DataFrame, form: Format) -> None:
    """Distance and norm ranges over all rows, one aggregate a (node, split point, child)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for leaf, blob in zip(batch["leaf"], batch["vectors"], strict=True):
                x = form.matrix([blob])
                norm = (x.astype(np.float64) ** 2).sum(axis=1)
                out = []
                for number, child in tree.paths[leaf]:
                    d = np.sqrt(squared(tree.nodes[number].points, x))
                    out += [(number, i, child, lo, hi, norm.min(), norm.max()) for i, (lo, hi) in enumerate(zip(d.min(axis=1), d.max(axis=1), strict=True))]
                if out:
                    yield pd.DataFrame(out, columns=["node", "point", "child", "low", "high", "norm_low", "norm_high"])
    schema = "node int, point int, child int, low double, high double, norm_low double, norm_high double"
    ranges = chunks.select("leaf", "vectors").mapInPandas(run, schema).groupBy("node", "point", "child").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("norm_low").alias("norm_low"), F.max("norm_high").alias("norm_high"))
    for r in ranges.collect():  # at most FANOUT ** 2 rows a node
        node = tree.nodes[r["node"]]
        node.low[r["point"], r["child"]], node.high[r["point"], r["child"]] = r["low"], r["high"]
        node.norm_low[r["child"]], node.norm_high[r["child"]] = r["norm_low"], r["norm_high"]


def to_leaves(anchors: DataFrame, n_anchors: int, tree: Tree, form: Format, own: bool) -> DataFrame:
    """Blocks of anchors for each leaf that they must visit; ``own``: only the leaf that an anchor lies in.

    ``anchors`` have row, label, leaf, vector and windows lows, highs (NULL: open).
    """
    columns = ["leaf", "q_rows", "q_labels", "q_vectors", "q_lows", "q_highs"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                g = batch.iloc[at:at + BLOCK]
                q = form.matrix(list(g["vector"]))
                lows, highs = list(g["lows"]), list(g["highs"])
                if own:
                    leaves = g["leaf"].to_numpy()
                    visits = [(leaf, np.flatnonzero(leaves == leaf)) for leaf in np.unique(leaves)]
                else:
                    low = np.array([-np.inf if v is None else min(v) for v in lows], np.float64)
                    high = np.array([np.inf if v is None else max(v) for v in highs], np.float64)
                    visits = tree.visits(q, low, high)
                rows, labels = g["row"].to_numpy(), g["label"].to_numpy()
                yield pd.DataFrame([(leaf, rows[k], labels[k], q[k].tobytes(), [lows[i] for i in k], [highs[i] for i in k]) for leaf, k in visits],
                                   columns=columns)
    near = anchors.select("row", "label", "leaf", "vector", "lows", "highs").coalesce(-(-n_anchors // ANCHORS_A_TASK)).sortWithinPartitions("leaf")
    return near.mapInPandas(run, "leaf int, q_rows array<long>, q_labels array<long>, q_vectors binary, q_lows array<array<long>>, q_highs array<array<long>>")


def first_of(anchor: np.ndarray, most: int) -> np.ndarray:
    """Of sorted anchor numbers: whether an entry is among the first ``most`` of its anchor."""
    begins = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return np.arange(len(anchor)) - np.repeat(begins, np.diff(np.r_[begins, len(anchor)])) < most


def search(visits: DataFrame, chunks: DataFrame, form: Format, same: bool, most: int) -> DataFrame:
    """The first ``most`` rows of each anchor's windows, with the anchor's label (``same``) or another one: FOUND and rank.

    Rows come by score, highest first, then id and row; the anchor's own row is none of them.
    """
    def one(c) -> Iterator[pd.DataFrame]:
        q, x = form.matrix([c.q_vectors]), form.matrix([c.vectors])
        ids, rows, labels = np.asarray(c.ids), np.asarray(c.rows), np.asarray(c.labels)
        q_rows, q_labels = np.asarray(c.q_rows), np.asarray(c.q_labels)
        scores = (q @ x.T).astype(np.int64)
        info = np.iinfo(np.int64)
        width = max((len(v) for v in c.q_lows if v is not None), default=1)
        lows, highs = np.full((len(q), width), info.max), np.full((len(q), width), info.min)  # no window: empty
        for k, (lo, hi) in enumerate(zip(c.q_lows, c.q_highs, strict=True)):
            lows[k, :1 if lo is None else len(lo)] = info.min if lo is None else lo
            highs[k, :1 if hi is None else len(hi)] = info.max if hi is None else hi
        fits = (q_labels[:, None] == labels) == same
        fits &= (scores >= lows.min(axis=1)[:, None]) & (scores <= highs.max(axis=1)[:, None]) & (q_rows[:, None] != rows)
        a, b = np.nonzero(fits)
        s = scores[a, b]
        order = np.lexsort((rows[b], ids[b], -s, a))
        a, b, s = a[order], b[order], s[order]
        for w in range(width):
            k = np.flatnonzero((s >= lows[a, w]) & (s <= highs[a, w]))
            k = k[first_of(a[k], most)] if len(k) else k
            if len(k):
                yield pd.DataFrame({"row": q_rows[a[k]], "window": np.full(len(k), w, np.int32), "score": s[k], "other": ids[b[k]], "other_row": rows[b[k]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for c in batch.itertuples(index=False):
                yield from one(c)
    # both sides grow with the data and Spark can't foresee what a Python stage returns: never a broadcast
    found = visits.hint("merge").join(chunks, "leaf").drop("leaf").mapInPandas(run, FOUND)
    ranked = Window.partitionBy("row", "window").orderBy(F.col("score").desc(), "other", "other_row")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= most)


def floor_div(a: Column, b: int) -> Column:
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def mine_hard_negatives(rows: DataFrame, anchor: Column, n_positives: int = 5, n_negatives: int = 5,
                        low_percent: int = 80, high_percent: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: id, label (long), vector (array<long>); ``anchor`` marks the anchors.  An anchor's positives are the
    first ``n_positives`` rows of its label; a positive's negatives are the first ``n_negatives`` rows of other labels
    with ``low_percent * positive_score <= 100 * negative_score <= high_percent * positive_score``.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "hardneg")
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull()))
    rows = scratch.table("rows", rows.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("id"), F.lit(NO_ID)).alias("id"), F.col("label").cast("long").alias("label"),
        (F.col("id").isNotNull() & F.coalesce(anchor, F.lit(False))).alias("anchor"), "vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    about = rows.agg(F.max(F.size("vector")).alias("dim"), F.max(norm).alias("norm"), F.count_if("anchor").alias("anchors")).first()
    form = Format(about["dim"] or 0, about["norm"] or 0.0)
    tree = build_tree(rows, form)
    placed = scratch.table("placed", in_leaves(rows, tree, form))
    scratch.drop("rows")
    chunks = scratch.table("chunks", packed(placed, form))
    set_ranges(tree, chunks, form)
    anchors = scratch.table("anchors", placed.where("anchor").drop("anchor"))
    scratch.drop("placed")
    n = max(1, about["anchors"])

    open_ = F.lit(None).cast("array<long>")
    own = to_leaves(anchors.select("*", open_.alias("lows"), open_.alias("highs")), n, tree, form, own=True)
    bound = search(own, chunks, form, True, n_positives).where(F.col("rank") == n_positives).select("row", F.array("score").alias("lows"))
    bounded = scratch.table("bounded", anchors.join(bound, "row", "left").withColumn("highs", open_))
    positives = scratch.table("positives", search(to_leaves(bounded, n, tree, form, own=False), chunks, form, True, n_positives))

    lo, hi = -floor_div(-F.col("score") * low_percent, 100), floor_div(F.col("score") * high_percent, 100)
    windows = positives.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", lo.alias("lo"), hi.alias("hi")))).alias("w"))  # n_positives entries
    windowed = scratch.table("windowed", anchors.join(windows.select("row", F.col("w.lo").alias("lows"), F.col("w.hi").alias("highs")), "row"))
    negatives = search(to_leaves(windowed, n, tree, form, own=False), chunks, form, False, n_negatives)

    def id_(c: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c))
    p = positives.select("row", (F.col("rank") - 1).alias("window"), id_("other").alias("positive_id"), F.col("score").alias("positive_score"))
    out = negatives.select("row", "window", "rank", id_("other").alias("negative_id"), F.col("score").alias("negative_score"))
    return (out.join(p, ["row", "window"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
