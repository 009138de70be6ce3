"""Random forests without a depth limit.

Every tree sees the rows with Poisson(1) weights drawn by hash (``stats/bootstrap.py``).  Rows of equal features (and class)
that one task reads together go on as one cell: no split tells them apart, and a cell keeps the sums and bounds of its
labels.  Where equal rows are many, the rows are dealt by their features, each into a few parts.  Nodes of more than
``group_rows`` cells are split by Spark: each task adds up the sums by (node, feature, bin) of the nodes in question, at
the table's quantiles, or at the node's own where those hold no split.  Once a node is within ``group_rows`` its cells go to
one task as a group of that known size and are split there, value by value, until a leaf holds one label or equal
features, however deep that is.  A large node whose features are all equal is a leaf.

The split sought is that of the largest ``|SL|^2 / WL + |SR|^2 / WR`` (sums of label and weight on either side): with the
label as number that is the variance criterion, with the classes as unit vectors the Gini criterion.  Of the features a
random part is tried first, the others only where those hold no split.

The upper levels, at most some 2 n / ``group_rows`` nodes a tree, are the driver's part of the model.  The finished
subtrees, most of the model, stay a written table with a row a subtree.  For scoring either groups of subtrees go to
blocks of rows, or rows go to their subtrees by key, salted so that no task gets more than ``group_rows`` of them:
whichever moves fewer bytes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..persist import materialize
from ..stats.bootstrap import PRIME, constants, thresholds

#: Cells of a group, and numbers in the features of one.
GROUP_ROWS, GROUP_VALUES = 250_000, 1 << 23
#: Candidate cuts of a feature in a large node, and sums of such nodes that a task holds at a time.
BINS, HELD = 1024, 1 << 22
#: Numbers that a task reads as one block, and parts that equal rows are dealt into.
BLOCK_VALUES, PARTS = 1 << 21, 4
#: Tasks that groups are dealt over.
MOST_TASKS = 1000
#: Values ranked together when a level of a group is split.
TOGETHER = 1 << 17
#: Numbers in a block of rows to be scored, bytes of the subtrees that meet it at a time, and blocks of a table that allows so many.
SCORED_VALUES, SUBTREE_BYTES, BLOCKS = 1 << 22, 1 << 25, 16
#: Rows times trees that one task sends to their nodes: a small file is one partition, whatever the number of trees.
ROUTED_ROWS = 200_000
SUBTREE = "tree int, node int, feature array<int>, cut array<double>, left array<int>, right array<int>, value array<array<double>>, gain array<double>, cover array<double>"
SUBTREE_COLUMNS = [c.split()[0] for c in SUBTREE.split(", ")]


@dataclass
class Top:
    """Upper levels of one tree; node 0 is the root.  A node without children is a group, or a leaf if it has a value."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [None])
    rows: list[int] = field(default_factory=lambda: [0])
    cover: list[float] = field(default_factory=lambda: [0.0])     # weight of the rows; the root's once it is split
    gain: dict[int, float] = field(default_factory=dict)

    def add(self, rows: int, cover: float = 0.0) -> int:
        for column, v in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.value, None), (self.rows, rows),
                          (self.cover, cover)):
            column.append(v)
        return len(self.feature) - 1

    def open(self, most: int) -> list[int]:
        return [i for i in range(len(self.feature)) if self.left[i] < 0 and self.value[i] is None and self.rows[i] > most]


def descend(feature, cut, left, right, x: np.ndarray) -> np.ndarray:
    """The last node of each row; a missing value goes right."""
    at = np.zeros(len(x), np.int64)
    feature, cut, left, right = (np.asarray(v) for v in (feature, cut, left, right))
    going = np.flatnonzero(left[at] >= 0)
    while len(going):
        node = at[going]
        at[going] = np.where(x[going, feature[node]] <= cut[node], left[node], right[node])
        going = going[left[at[going]] >= 0]
    return at


def side_scores(s: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Score of a cut after each entry, from the entries' sums ``s`` (n x classes) and weights."""
    ls, lw = np.cumsum(s, axis=0), np.cumsum(w)
    rs, rw = ls[-1] - ls, lw[-1] - lw
    with np.errstate(divide="ignore", invalid="ignore"):
        return (ls * ls).sum(axis=1) / lw + (rs * rs).sum(axis=1) / rw


def _bits(n: int) -> int:
    return max(1, int(n).bit_length())


def _cuts(rank: np.ndarray, seg: np.ndarray, n: int, w: np.ndarray, label: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best score (-inf: no cut) of one feature in each of n nodes, and the entries before and after its cut.

    ``seg`` is the node of each entry, ``rank`` its value's (a missing value's is the last); ``label`` is the label times
    weight, or, of type int, the class; ``total`` are the nodes' sums of it (nodes x classes).
    """
    m = len(rank)
    low, high = _bits(m), _bits(int(rank.max()) + 1)
    places = np.arange(m)
    if low + high + _bits(n) < 63:  # node, value and place in one number
        key = np.sort((seg << (high + low)) | (rank << low) | places)
        order, v = key & ((1 << low) - 1), key >> low
        g = v >> high
    else:
        order = np.lexsort((rank, seg))
        g = seg[order]
        v = (g << high) | rank[order]
    first = np.searchsorted(g, np.arange(n))
    best, before, after = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
    ends = np.flatnonzero((v[:-1] != v[1:]) & (g[:-1] == g[1:]))
    if not len(ends):
        return best, before, after
    of = g[ends]

    def left_of(values: np.ndarray) -> np.ndarray:
        c = np.cumsum(values)
        return c[ends] - np.where(first > 0, c[first - 1], 0.0)[of]
    weight = w[order]
    lw = left_of(weight)
    if label.dtype.kind == "i":
        # an entry of weight u in a class that has L so far adds u (2 L + u) to the sum of squares
        classes = total.shape[1]
        own = g * classes + label[order]
        key = np.sort((own << low) | places) if low + _bits(n * classes) < 63 else None
        at = key & ((1 << low) - 1) if key is not None else np.argsort(own, kind="stable")
        by, u = own[at], weight[at]
        c = np.cumsum(u) - u
        start = np.flatnonzero(np.append(True, by[1:] != by[:-1]))
        so_far = np.empty(m)
        so_far[at] = c - np.repeat(c[start], np.diff(np.append(start, m)))
        ll = left_of(weight * (2 * so_far + weight))
        rr = (total * total).sum(axis=1)[of] - 2 * left_of(weight * total.ravel()[own]) + ll
        rw = total.sum(axis=1)[of] - lw
    else:
        left = left_of(label[order])
        c = np.cumsum(weight)
        last = np.append(first[1:], m) - 1
        rw = (c[last] - np.where(first > 0, c[first - 1], 0.0))[of] - lw
        c = np.cumsum(label[order])
        ll, rr = left * left, (c[last][of] - c[ends]) ** 2
    score = ll / lw + rr / rw
    start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    most = np.maximum.reduceat(score, start)
    at = np.flatnonzero(score == np.repeat(most, np.diff(np.append(start, len(of)))))
    nodes, where = np.unique(of[at], return_index=True)  # the first of equal scores
    i = ends[at[where]]
    best[nodes], before[nodes], after[nodes] = most, order[i], order[i + 1]
    return best, before, after


def grow_exact(x: np.ndarray, s: np.ndarray, w: np.ndarray, tried: int, rng: np.random.Generator, mixed: np.ndarray | None = None, classes: int = 0) -> dict:
    """A tree on the cells of one group, split until leaves are pure; ``s`` are label sums (label times weight).

    ``mixed``: cells whose rows have several labels; ``classes``: with this number, ``s`` are the classes instead.
    Grown level by level, all open nodes of a level at once: a node tries its features in its own random order.
    """
    k, m = x.shape[1], len(x)
    codes = s.reshape(-1).astype(np.int64) if classes else s[:, 0]
    label = codes if classes else codes / w
    several = np.zeros(m, bool) if mixed is None else mixed
    ranks = np.empty((m, k), np.int32)  # a missing value last
    for j in range(k):
        ranks[:, j] = np.unique(x[:, j], return_inverse=True)[1]
    width = classes or 1

    def sums(seg: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        if classes:
            return np.bincount(seg * classes + codes[of], w[of], n * classes).reshape(n, classes)
        return np.bincount(seg, codes[of], n)[:, None]
    gains = np.zeros(k)
    feature, cut, left, right = (np.full(2 * m + 1, v) for v in (-1, 0.0, -1, -1))
    value, cover = np.zeros((2 * m + 1, width)), np.zeros(2 * m + 1)
    cover[0] = w.sum()
    value[0] = sums(np.zeros(m, np.int64), np.arange(m), 1)[0] / cover[0]
    size = 1
    rows, seg, nodes = np.arange(m), np.zeros(m, np.int64), np.zeros(1, np.int64)  # open rows, by place in nodes
    while len(nodes):
        first = np.searchsorted(seg, np.arange(len(nodes)))
        other = (label[rows] != label[rows[first]][seg]) | several[rows]
        impure = np.bincount(seg, other, len(nodes)) > 0
        keep = impure[seg]
        rows, seg, nodes = rows[keep], (np.cumsum(impure) - 1)[seg[keep]], nodes[impure]
        n = len(nodes)
        if not n:
            break
        total = sums(seg, rows, n)
        order = rng.permuted(np.tile(np.arange(k), (n, 1)), axis=1)
        best, best_cut, best_f = np.full(n, -np.inf), np.zeros(n), np.full(n, -1)
        rank = 0
        while rank < k:
            wanted = best_f < 0 if rank >= tried else np.ones(n, bool)
            if not wanted.any():
                break
            which = np.flatnonzero(wanted)
            chosen = wanted[seg]
            r, g = rows[chosen], (np.cumsum(wanted) - 1)[seg[chosen]]
            # the features tried anyway are ranked together, as many as fit
            step = min(tried - rank, max(1, TOGETHER // len(r))) if rank < tried else 1
            f = order[wanted, rank:rank + step]
            entries = np.tile(r, step)
            at = (g[None, :] + len(which) * np.arange(step)[:, None]).ravel()
            of = f.T.ravel()
            found, before, after = _cuts(ranks[entries, of[at]].astype(np.int64), at, step * len(which), w[entries], codes[entries], np.tile(total[wanted], (step, 1)))
            ok = np.isfinite(found)
            a, b = x[entries[before], of], x[entries[after], of]
            with np.errstate(invalid="ignore"):
                middle = a + (b - a) / 2
            between = np.where(np.isnan(b) | ~(middle < b), a, middle)  # a missing value compares false: it stays right
            for i in range(step):
                part = slice(i * len(which), (i + 1) * len(which))
                better = ok[part] & (found[part] > best[which])
                best[which[better]], best_cut[which[better]], best_f[which[better]] = found[part][better], between[part][better], of[part][better]
            rank += step
        splits = best_f >= 0
        keep = splits[seg]
        rows, seg = rows[keep], (np.cumsum(splits) - 1)[seg[keep]]
        nodes, best, best_cut, best_f, total = nodes[splits], best[splits], best_cut[splits], best_f[splits], total[splits]
        n = len(nodes)
        if not n:
            break
        weight = np.bincount(seg, w[rows], n)
        np.add.at(gains, best_f, best - (total * total).sum(axis=1) / weight)
        feature[nodes], cut[nodes] = best_f, best_cut
        left[nodes], right[nodes] = size + 2 * np.arange(n), size + 2 * np.arange(n) + 1
        child = 2 * seg + ~(x[rows, best_f[seg]] <= best_cut[seg])
        cover[size:size + 2 * n] = np.bincount(child, w[rows], 2 * n)
        value[size:size + 2 * n] = sums(child, rows, 2 * n) / cover[size:size + 2 * n, None]
        by = np.argsort(child, kind="stable")
        rows, seg, nodes = rows[by], child[by], size + np.arange(2 * n)
        size += 2 * n
    return {"feature": feature[:size], "cut": cut[:size], "left": left[:size], "right": right[:size],
            "value": value[:size], "gain": gains, "cover": cover[:size]}


@dataclass
class Forest:
    features: list[str]
    classes: list | None          # None: a number is predicted
    tops: list[Top]
    subtrees: DataFrame
    group_rows: int

    def importances(self) -> list[float]:
        """Each tree's shares of the gain by feature, averaged over the trees that split."""
        k = len(self.features)
        own = {r["tree"]: np.array([r[f"g{j}"] or 0.0 for j in range(k)]) for r in self.subtrees.groupBy("tree").agg(
            *[F.sum(F.col("gain")[j]).alias(f"g{j}") for j in range(k)]).collect()}  # a row a tree
        for t, top in enumerate(self.tops):
            for f, g in top.gain.items():
                own.setdefault(t, np.zeros(k))[f] += g
        shares = [g / g.sum() for g in own.values() if g.sum() > 0]
        return (np.mean(shares, axis=0) if shares else np.zeros(k)).tolist()


def _dealt(rows: DataFrame, n: int, trees: int, alike: list[str] | None = None) -> DataFrame:
    """The rows, written in partitions of at most some ROUTED_ROWS rows times trees; those equal in ``alike`` beside each other."""
    parts = max(1, math.ceil(n * trees / ROUTED_ROWS))
    if not alike:
        return materialize(rows.repartition(parts), repartition=False)
    parts = min(parts, max(64, math.ceil(n * len(alike) / BLOCK_VALUES)))
    by = [*alike, F.pmod(F.col("row"), F.lit(PARTS))]
    return materialize(rows.repartition(parts, *by).sortWithinPartitions(*alike, "row"), repartition=False)


def _pack(v: np.ndarray) -> bytes:
    """Numbers as bytes, by the first of a few types that holds them all."""
    for kind in (np.uint8, np.int16, np.float32):
        with np.errstate(invalid="ignore", over="ignore"):
            small = v.astype(kind)
        if np.array_equal(small, v, equal_nan=True):
            return np.dtype(kind).char.encode() + small.tobytes()
    return b"d" + v.astype(np.float64).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.dtype(chr(b[0])), offset=1).astype(np.float64)


def _same(a: np.ndarray) -> np.ndarray:
    """Whether each row but the first equals the one before."""
    return ((a[1:] == a[:-1]) | (np.isnan(a[1:]) & np.isnan(a[:-1]))).all(axis=1)


@dataclass
class Cells:
    """Of cells: features, weight, sum of label times weight, least and largest label (all the class, where there are classes)."""
    x: np.ndarray
    w: np.ndarray
    s: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    def where(self, keep: np.ndarray) -> Cells:
        return Cells(self.x[keep], self.w[keep], self.s[keep], self.lo[keep], self.hi[keep])

    def packed(self) -> tuple:
        # cells of one label need not send it three times
        more = () if (self.lo == self.hi).all() else (self.s, self.hi)
        return tuple(map(_pack, (self.x.ravel(), self.w, self.lo))) + (tuple(map(_pack, more)) or (b"", b""))


def _unpacked(records: pd.DataFrame, k: int, classes: int) -> Cells:
    """The cells of the records, with those of equal features (and class) as one."""
    parts = []
    for x, w, lo, s, hi in records[["x", "w", "lo", "s", "hi"]].itertuples(index=False):
        w, lo = _unpack(w), _unpack(lo)
        parts.append(Cells(_unpack(x).reshape(-1, k), w, _unpack(s) if s else lo if classes else lo * w, lo, _unpack(hi) if hi else lo))
    all_ = Cells(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("x", "w", "s", "lo", "hi")))
    if len(parts) == 1:
        return all_
    number = np.zeros(len(all_.w), np.int64)
    for column in [*all_.x.T, *([all_.lo] if classes else [])]:
        u, r = np.unique(column, return_inverse=True)
        number = number * len(u) + r
        u, number = np.unique(number, return_inverse=True)
        if len(u) == len(number):
            return all_
    order = np.argsort(number, kind="stable")
    start = np.flatnonzero(np.append(True, np.diff(number[order]) > 0))
    return _summed(all_.where(order), start, classes)


def _summed(c: Cells, start: np.ndarray, classes: int) -> Cells:
    lo = np.minimum.reduceat(c.lo, start)
    return Cells(c.x[start], np.add.reduceat(c.w, start), lo if classes else np.add.reduceat(c.s, start), lo, np.maximum.reduceat(c.hi, start))


def _blocks(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size * k >= BLOCK_VALUES:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if size:
        yield pd.concat(held, ignore_index=True)


def _drawn(k: int, classes: int, trees: list[int], seed: int | None) -> Callable[[Iterator[pd.DataFrame]], Iterator[tuple[int, np.ndarray, Iterator[tuple[int, Cells, np.ndarray]]]]]:
    """Of each block of rows: its first row, the features of its cells, and by tree the cells of weight and their numbers."""
    a, b = constants(max(trees) + 1, seed or 0)
    limits = np.array(thresholds(), np.int64)

    def run(batches: Iterator[pd.DataFrame]):
        for block in _blocks(batches, k):
            x = block[[f"f{j}" for j in range(k)]].to_numpy(np.float64, na_value=np.nan)
            y, key = block["y"].to_numpy(np.float64), block["k"].to_numpy(np.int64)
            if classes:  # equal rows of one class are one cell
                order = np.argsort(y, kind="stable") if len(x) > 1 and _same(x).any() else None
                if order is not None:
                    number = np.append(0, np.cumsum(~_same(x)))
                    order = np.lexsort((y, number))
                    x, y, key = x[order], y[order], key[order]
            new = np.append(True, ~(_same(x) & ((y[1:] == y[:-1]) if classes else True))) if len(x) else np.zeros(0, bool)
            start = np.flatnonzero(new)
            alone = len(start) == len(x)
            own = x if alone else x[start]

            def by_tree():
                for t in trees:
                    w = (np.ones(len(x)) if seed is None else np.searchsorted(limits, (key * a[t] + b[t]) % PRIME, side="right").astype(np.float64))
                    if alone:
                        at = np.flatnonzero(w > 0)
                        yield t, Cells(x[at], w[at], y[at] if classes else y[at] * w[at], y[at], y[at]), at
                        continue
                    weight = np.add.reduceat(w, start)
                    at = np.flatnonzero(weight > 0)
                    lo = np.minimum.reduceat(np.where(w > 0, y, np.inf), start)[at]
                    hi = lo if classes else np.maximum.reduceat(np.where(w > 0, y, -np.inf), start)[at]
                    yield t, Cells(own[at], weight[at], lo if classes else np.add.reduceat(w * y, start)[at], lo, hi), at
            yield int(block["row"].iloc[0]), own, by_tree()
    return run


def _routed(rows: DataFrame, k: int, classes: int, tops: list[Top], wanted: dict[int, list[int]], seed: int | None) -> DataFrame:
    """The packed cells of each block of rows in the wanted nodes of each tree."""
    drawn = _drawn(k, classes, sorted(wanted), seed)
    names = ["tree", "node", "block", "x", "w", "lo", "s", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for first, _, by_tree in drawn(batches):
            for t, cells, _ in by_tree:
                top = tops[t]
                node = descend(top.feature, top.cut, top.left, top.right, cells.x)
                out = []
                order = np.argsort(node, kind="stable")
                at, start = np.unique(node[order], return_index=True)
                for i, part in zip(at.tolist(), np.split(order, start[1:])):
                    if i in wanted[t]:
                        out.append((t, i, first, *cells.where(part).packed()))
                if out:
                    yield pd.DataFrame(out, columns=names)
    return rows.mapInPandas(run, "tree int, node int, block long, x binary, w binary, lo binary, s binary, hi binary")


def _own_cuts(rows: DataFrame, k: int, classes: int, tops: list[Top], wanted: dict[int, list[int]], seed: int | None) -> dict:
    """Quantiles of each wanted node's own cells as candidate cuts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                x = _unpack(r.x).reshape(-1, k)
                yield pd.DataFrame({"tree": np.int32(r.tree), "node": np.int32(r.node), **{f"f{j}": x[:, j] for j in range(k)}})
    at = _routed(rows, k, classes, tops, wanted, seed).mapInPandas(run, "tree int, node int, " + ", ".join(f"f{j} double" for j in range(k)))
    return {(r["tree"], r["node"]): _cut_lists(r, k) for r in at.groupBy("tree", "node").agg(*_quantiles(k)).collect()}  # nodes x features x BINS


def _quantiles(k: int) -> list:
    known = [F.when(~F.isnan(f"f{j}"), F.col(f"f{j}")) for j in range(k)]
    share = [i / BINS for i in range(1, BINS)]
    return [c for j, v in enumerate(known) for c in (F.percentile_approx(v, share, 4 * BINS).alias(f"q{j}"), F.max(v).alias(f"m{j}"), F.max(v.isNull()).alias(f"e{j}"))]


def _cut_lists(r, k: int) -> list[np.ndarray]:
    """Below the largest value, or up to it where missing values come after."""
    return [np.array(sorted({v for v in r[f"q{j}"] or [] if v < r[f"m{j}"]} | ({r[f"m{j}"]} if r[f"e{j}"] and r[f"m{j}"] is not None else set()))) for j in range(k)]


def _bins(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(x), len(cuts), np.searchsorted(cuts, x, side="left"))


def _histograms(rows: DataFrame, k: int, classes: int, tops: list[Top], seed: int | None, jobs: list[tuple], cuts: list[np.ndarray]) -> list[np.ndarray]:
    """Of each job (tree, node, features, own cuts or None): number of cells, weight and label sums by (feature, bin)."""
    width, columns = max(map(len, [c for *_, own in jobs for c in own or cuts]), default=0) + 1, 2 + (classes or 1)
    most = max(len(f) for _, _, f, _ in jobs)
    size = most * width
    by_tree: dict[int, list[int]] = {}
    for i, (t, *_) in enumerate(jobs):
        by_tree.setdefault(t, []).append(i)
    drawn = _drawn(k, classes, sorted(by_tree), seed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((columns, len(jobs) * size))
        for _, own, trees in drawn(batches):
            bins = np.column_stack([_bins(own[:, j], c) for j, c in enumerate(cuts)])
            for t, cells, number in trees:
                top, here = tops[t], by_tree[t]
                slot = np.full(len(top.feature), -1)
                slot[[jobs[i][1] for i in here]] = np.arange(len(here))
                at = slot[descend(top.feature, top.cut, top.left, top.right, cells.x)]
                keep = np.flatnonzero(at >= 0)
                c, at, b = cells.where(keep), at[keep], bins[number[keep]]
                for i, own_cuts in ((i, jobs[j][3]) for i, j in enumerate(here) if jobs[j][3]):
                    these = at == i
                    b[these] = np.column_stack([_bins(c.x[these, j], v) for j, v in enumerate(own_cuts)])
                features = np.array([[*jobs[i][2], *[-1] * (most - len(jobs[i][2]))] for i in here])
                low = here[0] * size  # a tree's jobs stand together
                for q in range(most):
                    f = features[at, q]
                    cell = (at * most + q) * width + b[np.arange(len(at)), f]
                    n = len(here) * size
                    values = [None, c.w, *([np.where(c.lo == v, c.w, 0.0) for v in range(classes)] if classes else [c.s])]
                    for sums, v in zip(total, values, strict=True):
                        sums[low:low + n] += np.bincount(cell, v, n)
        used = np.flatnonzero(total[0])
        yield pd.DataFrame({"cell": used, **{f"v{i}": total[i][used] for i in range(columns)}})
    names = [f"v{i}" for i in range(columns)]
    parts = rows.mapInPandas(run, "cell long, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros((len(jobs) * size, columns))
    for r in parts.groupBy("cell").agg(*[F.sum(c).alias(c) for c in names]).toLocalIterator():  # at most HELD numbers
        out[r["cell"]] = r[1:]
    return list(out.reshape(len(jobs), most, width, columns))


def _split_large(rows: DataFrame, k: int, tops: list[Top], seed: int | None, classes: int, tried: int, most: int, cuts: list[np.ndarray]) -> bool:
    """One level of the nodes with more than ``most`` cells; False when there are none."""
    wanted = [(t, i) for t, top in enumerate(tops) for i in top.open(most)]
    if not wanted:
        return False
    order = {(t, i): np.random.default_rng([seed or 0, t, i]).permutation(k).tolist() for t, i in wanted}
    own: dict = {}

    def attempt(nodes: list[tuple[int, int]], low: int, high: int) -> list[tuple[int, int]]:
        """Splits the nodes by their features from place ``low`` on; those without a split come back."""
        left = []
        together = max(1, HELD // ((2 + (classes or 1)) * (high - low) * (BINS + 1)))
        for at in range(0, len(nodes), together):
            jobs = [(*node, order[node][low:high], own.get(node)) for node in nodes[at:at + together]]
            for (t, i, features, its), h in zip(jobs, _histograms(rows, k, classes, tops, seed, jobs, cuts), strict=True):
                top, best = tops[t], None
                total = h[0].sum(axis=0)
                top.rows[i], top.cover[i] = int(total[0]), float(total[1])
                if total[0] <= most:
                    continue
                for q, f in enumerate(features):
                    n_left = np.cumsum(h[q, :, 0])
                    score = np.where((n_left > 0) & (n_left < total[0]), side_scores(h[q, :, 2:], h[q, :, 1]), -np.inf)
                    c = int(np.argmax(score))
                    if np.isfinite(score[c]) and (best is None or score[c] > best[0]):
                        best = (float(score[c]), int(f), c, int(n_left[c]), float(h[q, :c + 1, 1].sum()))
                if best is None:
                    left.append((t, i))
                    last[t, i] = total
                    continue
                score, f, c, n_left, w_left = best
                top.feature[i], top.cut[i] = f, float((its or cuts)[f][c])
                top.left[i], top.right[i] = top.add(n_left, w_left), top.add(int(total[0]) - n_left, float(total[1]) - w_left)
                top.gain[f] = top.gain.get(f, 0.0) + score - float((total[2:] ** 2).sum() / total[1])
        return left
    last: dict = {}
    for _ in range(2):  # at the table's quantiles, then at the node's own
        wanted = attempt(wanted, 0, tried)
        for low in range(tried, k, tried):
            wanted = attempt(wanted, low, min(k, low + tried)) if wanted else []
        if not wanted or own:
            break
        by_tree: dict[int, list[int]] = {}
        for t, i in wanted:
            by_tree.setdefault(t, []).append(i)
        own = _own_cuts(rows, k, classes, tops, by_tree, seed)
    for t, i in wanted:  # equal features
        tops[t].value[i] = (last[t, i][2:] / last[t, i][1]).tolist()
    return True


def fit(df: DataFrame, features: list[str], label: str, classes: list | None = None, trees: int = 100, tried: int | None = None,
        seed: int | None = 42, group_rows: int = GROUP_ROWS) -> Forest:
    """A forest on the rows with a label.

    ``classes``: the labels to tell apart (None: the label is a number); ``tried``: features tried at a node (default:
    the root of their number for classes, all for numbers); ``seed`` None: every tree sees every row once.
    """
    k = len(features)
    tried = tried or (max(1, math.isqrt(k)) if classes is not None else k)
    y = F.col(f"`{label}`")
    code = y.cast("double") if classes is None else F.coalesce(*[F.when(y == F.lit(c), float(i)) for i, c in enumerate(classes)])
    rows = df.select(F.monotonically_increasing_id().alias("row"), code.alias("y"),
                     *[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))).alias(f"f{j}") for j, f in enumerate(features)])
    rows = rows.where(F.col("y").isNotNull() & ~F.isnan("y"))
    # a row's draw comes from its values and its number, which tells equal rows apart
    xs = [f"f{j}" for j in range(k)]
    rows = rows.withColumn("k", F.pmod(F.xxhash64("y", *xs, F.lit(1)) + F.col("row"), F.lit(PRIME)))
    n, different = rows.count(), rows.select(*xs).distinct().count()
    alike = 2 * different <= n
    rows = _dealt(rows, n, trees, xs if alike else None)
    n_classes = len(classes) if classes is not None else 0
    # cells of a tree at most
    size = min(n, PARTS * different * max(1, n_classes)) if alike else n
    most = max(1, min(group_rows, GROUP_VALUES // max(1, k)))
    tops = [Top(rows=[size]) for _ in range(trees)]
    if size > most:
        cuts = _cut_lists(rows.agg(*_quantiles(k)).first(), k)
        while _split_large(rows, k, tops, seed, n_classes, tried, most, cuts):
            pass

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        t, node = int(group["tree"].iloc[0]), int(group["node"].iloc[0])
        c = _unpacked(group.sort_values("block", kind="stable"), k, n_classes)
        grown = grow_exact(c.x, c.s[:, None], c.w, tried, np.random.default_rng([seed or 0, t, node, 1]), c.lo != c.hi, n_classes)
        value = list(grown.pop("value"))
        if n_classes:  # only leaves vote
            value = [v if a < 0 else v[:0] for v, a in zip(value, grown["left"].tolist())]
        return pd.DataFrame([{"tree": t, "node": node, **grown, "value": value}])[SUBTREE_COLUMNS]
    groups = {t: {i for i in range(len(top.feature)) if top.left[i] < 0 and top.value[i] is None} for t, top in enumerate(tops)}
    # every group's size was counted: at most group_rows cells
    routed = _routed(rows, k, n_classes, tops, groups, seed)
    tasks = min(MOST_TASKS, max(1, sum(map(len, groups.values()))))  # a group takes long: few share a task
    subtrees = routed.repartition(tasks, "tree", "node").groupBy("tree", "node").applyInPandas(finish, SUBTREE)
    return Forest(list(features), classes, tops, materialize(subtrees, repartition=False), most)


def _packed_tree(s, width: int) -> tuple[bytes, bytes, bytes, bytes]:
    """A subtree for scoring: feature, cut, left child (the right one is the next), or -1 - the number of the leaf's value; the values."""
    left = np.array(s.left, np.int32)
    leaf = np.flatnonzero(left < 0)
    v = np.stack([s.value[i] for i in leaf])
    number = np.arange(len(leaf))
    if width > 1:  # most leaves hold one class
        pure = v.max(axis=1) == 1
        number = np.where(pure, v.argmax(axis=1), width + np.cumsum(~pure) - 1)
        v = np.vstack([np.eye(width), v[~pure]])
    left[leaf] = -1 - number
    return np.asarray(s.feature, np.int32).tobytes(), np.asarray(s.cut, np.float64).tobytes(), left.tobytes(), v.tobytes()


def _leaf_numbers(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    going = np.flatnonzero(left[at] >= 0)
    while len(going):
        node = at[going]
        at[going] = left[node] + ~(x[going, feature[node]] <= cut[node])
        going = going[left[at[going]] >= 0]
    return -1 - left[at]


def _by_blocks(forest: Forest, points: DataFrame, k: int, blocks: int, parts: int) -> DataFrame:
    """row, votes and their sums by part: groups of subtrees come to blocks of rows."""
    width = len(forest.classes) if forest.classes is not None else 1
    names = ["tree", "node", "feature", "cut", "left", "value"]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in batch.itertuples():
                yield pd.DataFrame([(s.tree, s.node, *_packed_tree(s, width))], columns=names)
    packed = materialize(forest.subtrees.select(*names).mapInPandas(pack, "tree int, node int, feature binary, cut binary, left binary, value binary"), repartition=False)
    packed = packed.withColumn("part", F.pmod(F.xxhash64("tree", "node"), F.lit(parts))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    at = points.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    values, tops = [f"v{q}" for q in range(width)], forest.tops

    def score(rows_: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        x = rows_[[f"f{j}" for j in range(k)]].to_numpy(np.float64, na_value=np.nan)
        total, votes = np.zeros((len(x), width)), np.zeros(len(x))
        places: dict[int, np.ndarray] = {}

        def place(t: int) -> np.ndarray:
            if t not in places:
                places.clear()
                top = tops[t]
                places[t] = descend(top.feature, top.cut, top.left, top.right, x)
            return places[t]
        for s in trees.sort_values(["tree", "node"]).itertuples():
            of = np.flatnonzero(place(s.tree) == s.node)
            feature, cut, left, value = (np.frombuffer(b, d) for b, d in ((s.feature, np.int32), (s.cut, np.float64), (s.left, np.int32), (s.value, np.float64)))
            total[of] += value.reshape(-1, width)[_leaf_numbers(feature, cut, left, x[of])]
            votes[of] += 1
        if len(x) and rows_["part"].iloc[0] == 0:  # leaves of the upper levels
            for t, top in enumerate(tops):
                for i, v in enumerate(top.value):
                    if v is not None:
                        of = np.flatnonzero(place(t) == i)
                        total[of] += v
                        votes[of] += 1
        return pd.DataFrame({"row": rows_["row"].to_numpy(), "votes": votes, **{v: total[:, q] for q, v in enumerate(values)}})
    both = (d.repartition(min(MOST_TASKS, blocks * parts), "block", "part").groupBy("block", "part") for d in (at, packed))
    return next(both).cogroup(next(both)).applyInPandas(score, "row long, votes double, " + ", ".join(f"{v} double" for v in values))


def _by_rows(forest: Forest, points: DataFrame, k: int) -> DataFrame:
    """row, votes and their sums by tree: rows go to their subtrees."""
    width = len(forest.classes) if forest.classes is not None else 1
    values, tops = [f"v{q}" for q in range(width)], forest.tops

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[[f"f{j}" for j in range(k)]].to_numpy(np.float64, na_value=np.nan)
            for t, top in enumerate(tops):
                node = descend(top.feature, top.cut, top.left, top.right, x)
                yield pd.DataFrame({"tree": np.int32(t), "node": node.astype(np.int32), "row": batch["row"].to_numpy(), **{f"f{j}": x[:, j] for j in range(k)}})
    at = points.mapInPandas(send, "tree int, node int, row long, " + ", ".join(f"f{j} double" for j in range(k)))
    leaves = {(t, i): v for t, top in enumerate(tops) for i, v in enumerate(top.value) if v is not None}
    most = at.groupBy("tree", "node").count().agg(F.max("count")).first()[0] or 0
    salts = max(1, -(-2 * most // forest.group_rows))
    at = at.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    subtrees = forest.subtrees.drop("gain", "cover").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def score(rows_: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if rows_.empty:
            return pd.DataFrame(columns=["row", "votes", *values])
        if tree.empty:
            v = leaves.get((int(rows_["tree"].iloc[0]), int(rows_["node"].iloc[0])))
            if v is None:  # no training row came here: the tree has no vote
                return pd.DataFrame(columns=["row", "votes", *values])
            got = np.tile(v, (len(rows_), 1))
        else:
            s = next(tree.itertuples())
            *parts, value = (np.frombuffer(b, d) for b, d in zip(_packed_tree(s, width), (np.int32, np.float64, np.int32, np.float64)))
            got = value.reshape(-1, width)[_leaf_numbers(*parts, rows_[[f"f{j}" for j in range(k)]].to_numpy())]
        return pd.DataFrame({"row": rows_["row"].to_numpy(), "votes": 1.0, **{v: got[:, q] for q, v in enumerate(values)}})
    return at.groupBy("tree", "node", "salt").cogroup(subtrees.groupBy("tree", "node", "salt")).applyInPandas(
        score, "row long, votes double, " + ", ".join(f"{v} double" for v in values))


def predict(forest: Forest, df: DataFrame, key: str, output: str = "prediction", blocks: int | None = None) -> DataFrame:
    """key, prediction (the mean of the trees, or the class with the largest mean share; ties: the first class).

    ``key`` identifies a row; it must be unique and not NULL.  ``blocks``: of rows that meet the subtrees; 0: rows go to
    the subtrees (None: whichever moves fewer bytes).
    """
    k, trees, width = len(forest.features), len(forest.tops), len(forest.classes) if forest.classes is not None else 1
    xs, values = [f"f{j}" for j in range(k)], [f"v{q}" for q in range(width)]
    n = df.count()
    rows = _dealt(df.select(F.col(f"`{key}`").alias("key"), F.monotonically_increasing_id().alias("row"),
                            *[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))).alias(x) for x, f in zip(xs, forest.features, strict=True)]), n, trees)
    points = rows.drop("key")
    alike = xs and 2 * points.select(*xs).distinct().count() <= n
    if alike:  # equal rows are scored once
        points = materialize(points.select(*xs).distinct().withColumn("row", F.monotonically_increasing_id()), repartition=False)
        n = points.count()
    size = 20 * (forest.subtrees.agg(F.sum(F.size("feature"))).first()[0] or 0)  # bytes
    if blocks is None:
        blocks = max(math.ceil(n * k / SCORED_VALUES), min(BLOCKS, math.ceil(n / 1000)), 1)
        if blocks * size > n * trees * 8 * (k + 2 + width):
            blocks = 0
    if blocks:
        votes = _by_blocks(forest, points, k, blocks, max(1, math.ceil(size / SUBTREE_BYTES)))
    else:
        votes = _by_rows(forest, points, k)
    count = F.sum("votes")
    mean = votes.groupBy("row").agg(*[F.when(count > 0, F.sum(v) / count).alias(v) for v in values])
    if forest.classes is None:
        result = F.col("v0")
    else:
        top = F.greatest(*[F.col(v) for v in values]) if width > 1 else F.col("v0")
        result = F.coalesce(*[F.when(F.col(v) == top, F.lit(c)) for v, c in zip(values, forest.classes, strict=True)])
    mean = mean.select("row", result.alias(output))
    if alike:
        scored = points.join(mean, "row", "left").drop("row")
        return rows.join(scored, xs, "left").select(F.col("key").alias(key), output)
    return rows.select("key", "row").join(mean, "row", "left").select(F.col("key").alias(key), output)
