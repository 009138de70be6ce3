"""Histogram boosting: sums, trees and scores against brute force."""
from dataclasses import replace

import numpy as np
import pytest

from hrlens.operators.ml import boost
from hrlens.operators.ml.boost import Params


def planted(n, seed=0, missing=0.0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 40, n), rng.normal(size=n).round(1), rng.integers(0, 2, n), np.full(n, 3.0)]).astype(float)
    y = 3 * np.sin(x[:, 0] / 5) + x[:, 1] * (x[:, 2] * 2 - 1) + rng.normal(0, 0.3, n)
    if missing:
        x[rng.random(n) < missing, 0] = np.nan
        y += 4 * np.isnan(x[:, 0])
    return x, y


def table(spark, x, y, parts=4):
    rows = [(float(b), *[None if np.isnan(v) else float(v) for v in a]) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "y double, a double, b double, c double, d double").repartition(parts)


FEATURES = ["a", "b", "c", "d"]


def grown_by_hand(x, g, h, cuts, p):
    """One tree, best leaf first, by trying every cut on the rows themselves: {node: (feature, cut, gain) or value}."""
    def gain_of(rows):
        best = None
        tot = g[rows].sum() ** 2 / (h[rows].sum() + p.l2)
        for f in range(x.shape[1]):
            for cut in [*cuts[f], np.inf]:
                for to_left in (False, True):
                    v = x[rows, f]
                    left = np.where(np.isnan(v), to_left, v <= cut)
                    n = min(left.sum(), (~left).sum())
                    a, b = rows[left], rows[~left]
                    if n < max(1, p.min_rows) or min(h[a].sum(), h[b].sum()) < p.min_hessian:
                        continue
                    gain = float(boost.nine_digits(np.array([g[a].sum() ** 2 / (h[a].sum() + p.l2) + g[b].sum() ** 2 / (h[b].sum() + p.l2) - tot]))[0])
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, cut, a, b)
        return best
    out, leaves = {}, {1: np.arange(len(x))}
    best = {1: gain_of(leaves[1])}

    def depth(i):
        return i.bit_length() - 1
    while p.max_leaves is None or len(leaves) < p.max_leaves:
        can = [(-best[i][0], i) for i in leaves if best[i] and (p.max_depth is None or depth(i) < p.max_depth)]
        if not can:
            break
        i = min(can)[1]
        gain, f, cut, a, b = best[i]
        out[i] = (f, cut, gain)
        del leaves[i]
        for j, rows in ((2 * i, a), (2 * i + 1, b)):
            leaves[j], best[j] = rows, gain_of(rows)
    for i, rows in leaves.items():
        out[i] = -g[rows].sum() / (h[rows].sum() + p.l2)
    return out


def nodes_of(model, t=0):
    out = {}

    def walk(i, name):
        n = model.trees[t][i]
        if n.split:
            c = model.cuts[n.feature]
            out[name] = (n.feature, c[n.bin - 1] if n.bin <= len(c) else np.inf, n.gain)
            walk(n.left, 2 * name)
            walk(n.right, 2 * name + 1)
        else:
            out[name] = n.value
    walk(0, 1)
    return out


@pytest.mark.parametrize("missing", [0.0, 0.2])
@pytest.mark.parametrize("p", [Params(rounds=2, max_leaves=9, min_rows=8, bins=16), Params(rounds=2, rate=0.5, max_leaves=None, max_depth=3, l2=1.0, min_rows=1, bins=12)])
def test_trees_by_hand(spark, p, missing):
    x, y = planted(400, 3, missing)
    model = boost.fit(table(spark, x, y), FEATURES, "y", p)
    score = np.full(len(y), y.mean())
    for t in range(2):
        want = grown_by_hand(x, score - y, np.ones(len(y)), model.cuts, p)
        got = nodes_of(model, t)
        assert got.keys() == want.keys()
        for i, w in want.items():
            assert got[i] == (pytest.approx(w, rel=1e-7, abs=1e-7) if isinstance(w, float) else (w[0], pytest.approx(w[1]), pytest.approx(w[2], rel=1e-6)))
        one = replace(p, rounds=1)
        score = score + p.rate * (boost.Model(FEATURES, model.cuts, 0.0, replace(one, rate=1.0), [model.trees[t]]).score(x))
    assert np.allclose(model.score(x), score)


def test_histogram_sums_and_subtraction(spark):
    x, y = planted(300, 5, 0.1)
    df = table(spark, x, y)
    cuts = boost.cut_points(df, FEATURES, 20)
    rows = boost.binned(df, FEATURES, cuts, "y").selectExpr("*", "0.5 as score")
    root = boost.histograms(rows, [boost.Node(0, 0, 0.0)], [0], (4, 22), "squared")[0]
    for j in range(4):
        b = boost.bin_of(x[:, j], cuts[j])
        assert np.allclose(root[j, :, 0], np.bincount(b, 0.5 - y, 22)) and (root[j, :, 2] == np.bincount(b, minlength=22)).all()
    parts = {}
    for direction in ([1, 2], [2]):
        nodes = [boost.Node(0, 0, 0.0, feature=1, bin=7, left=1, right=2), boost.Node(1, 0, 0.0), boost.Node(1, 0, 0.0)]
        parts |= {(i, len(direction)): h for i, h in boost.histograms(rows, nodes, direction, (4, 22), "squared").items()}
    assert np.allclose(root - parts[2, 1], parts[1, 2])


def test_cuts_are_quantiles(spark):
    x, y = planted(500)
    cuts = boost.cut_points(table(spark, x, y), FEATURES, 10)
    order = np.sort(x[:, 1])
    assert cuts[1].tolist() == sorted({order[int(np.ceil(i / 10 * 500)) - 1] for i in range(1, 10)})
    assert len(cuts[2]) == 1 and len(cuts[3]) == 0


def test_model_learns_and_predicts(spark):
    x, y = planted(3000, 1, 0.05)
    df = table(spark, x, y)
    for p in (replace(boost.LEAF_WISE, rounds=12, rate=0.3), replace(boost.DEPTH_WISE, rounds=8)):
        model = boost.fit(df, FEATURES, "y", p)
        got = boost.predict(model, df).select("y", "prediction").toPandas()
        assert 1 - ((got.y - got.prediction) ** 2).sum() / ((got.y - got.y.mean()) ** 2).sum() > 0.8
        share = model.importance()
        assert share.sum() == pytest.approx(1) and share[3] == 0 and model.importance("split")[0] > 0


def test_logistic_loss(spark):
    x, y = planted(1500, 2)
    label = (y > np.median(y)).astype(float)
    df = table(spark, x, label)
    model = boost.fit(df, FEATURES, "y", Params(rounds=10, rate=0.3, max_leaves=8, loss="logistic"))
    got = boost.predict(model, df).select("y", "prediction").toPandas()
    assert got.prediction.between(0, 1).all() and ((got.prediction > 0.5) == (got.y == 1)).mean() > 0.85


def test_edges(spark):
    schema = "y double, a double, b string"
    none = spark.createDataFrame([], schema)
    model = boost.fit(none, ["a"], "y", Params(rounds=2))
    assert model.base == 0 and model.score(np.array([[1.0]])) == [0.0]
    same = spark.createDataFrame([(2.0, 1.0, "x")] * 50 + [(None, 2.0, "x"), (float("nan"), 3.0, "x"), (2.0, None, "x")], schema)
    model = boost.fit(same, ["a"], "y", Params(rounds=2, min_rows=1))
    assert model.base == 2 and all(not n.split for t in model.trees for n in t)
    only_missing = spark.createDataFrame([(float(i % 2), None if i % 2 else 5.0) for i in range(60)], "y double, a double")
    model = boost.fit(only_missing, ["a"], "y", Params(rounds=1, rate=1.0))
    assert model.score(np.array([[np.nan], [5.0], [9.0]])).tolist() == pytest.approx([1.0, 0.0, 0.0])


def test_rows_of_equal_bins_are_one_cell(spark):
    """A round's table and passes grow with the different rows; trees equal those grown on single rows."""
    x, y = planted(400, 3, 0.1)
    df = table(spark, x, y)
    cuts = boost.cut_points(df, FEATURES, 20)
    many = boost.binned(df, FEATURES, cuts, "y").selectExpr("bins", "explode(array(label, label + 1, label - 1)) as label")
    rows, one = many.selectExpr("*", "0.0D as score"), boost.cells(many).selectExpr("*", "0.0D as score")
    assert one.count() == many.select("bins").distinct().count() < many.count() / 2
    assert one.selectExpr("sum(n)").first()[0] == 1200
    for loss in ("squared", "logistic"):
        p = Params(max_leaves=8, loss=loss)
        a, b = (boost.grow(r, p, (4, 22)) for r in (rows, one))
        assert [(n.split, n.feature, n.bin, n.n) for n in a] == [(n.split, n.feature, n.bin, n.n) for n in b]
        assert np.allclose([n.value for n in a], [n.value for n in b])


@pytest.mark.parametrize("p", [Params(rounds=6, max_leaves=8, min_rows=5), Params(rounds=6, rate=0.3, max_leaves=None, max_depth=3, l2=1.0, min_rows=1), Params(rounds=6, max_leaves=6, loss="logistic")])
def test_trees_held_by_one_task_equal_those_of_spark(spark, monkeypatch, p):
    x, y = planted(600, 4, 0.1)
    df = table(spark, x, (y > 0).astype(float) if p.loss == "logistic" else y)
    seen = []
    real = boost.histograms
    monkeypatch.setattr(boost, "histograms", lambda *a: (seen.append(1), real(*a))[1])
    held = boost.fit(df, FEATURES, "y", p)
    assert not seen  # no Spark job a level
    monkeypatch.setattr(boost, "HELD", 0)
    spread = boost.fit(df, FEATURES, "y", p)
    assert len(seen) > 6 == len(held.trees) == len(spread.trees)
    for a, b in zip(held.trees, spread.trees, strict=True):
        assert [(n.depth, n.n, n.feature, n.bin, n.missing_left, n.left, n.right, n.split, n.step) for n in a] == [(n.depth, n.n, n.feature, n.bin, n.missing_left, n.left, n.right, n.split, n.step) for n in b]
        assert np.allclose([n.value for n in a], [n.value for n in b])
    assert held.score(x) == pytest.approx(spread.score(x))


def test_boosted_comparison_grows_all_rounds(spark):
    """As many rounds as the analyses' libraries: every one is in the model."""
    from hrlens.plans import boosting
    rows = boosting.pay_boosted(spark, "/root/testdata/sf0.001").collect()
    assert {r["rounds"] for r in rows} == {100} and {r["model"] for r in rows} == {"leaf-wise", "depth-wise, L2"}
    train = boosting.boosting_design(spark, "/root/testdata/sf0.001").where(~boosting.is_test("est_id"))
    model = boost.fit(train, boosting.FEATURES, "annual_pay", replace(boost.DEPTH_WISE, rounds=boosting.COMPARED_ROUNDS))
    assert len(model.trees) == 100 and sum(t[0].split for t in model.trees) > 90
    assert [r["gain_share"] for r in rows if r["model"] == "depth-wise, L2"] == pytest.approx(list(model.importance()))
