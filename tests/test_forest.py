"""Forests of unbounded depth: purity, the split rule by brute force, groups of counted size."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from hrlens.operators.ml import forest


def table(spark, x, y, kind="double", parts=3):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in a], b) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"f{j} double" for j in range(len(x[0]))) + f", y {kind}").repartition(parts)


def predicted(model, df):
    return {r["id"]: r["prediction"] for r in forest.predict(model, df, "id").collect()}


def depth_of(row):
    depth = {0: 0}
    for i, (a, b) in enumerate(zip(row["left"], row["right"])):
        if a >= 0:
            depth[a] = depth[b] = depth[i] + 1
    return max(depth.values())


def test_pure_leaves_deeper_than_thirty(spark):
    """Every split of doubling values takes off the largest one."""
    y = [float(2 ** i) for i in range(60)]
    df = table(spark, [[i] for i in range(60)], y)
    model = forest.fit(df, ["f0"], "y", trees=1, seed=None)
    assert depth_of(model.subtrees.first()) > 30
    assert predicted(model, df) == dict(enumerate(y))


@pytest.mark.parametrize("group_rows", [25, 10_000])
def test_training_rows_come_back(spark, group_rows):
    """Upper levels by Spark or none at all: leaves are pure, and groups stay within their bound."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(240, 3))
    x[:80] = [1.0, 2.0, 3.0]  # a third of the rows are alike
    y = np.where(np.arange(240) < 80, 5, rng.integers(0, 3, 240))
    df = table(spark, x, [f"c{v}" for v in y], "string")
    model = forest.fit(df, ["f0", "f1", "f2"], "y", classes=["c0", "c1", "c2", "c5"], trees=2, seed=None, group_rows=group_rows)
    assert predicted(model, df) == {i: f"c{v}" for i, v in enumerate(y)}
    assert (len(model.tops[0].feature) > 1) == (group_rows == 25)
    for top in model.tops:
        assert all(n <= group_rows or v is not None for n, left, v in zip(top.rows, top.left, top.value) if left < 0)
    assert sum(model.importances()) == pytest.approx(1)


def cart(x, y):
    """The mean of the leaf that a point falls in, by trying every cut."""
    def build(rows):
        if len(set(y[rows])) == 1:
            return y[rows[0]]
        best = None
        for f in range(x.shape[1]):
            for lo, hi in zip(np.unique(x[rows, f])[:-1], np.unique(x[rows, f])[1:]):
                left = x[rows, f] <= lo
                score = y[rows][left].sum() ** 2 / left.sum() + y[rows][~left].sum() ** 2 / (~left).sum()
                if best is None or score > best[0] + 1e-9:
                    best = (score, f, lo + (hi - lo) / 2, left)
        if best is None:
            return y[rows].mean()
        _, f, cut, left = best
        return f, cut, build(rows[left]), build(rows[~left])

    def at(node, p):
        while isinstance(node, tuple):
            node = node[2] if p[node[0]] <= node[1] else node[3]
        return node
    tree = build(np.arange(len(y)))
    return tree, lambda p: at(tree, p)


def test_one_tree_by_hand(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 1)).round(2)
    y = 3 * x[:, 0] - x[:, 0] ** 2 + rng.normal(0, 0.1, 120)
    model = forest.fit(table(spark, x, y.tolist()), ["f0"], "y", trees=1, seed=None)
    new = rng.normal(size=(200, 1))
    _, want = cart(x, y)
    got = predicted(model, table(spark, new, [0.0] * 200))
    assert [got[i] for i in range(200)] == pytest.approx([want(p) for p in new])


def test_splits_by_hand(spark):
    """With several features, splits of two rows tie; those of many don't."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 3)).round(2)
    y = 3 * x[:, 0] - x[:, 1] ** 2 + rng.normal(0, 0.1, 150)
    grown = forest.fit(table(spark, x, y.tolist()), ["f0", "f1", "f2"], "y", trees=1, seed=None).subtrees.first()

    def compare(want, node, rows):
        if len(rows) < 10:
            return
        f, cut, left, right = want
        below = x[rows, f] <= cut
        if min(below.sum(), (~below).sum()) < 4:
            return
        assert (grown["feature"][node], grown["cut"][node]) == (f, pytest.approx(cut))
        compare(left, grown["left"][node], rows[below])
        compare(right, grown["right"][node], rows[~below])
    compare(cart(x, y)[0], 0, np.arange(150))


def test_forest_learns_and_is_spread(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = table(spark, x, y.tolist(), "int")
    model = forest.fit(df, [f"f{j}" for j in range(4)], "y", classes=[0, 1], trees=15, group_rows=150)
    new = rng.normal(size=(300, 4))
    got = predicted(model, table(spark, new, [0] * 300, "int"))
    assert np.mean([got[i] == (p[0] * p[1] > 0) for i, p in enumerate(new)]) > 0.85
    share = model.importances()
    assert share[0] + share[1] > 0.7
    assert model.subtrees.where(F.size("feature") == 0).count() == 0


def test_missing_values_and_edges(spark):
    x = [[np.nan], [np.nan], [1.0], [2.0]] * 10
    df = table(spark, x, [9.0, 9.0, 1.0, 2.0] * 10)
    for group_rows in (8, 1000):
        model = forest.fit(df, ["f0"], "y", trees=1, seed=None, group_rows=group_rows)
        assert predicted(model, df) == {i: [9.0, 9.0, 1.0, 2.0][i % 4] for i in range(40)}
    none = df.where("id < 0")
    model = forest.fit(none, ["f0"], "y", trees=2)
    assert set(predicted(model, df).values()) == {None} and model.importances() == [0.0]
    unlabelled = forest.fit(df.withColumn("y", F.when(F.col("id") > 3, F.col("y"))), ["f0"], "y", trees=3)
    assert forest.predict(unlabelled, none, "id").count() == 0


def test_growth_is_by_levels_and_rows_are_dealt(spark):
    """A group costs numpy steps a level, not a node; a one-partition table is spread over tasks by rows times trees."""
    class Counting:
        def __init__(self):
            self.rng, self.drawn = np.random.default_rng(1), 0

        def __getattr__(self, name):
            self.drawn += 1
            return getattr(self.rng, name)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 4)).round(3)
    x[rng.random(3000) < 0.1, 2] = np.nan
    y, w, draws = x[:, 0] + rng.normal(size=3000), rng.integers(1, 4, 3000).astype(float), Counting()
    tree = forest.grow_exact(x, (y * w)[:, None], w, 4, draws)
    assert draws.drawn < 100 < len(tree["feature"])
    at = forest.descend(tree["feature"], tree["cut"], tree["left"], tree["right"], x)
    assert np.array(tree["value"])[at][:, 0] == pytest.approx(y)
    assert forest._dealt(spark.range(1000, numPartitions=1), 1000, 400).rdd.getNumPartitions() == 2


def test_activity_rows_that_repeat(spark, tmp_path):
    """Every held-out row is classified, also where vec_id repeats; no tree is cut at a depth."""
    from hrlens.plans import ml
    rng = np.random.default_rng(6)
    rows = [(i // 2, i % 3, [float(i % 3) + float(v) / 9 for v in rng.normal(size=4)]) for i in range(300)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = ml.activity_rf(spark, str(tmp_path)).collect()
    held_out = ml._activity(spark, str(tmp_path))["predict"].count()
    assert len(out) == held_out and len({r["vec_id"] for r in out}) * 2 == held_out
    assert np.mean([r["label"] == r["predicted_label"] for r in out]) > 0.9
    share = ml.activity_importance(spark, str(tmp_path)).collect()
    assert len(share) == 4 and sum(r["importance"] for r in share) == pytest.approx(1)
    assert isinstance(ml._activity(spark, str(tmp_path))["model"], forest.Forest)


def test_equal_rows_are_one_cell(spark):
    """Many rows of few different features need no upper levels; leaves hold the sums of all their rows."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 3, (900, 2)).astype(float)
    x[rng.random(900) < 0.1, 1] = np.nan
    y = rng.integers(0, 5, 900) + 10 * x[:, 0]
    rows = {}
    for i, p in enumerate(x):
        rows.setdefault(str(p), []).append(i)
    df = table(spark, x, y.tolist())
    model = forest.fit(df, ["f0", "f1"], "y", trees=1, seed=None, group_rows=200)
    assert len(model.tops[0].feature) == 1
    got = predicted(model, df)
    for of in rows.values():
        assert [got[i] for i in of] == pytest.approx([y[of].mean()] * len(of))
    assert sum(c for c, a in zip(*model.subtrees.select("cover", "left").first()) if a < 0) == 900
    classes = [f"c{int(v)}" for v in y]
    model = forest.fit(table(spark, x, classes, "string"), ["f0", "f1"], "y", classes=sorted(set(classes)), trees=1, tried=2, seed=None)
    got = predicted(model, table(spark, x, classes, "string"))
    for of in rows.values():
        count = {c: [classes[i] for i in of].count(c) for c in sorted(set(classes))}
        assert {got[i] for i in of} == {max(count, key=count.get)}


@pytest.mark.parametrize("kind", ["number", "class"])
def test_scoring_by_blocks_equals_scoring_by_rows(spark, kind):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 3))
    x[rng.random((400, 3)) < 0.05] = np.nan
    y = rng.integers(0, 4, 400)
    df = table(spark, x, y.tolist() if kind == "class" else (y + rng.normal(size=400)).tolist(), "int" if kind == "class" else "double")
    model = forest.fit(df, ["f0", "f1", "f2"], "y", classes=[0, 1, 2, 3] if kind == "class" else None, trees=4, group_rows=90)
    assert len(model.tops[0].feature) > 1
    by_rows, by_blocks, few = ({r["id"]: r["prediction"] for r in forest.predict(model, df, "id", blocks=b).collect()} for b in (0, 3, None))
    assert len(by_rows) == 400 and by_blocks == pytest.approx(by_rows) and few == pytest.approx(by_rows)


def test_large_nodes_past_the_tables_quantiles(spark, monkeypatch):
    """A node that no quantile of the table cuts is cut at its own ones."""
    monkeypatch.setattr(forest, "BINS", 4)
    y = np.arange(300.0) % 7
    df = table(spark, [[i] for i in range(300)], y.tolist())
    model = forest.fit(df, ["f0"], "y", trees=1, seed=None, group_rows=10)
    assert all(n <= 10 for n, left in zip(model.tops[0].rows, model.tops[0].left) if left < 0)
    assert predicted(model, df) == dict(enumerate(y))


def test_classes_split_as_by_hand():
    """The sums of squares kept while an entry moves over equal those of whole class counts."""
    rng = np.random.default_rng(9)
    rank, seg, w, c = rng.integers(0, 9, 200), rng.integers(0, 5, 200), rng.integers(1, 4, 200).astype(float), rng.integers(0, 3, 200)
    units = np.eye(3)[c] * w[:, None]
    total = np.array([units[seg == g].sum(axis=0) for g in range(5)])
    best, before, after = forest._cuts(rank, seg, 5, w, c, total)
    for g in range(5):
        scores = {}
        for v in np.unique(rank[seg == g])[:-1]:
            left, right = (units[(seg == g) & side].sum(axis=0) for side in (rank <= v, rank > v))
            scores[v] = (left ** 2).sum() / left.sum() + (right ** 2).sum() / right.sum()
        v = max(scores, key=scores.get)
        assert best[g] == pytest.approx(scores[v]) and rank[before[g]] == v < rank[after[g]]


def test_numbers_packed_come_back():
    for v in ([1.0, 255.0], [-3.0, 300.0], [0.5, np.nan], [0.1, np.pi, np.inf], []):
        assert np.array_equal(forest._unpack(forest._pack(np.array(v))), np.array(v), equal_nan=True)
