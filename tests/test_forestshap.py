"""SHAP values of a forest kept as a table: equal to the recursion over whole trees, whatever the size of groups."""

import numpy as np
import pytest

from hrlens.operators.ml import forest, forestshap
from hrlens.operators.ml import models as M
from hrlens.operators.ml import treeshap as ts
from hrlens.plans import ml

FEATURES = ["size", "year", "a", "b"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(200, 900, 700), rng.integers(2000, 2005, 700), rng.integers(0, 2, 700), rng.integers(0, 2, 700)]).astype(float)
    y = x[:, 0] * (1 + x[:, 2]) - 40 * (x[:, 1] - 2000) * x[:, 3] + rng.normal(0, 20, 700)
    return M.materialize(spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))],
                                               "est_id long, size double, year double, a double, b double, annual_pay double"), 700)


def whole_trees(model):
    """The forest's trees with their upper levels and subtrees joined."""
    subtrees = {(r["tree"], r["node"]): r for r in model.subtrees.collect()}
    out = []
    for t, top in enumerate(model.tops):
        left, right, feature, cut, value, cover = [], [], [], [], [], []

        def add(source, i, key):
            if key is not None and source.left[i] < 0 and source.value[i] is None:
                return add(subtrees[t, i], 0, None)
            me = len(left)
            for column, v in ((left, -1), (right, -1), (feature, source.feature[i]), (cut, source.cut[i]),
                              (value, (source.value[i] or [0.0])[0]), (cover, source.cover[i])):
                column.append(v)
            if source.left[i] >= 0:
                left[me], right[me] = add(source, source.left[i], key), add(source, source.right[i], key)
            return me
        add(top, 0, "top")
        out.append(ts.FlatTree(*(np.array(c) for c in (left, right, feature, cut, value, cover))))
    return out


@pytest.mark.parametrize("group_rows", [20_000, 60])
def test_forest_shap_equals_the_recursion(spark, table, group_rows):
    model = forest.fit(table, FEATURES, "annual_pay", trees=3, group_rows=group_rows)
    some = table.where("est_id < 60")
    some = some.union(some.where("est_id < 3").selectExpr("est_id + 1000", *FEATURES, "annual_pay"))  # equal rows
    got = forestshap.forest_shap(some, "est_id", model, points_together=25).toPandas()
    assert len(got) == 63 * 4
    got = got.pivot(index="est_id", columns="feature", values="shap_value")[FEATURES]
    rows = some.toPandas().set_index("est_id").loc[got.index]
    trees = whole_trees(model)
    want = ts.ensemble_shap_rowwise(trees, [1 / 3] * 3, rows[FEATURES].to_numpy())
    assert np.allclose(got.to_numpy(), want, atol=1e-6)
    base = forestshap.forest_base(model)
    assert base == pytest.approx(ts.ensemble_base(trees, [1 / 3] * 3))
    scored = forest.predict(model, some, "est_id").toPandas().set_index("est_id").loc[got.index]
    assert np.allclose(base + got.sum(axis=1), scored["prediction"])


def test_trees_without_rows_have_no_part(spark, table):
    few = table.where("est_id < 2")
    model = forest.fit(few, FEATURES, "annual_pay", trees=20)
    assert model.subtrees.count() < 20
    total = forestshap.forest_shap(few, "est_id", model).groupBy("est_id").agg({"shap_value": "sum"}).toPandas().set_index("est_id").iloc[:, 0]
    scored = forest.predict(model, few, "est_id").toPandas().set_index("est_id")["prediction"]
    assert np.allclose(forestshap.forest_base(model) + total, scored.loc[total.index])


def test_the_pay_forest_is_a_table(spark, table, monkeypatch):
    """Spark ML's forest, whose nodes the driver holds, takes no part in the comparison, and the forest can be explained."""
    presets = {"few": {M.FOREST: ("rf", M.RF_SPEC[1] | {"numTrees": 4}), M.FAST: ("gbt", M.FAST_SPEC[1] | {"maxIter": 1, "maxDepth": 1})}}
    monkeypatch.setattr(M, "REGRESSOR_PRESETS", presets)
    xs, train, test = ml.pay_split(table, FEATURES)
    c = ml.compare_models(xs, train, test, "few")
    assert isinstance(c["models"][M.FOREST], forest.Forest) and c["best"] == M.FOREST
    assert c["metrics"][M.FOREST]["n"] == test.count() and c["metrics"][M.FOREST]["r2"] > 0.9
    assert sum(M.importances(c["models"][M.FOREST])) == pytest.approx(1)
    monkeypatch.setattr(ml, "pay_comparison", lambda *_: c)
    long, base, best = ml._build_shap(spark, None)
    assert best == M.FOREST and long.columns == ["est_id", "feature", "feature_value", "shap_value"] and long.count() == 4 * test.count()
