"""TreeSHAP: additivity on Spark forests/boosting, and equality with brute-force Shapley."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from hrlens.operators.ml import treeshap as ts
from hrlens.operators.ml.models import tree_weights


def _cond_exp(tree, x, S, node=0):
    if tree.left[node] < 0:
        return tree.value[node]
    f = tree.feature[node]
    l, r = tree.left[node], tree.right[node]
    if f in S:
        return _cond_exp(tree, x, S, l if x[f] <= tree.threshold[node] else r)
    c = tree.cover[node]
    return (tree.cover[l] * _cond_exp(tree, x, S, l) + tree.cover[r] * _cond_exp(tree, x, S, r)) / c


def _brute(tree, x, m):
    phi = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for k in range(m):
            for S in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                phi[i] += w * (_cond_exp(tree, x, set(S) | {i}) - _cond_exp(tree, x, set(S)))
    return phi


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 300
    X = rng.normal(size=(n, 4))
    y = 3 * X[:, 0] + np.where(X[:, 1] > 0, 2.0, -1.0) * X[:, 2] + rng.normal(0, 0.1, n)
    df = spark.createDataFrame([(i, *map(float, X[i]), float(y[i])) for i in range(n)],
                               "id long, a double, b double, c double, d double, y double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)


@pytest.mark.parametrize("make", [lambda: RandomForestRegressor(numTrees=10, maxDepth=4, seed=1, labelCol="y"),
                                  lambda: GBTRegressor(maxIter=8, maxDepth=3, seed=1, labelCol="y")])
def test_additivity(spark, data, make):
    model = make().fit(data)
    trees = ts.extract_trees(spark, model)
    w = tree_weights(model)
    base = ts.ensemble_base(trees, w)
    pdf = model.transform(data).select("a", "b", "c", "d", "prediction").limit(25).toPandas()
    X = pdf[["a", "b", "c", "d"]].to_numpy()
    phi = ts.ensemble_shap(trees, w, X)
    assert np.allclose(base + phi.sum(axis=1), pdf["prediction"].to_numpy(), atol=1e-8)
    # the vectorised form equals the row-at-a-time recursion
    assert np.allclose(phi, ts.ensemble_shap_rowwise(trees, w, X), atol=1e-9)


def test_matches_brute_force(spark, data):
    model = RandomForestRegressor(numTrees=3, maxDepth=4, seed=2, labelCol="y").fit(data)
    trees = ts.extract_trees(spark, model)
    x = np.array([0.3, -0.2, 1.1, 0.0])
    for t in trees:
        phi = np.zeros(4)
        ts.tree_shap(t, x, phi)
        assert np.allclose(phi, _brute(t, x, 4), atol=1e-10)


def test_shap_long_distributed(spark, data):
    model = GBTRegressor(maxIter=5, maxDepth=3, seed=1, labelCol="y").fit(data)
    trees = ts.extract_trees(spark, model)
    long = ts.shap_long(spark, data, "id", ["a", "b", "c", "d"], trees, tree_weights(model))
    assert long.count() == 300 * 4
