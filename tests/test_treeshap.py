"""TreeSHAP against brute-force Shapley values of the path-dependent game."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from hearth.operators.treeshap import _leaf_table, extract, shap_values, tree_shap
from hearth.plans import frames as fr
from tests.conftest import SF_SMALL

FEATS = ["area", "overall_qual", "year_built", "garage_cars"]


@pytest.fixture(scope="module")
def fitted(spark):
    df = fr.model_frame(spark, SF_SMALL).na.drop(subset=FEATS).withColumn("y", F.log("sale_price"))
    df = VectorAssembler(inputCols=FEATS, outputCol="features").transform(df)
    model = GBTRegressor(labelCol="y", maxIter=5, maxDepth=3, seed=1).fit(df)
    return df, model


def _cond_exp(node, x, S):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    f = int(split.featureIndex())
    left, right = node.leftChild(), node.rightChild()
    if f in S:
        go_left = x[f] <= split.threshold()
        return _cond_exp(left if go_left else right, x, S)
    n = float(node.impurityStats().count())
    return (float(left.impurityStats().count()) * _cond_exp(left, x, S)
            + float(right.impurityStats().count()) * _cond_exp(right, x, S)) / n


def _brute(model, x):
    M = len(x)
    phi = np.zeros(M)
    for t, w in zip(model.trees, model.treeWeights):
        root = t._java_obj.rootNode()
        for i in range(M):
            others = [j for j in range(M) if j != i]
            for s in range(M):
                for S in itertools.combinations(others, s):
                    c = math.factorial(s) * math.factorial(M - s - 1) / math.factorial(M)
                    phi[i] += w * c * (_cond_exp(root, x, set(S) | {i}) - _cond_exp(root, x, set(S)))
    return phi


def test_matches_brute_force(fitted):
    df, model = fitted
    X = np.array([r.features.toArray() for r in df.select("features").limit(5).collect()])
    tables = extract(model)
    phi = shap_values(X, tables)
    for k in range(len(X)):
        assert np.allclose(phi[k], _brute(model, X[k]), atol=1e-9)


def test_additivity_distributed(fitted):
    df, model = fitted
    pred = model.transform(df).select("id", "prediction")
    sh = tree_shap(df, model).join(pred, "id").collect()
    for r in sh:
        assert r.base_value + sum(r.shap) == pytest.approx(r.prediction, abs=1e-9)


def test_leaf_table_of_a_deep_path_adds_up():
    """Eight features on one path: values of each pattern sum to the leaf's gain over the base."""
    z = np.linspace(0.2, 0.9, 8)
    table = _leaf_table(z, 3.0)
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    full = 3.0 * bits.prod(1)
    assert table.sum(1) == pytest.approx(full - 3.0 * z.prod())


def test_tables_of_many_trees_are_made_in_the_tasks(fitted, monkeypatch):
    """Kept or made anew for every batch: the same values, and none of them on the driver."""
    from hearth.operators import treeshap
    df, model = fitted
    want = {r.id: r.shap for r in tree_shap(df, model).collect()}
    monkeypatch.setattr(treeshap, "KEPT_CELLS", 0)
    monkeypatch.setattr(treeshap, "extract", None)  # makes the tables here
    got = {r.id: r.shap for r in tree_shap(df, model).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-12) for k in want)
