"""Exact path-dependent TreeSHAP (Lundberg et al., 2018) for MLlib trees.

For a leaf L with unique path features U, the tree's conditional expectation
restricted to L is v_L·Π_{f∈U} (o_f if f is known else z_f), where o_f says
whether the row satisfies all of L's conditions on f and z_f is the product
of the cover ratios of those splits. Its Shapley value for i ∈ U is

    v_L·(o_i − z_i)·Σ_{S⊆U∖{i}} |S|!(|U|−|S|−1)!/|U|! · Π_{f∈S} o_f · Π_{f∈U∖S∖{i}} z_f,

which depends on the row only through the bit pattern (o_f)_{f∈U}. So each
leaf gets a table of 2^|U| rows, and a batch of rows is scored by computing its
patterns with NumPy and gathering — inside ``mapInPandas``, so Spark partitions the
rows and ships only the trees. Tasks make the tables: once if they are few
(``KEPT_CELLS``), else a few trees at a time.
GBT values are the weighted sum over trees; values + base = prediction.
"""

from __future__ import annotations

import math
import pickle
import zlib

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

#: Cells (pattern × path feature) of the leaf tables that a task keeps, and of those that are made in one go.
KEPT_CELLS, TABLE_CELLS = 4_000_000, 65_536


def _walk(node, path, leaves, cover_root):
    cls = node.getClass().getSimpleName()
    cover = float(node.impurityStats().count())
    if cls == "LeafNode":
        leaves.append((float(node.prediction()), list(path), cover / cover_root))
        return
    split = node.split()
    f = int(split.featureIndex())
    left, right = node.leftChild(), node.rightChild()
    cl, cr = float(left.impurityStats().count()), float(right.impurityStats().count())
    if split.getClass().getSimpleName() == "ContinuousSplit":
        cond = ("le", float(split.threshold()))
    else:
        cond = ("in", frozenset(float(c) for c in split.leftCategories()))
    _walk(left, path + [(f, cond, True, cl / cover if cover else 0.0)], leaves, cover_root)
    _walk(right, path + [(f, cond, False, cr / cover if cover else 0.0)], leaves, cover_root)


def _weights(u: int) -> list[float]:
    return [math.factorial(s) * math.factorial(u - s - 1) / math.factorial(u) for s in range(u)]


def _leaf_tables(z: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """Shapley values by leaf, pattern and path feature, of leaves with as many path features (a row of ``z`` a leaf).

    The sum over subsets S of one size is a coefficient of Π_p (z_p + o_p·t), the
    product over the other features, built up for all patterns and leaves at once."""
    n, u = z.shape
    o = ((np.arange(2 ** u)[:, None] >> np.arange(u)) & 1).astype(float)
    table, weights = np.zeros((n, 2 ** u, u)), np.array(_weights(u))
    for i in range(u):
        poly = np.ones((n, 2 ** u, 1))
        for p in range(u):
            if p != i:
                grown = np.zeros((n, 2 ** u, poly.shape[2] + 1))
                grown[:, :, :-1] = poly * z[:, p, None, None]
                grown[:, :, 1:] += poly * o[:, [p]]
                poly = grown
        table[:, :, i] = worth[:, None] * (o[:, i] - z[:, [i]]) * (poly @ weights)
    return table


def _leaf_table(z: np.ndarray, worth: float) -> np.ndarray:
    """Shapley values of a leaf by pattern (row) and path feature (column)."""
    return _leaf_tables(np.asarray(z, float)[None], np.array([worth]))[0]


def _mllib_leaves(model):
    trees = getattr(model, "trees", None) or [model]
    weights = list(getattr(model, "treeWeights", [1.0] * len(trees)))
    if type(model).__name__.startswith("RandomForest"):
        weights = [1.0 / len(trees)] * len(trees)
    for t, w in zip(trees, weights):
        root = t._java_obj.rootNode()
        leaves = []
        _walk(root, [], leaves, float(root.impurityStats().count()))
        yield w, leaves


def _weighted_leaves(model) -> list:
    return list(model.leaves() if hasattr(model, "leaves") else _mllib_leaves(model))


def _tabled(trees: list) -> list:
    """(path features, conditions by feature, table) of every leaf of the weighted trees."""
    found, alike = [], {}
    for w, leaves in trees:
        for value, path, _ in leaves:
            conds, z = {}, {}
            for f, c, go_left, r in path:
                conds.setdefault(f, []).append((c, go_left))
                z[f] = z.get(f, 1.0) * r
            feats = sorted(conds)
            alike.setdefault(len(feats), []).append(len(found))
            found.append([feats, conds, ([z[f] for f in feats], w * value)])
    for u, own in alike.items():
        step = max(1, TABLE_CELLS // (u * 2 ** u or 1))
        for i in range(0, len(own), step):
            some = own[i:i + step]
            tables = _leaf_tables(np.array([found[k][2][0] for k in some]).reshape(len(some), u), np.array([found[k][2][1] for k in some]))
            for k, table in zip(some, tables):
                found[k][2] = table
    return [tuple(x) for x in found]


def _base(trees: list) -> float:
    return sum(w * value * frac for w, leaves in trees for value, _, frac in leaves)


def extract(model) -> dict:
    """Leaf tables of a fitted GBT/forest/tree regression model or ``BoostedTrees`` (driver side)."""
    trees = _weighted_leaves(model)
    return {"leaves": _tabled(trees), "base": _base(trees)}


def _satisfies(x: np.ndarray, conds, f: int, known: dict) -> np.ndarray:
    """Whether the rows satisfy all conditions on feature ``f``; ``known``: what was found of a condition before."""
    ok = None
    for c, go_left in conds:
        left = known.get((f, c))
        if left is None:
            kind, arg = c
            left = known[f, c] = (x <= arg) if kind == "le" else np.isin(x, list(arg))
        left = left if go_left else ~left
        ok = left if ok is None else ok & left
    return ok


def shap_values(X: np.ndarray, tables: dict) -> np.ndarray:
    return _add_values(np.zeros_like(X, dtype=float), X, tables["leaves"])


def _add_values(phi: np.ndarray, X: np.ndarray, leaves: list) -> np.ndarray:
    known: dict = {}
    for feats, conds, table in leaves:
        if not feats:
            continue
        pat = np.zeros(len(X), dtype=np.int64)
        for p, f in enumerate(feats):
            pat += _satisfies(X[:, f], conds[f], f, known).astype(np.int64) << p
        phi[:, feats] += table[pat]
    return phi


def tree_shap(df: DataFrame, model, features_col: str = "features", key: str = "id") -> DataFrame:
    """(key, base_value, shap array<double>) per row."""
    trees = _weighted_leaves(model)
    base = float(_base(trees))
    cells = sum(2 ** len({f for f, _, _, _ in path}) * len(path) for _, leaves in trees for _, path, _ in leaves)
    kept = zlib.compress(pickle.dumps(trees, 5), 1)
    step = len(trees) if cells <= KEPT_CELLS else max(1, len(trees) * KEPT_CELLS // (16 * cells))

    def fn(batches):
        own, made = pickle.loads(zlib.decompress(kept)), {}
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.vstack(pdf["__x"].to_numpy())
            phi = np.zeros_like(X, dtype=float)
            for i in range(0, len(own), step):  # the tables of many trees are made anew for every batch, a few trees at a time
                leaves = made.get(i) or _tabled(own[i:i + step])
                if step == len(own):
                    made[i] = leaves
                _add_values(phi, X, leaves)
            yield pd.DataFrame({key: pdf[key], "base_value": base, "shap": list(phi)})

    kt = df.schema[key].dataType.simpleString()
    return df.select(key, vector_to_array(features_col).alias("__x")) \
        .mapInPandas(fn, f"{key} {kt}, base_value double, shap array<double>")
