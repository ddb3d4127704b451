"""Boosting in shared passes against MLlib's fits, one by one."""

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor

from hearth.operators import boosting as B
from hearth.operators import search as S
from hearth.operators.folds import assign_folds
from hearth.operators.treeshap import extract
from hearth.session import scratch_path, written

NUM, CAT = ["a", "b", "w"], ["c", "d"]


@pytest.fixture(scope="module")
def train(spark):
    """Gaps in numbers and categories, zeros, more values than bins, a level of few rows."""
    rng = np.random.default_rng(3)
    n = 600
    a, b, w = rng.normal(size=n), rng.integers(0, 9, n), np.where(rng.uniform(size=n) < 0.4, 0.0, rng.normal(size=n))
    c, d = rng.choice(["x", "y", "z", None], n), rng.choice(["p", "q"], n)
    y = 12 + 0.8 * a + np.sin(b) + w * (c == "y") + rng.normal(0, 0.1, n)
    rows = [(k, None if k % 29 == 0 else float(a[k]), int(b[k]), float(w[k]), "rare" if k % 40 == 7 else c[k], d[k], float(y[k])) for k in range(n)]
    df = assign_folds(spark.createDataFrame(rows, "id long, a double, b long, w double, c string, d string, y double"), 3, 1)
    return S.Training(written(df, "boosting-test"), NUM, CAT, 3)


@pytest.mark.parametrize("name, point", [("GBT_Categorical", {"rounds": 6, "rate": 0.3, "max_depth": 3}),
                                         ("GBT_Ordinal", {"rounds": 6, "rate": 0.3, "leaves": 7}),
                                         ("GBT_TargetEncoded", {"rounds": 6, "rate": 0.3, "max_depth": 3})])
def test_models_equal_those_of_mllib(train, name, point):
    grown = train.tree_models(name, point)
    for fold in (None, 1):
        rows, pre = train._prepared(S.TREE_VIEWS[name], fold)
        rows = rows.select("y", "features").coalesce(1)
        own = PipelineModel(stages=[pre, GBTRegressor(featuresCol="features", labelCol="y", maxIter=6, stepSize=0.3, maxDepth=3, seed=42, maxBins=64).fit(rows)])
        a, b = (dict(m.transform(train.df).select("id", "prediction").collect()) for m in (own, grown[fold]))
        assert b == {i: pytest.approx(v, rel=1e-9) for i, v in a.items()}
        x, y = extract(own.stages[-1]), extract(grown[fold].stages[-1])
        assert y["base"] == pytest.approx(x["base"], rel=1e-9)
    path = scratch_path(train.df.sparkSession, "boosted")
    grown[1].write().save(path)
    again = dict(PipelineModel.load(path).transform(train.df).select("id", "prediction").collect())
    assert again == b


def test_points_and_folds_share_their_passes(train, monkeypatch):
    train.linear
    passes, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda rdd: passes.append(1) or collect(rdd))
    r = train.search("GBT_Ordinal", {"rounds": [2, 4], "rate": [0.1, 0.3], "leaves": [4]})
    assert len(r.rows) == 4 * 3
    assert len(passes) <= 4 * 2 + 1  # levels of one model, and the last scores; 6 folds' fits and a refit before


def test_passes_of_few_cells_give_the_same_trees(train, monkeypatch):
    point = {"rounds": 3, "rate": 0.3, "max_depth": 3}
    a = train.tree_models("GBT_Categorical", point)[0].stages[-1].s
    monkeypatch.setattr(B, "PASS_CELLS", 1)
    monkeypatch.setattr(B, "JOBS_AT_ONCE", 2)
    b = train.tree_models("GBT_Categorical", point)[0].stages[-1].s
    assert a == b


def test_thresholds_come_from_the_rows_that_mllib_draws(spark):
    rng = np.random.default_rng(4)
    n = 16_000  # more than MLlib looks at, outside a fold too
    a, b = rng.normal(size=n), rng.normal(size=n)
    rows = [(k, float(a[k]), float(b[k]), "x" if k % 3 else "y", float(a[k] + np.sin(3 * b[k]))) for k in range(n)]
    df = assign_folds(spark.createDataFrame(rows, "id long, a double, b double, c string, y double").coalesce(1), 3, 1)
    train = S.Training(written(df, "boosting-drawn"), ["a", "b"], ["c"], 3)
    grown = train.tree_models("GBT_Ordinal", {"rounds": 1, "rate": 0.3, "leaves": 15})
    for fold in (None, 2):
        rows, pre = train._prepared("ordinal", fold)
        rows = rows.select("y", "features").coalesce(1)
        own = GBTRegressor(featuresCol="features", labelCol="y", maxIter=1, maxDepth=4, seed=42, maxBins=64).fit(rows)
        want, got = extract(own), extract(grown[fold].stages[-1])
        assert [x[1] for x in got["leaves"]] == [x[1] for x in want["leaves"]]  # the conditions on the way to every leaf


def test_joint_codes_hold_every_feature():
    """Features share codes, and their sums and tables are those of the single features."""
    rng = np.random.default_rng(5)
    coding = B.Coding({"a": np.arange(900.0), "b": np.arange(7.0)}, {"c": ["x", "y"], "d": list("pqrst")})
    layout = B.Layout.of(coding)
    assert sorted(f for g in layout.groups for f in g) == [0, 1, 2, 3] and len(layout.groups) == 2
    codes, r = np.array([rng.integers(0, s, 500) for s in layout.sizes]), rng.normal(size=500)
    joint = []
    for group in layout.groups:
        at = np.zeros(500, np.int64)
        for f in group:
            at = at * layout.sizes[f] + codes[f]
        joint.append(at)
    sums = layout.by_feature([np.bincount(at, weights=r, minlength=n)[None] for at, n in zip(joint, layout.joint_sizes)])
    for f, size in enumerate(layout.sizes):
        assert np.allclose(sums[f][0], np.bincount(codes[f], weights=r, minlength=size), atol=1e-12)
        table = rng.integers(0, 9, size)
        g, spread = layout.spread(f, table)
        assert (spread[joint[g]] == table[codes[f]]).all()


def test_siblings_from_their_parent(train, monkeypatch):
    """Of two children the one with fewer rows is added up; the trees are those of both added up."""
    rng = np.random.default_rng(6)
    count = rng.integers(0, 3, (4, 9)).astype(float)
    full = np.stack([count, np.where(count > 0, rng.normal(size=(4, 9)), 0.0)])
    tree = B.Tree([B.Node(1.0, 0.0) for _ in range(3)] + [B.Node(n, 0.0) for n in count.sum(1)], open=[3, 4, 5, 6])
    tree.parents = full[:, ::2] + full[:, 1::2]
    assert len(tree.counted) == 2
    assert np.allclose(tree.all_sums(full[:, [at - 3 for at in tree.counted]]), full, atol=1e-12)

    point = {"rounds": 3, "rate": 0.3, "max_depth": 3}
    some = train.tree_models("GBT_Categorical", point)
    monkeypatch.setattr(B, "KEPT_CELLS", 0)
    every = train.tree_models("GBT_Categorical", point)
    a, b = (dict(m[None].transform(train.df).select("id", "prediction").collect()) for m in (some, every))
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9


@pytest.mark.parametrize("name, point", [("GBT_Categorical", {"rounds": 12, "rate": 0.3, "max_depth": 4}),
                                         ("GBT_Ordinal", {"rounds": 12, "rate": 0.3, "leaves": 31}),
                                         ("GBT_TargetEncoded", {"rounds": 12, "rate": 0.3, "max_depth": 3})])
def test_trees_of_a_task_are_those_of_shared_passes(train, monkeypatch, name, point):
    """Over a checkpoint of the shared passes; errors after every round and the models' predictions."""
    grid = {k: [v] for k, v in point.items()} | {"rounds": [1, 7, 12]}
    apart, found = train.tree_models(name, point), train.search(name, grid)
    monkeypatch.setattr(B, "LOCAL_CELLS", 0)
    shared, again = train.tree_models(name, point), train.search(name, grid)
    assert [r[:2] for r in found.rows] == [r[:2] for r in again.rows]
    assert [r[2] for r in found.rows] == pytest.approx([r[2] for r in again.rows], rel=1e-9)
    for fold in (None, 1):
        a, b = (dict(m[fold].transform(train.df).select("id", "prediction").collect()) for m in (apart, shared))
        assert a == {i: pytest.approx(v, rel=1e-9) for i, v in b.items()}


def test_a_table_that_a_task_holds_takes_one_job_a_search(train, monkeypatch):
    train._coded("ordinal")
    jobs, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda rdd: jobs.append(1) or collect(rdd))
    train.search("GBT_Ordinal", {"rounds": [40], "rate": [0.1, 0.3], "leaves": [8]})
    assert len(jobs) == 2  # the folds' fits and the refit, whatever the rounds


def test_shared_passes_keep_one_checkpoint(train, monkeypatch):
    monkeypatch.setattr(B, "LOCAL_CELLS", 0)
    monkeypatch.setattr(B, "CHECKPOINT_ROUNDS", 1)
    seen, forget = [], B._forget
    monkeypatch.setattr(B, "_forget", lambda spark, paths: seen.append(list(paths)) or forget(spark, paths))
    train.tree_models("GBT_Ordinal", {"rounds": 4, "rate": 0.3, "leaves": 4})
    gone = [p for paths in seen for p in paths]
    assert len(gone) >= 2 and max(map(len, seen)) == 1
    jvm = train.df.sparkSession._jvm
    for p in map(jvm.org.apache.hadoop.fs.Path, gone):
        assert not p.getFileSystem(train.df.sparkSession._jsparkSession.sessionState().newHadoopConf()).exists(p)
