"""Searches, kernels, stacks, importances and the two-model chain against row-level computations."""

import hashlib
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from hearth.operators import ensemble as E
from hearth.operators import explain as X
from hearth.operators import fitted as FM
from hearth.operators import kernel as KR
from hearth.operators import search as S
from hearth.operators import two_model as TM
from hearth.operators.folds import assign_folds
from hearth.operators.ranks import balanced_folds, with_rank
from hearth.operators.trees import categorical_view_stages
from hearth.session import scratch_path, written

NUM, CAT = ["a", "b"], ["c"]


def table(n=400):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=n), rng.uniform(0, 3, n)
    c = rng.choice(["x", "y", "z", None], n)
    y = 1.5 + 0.8 * a + np.sin(2 * b) + np.where(c == "y", 0.7, 0.0) + rng.normal(0, 0.1, n)
    return [(k, None if k % 29 == 0 else float(a[k]), float(b[k]), c[k], float(y[k])) for k in range(n)]


@pytest.fixture(scope="module")
def train(spark):
    df = assign_folds(spark.createDataFrame(table(), "id long, a double, b double, c string, y double"), 3, 1)
    return S.Training(written(df, "search-test"), NUM, CAT, 3, features=24)


def pdf_of(train):
    return train.df.toPandas().sort_values("id").reset_index(drop=True)


def score(train, model):
    p = model.transform(train.df).select("id", "prediction").toPandas().sort_values("id")
    return p["prediction"].to_numpy()


def test_points_run_over_the_whole_grid():
    assert S.points({}) == [{}]
    assert S.points({"a": [1, 2], "b": [3, 4]}) == [{"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]
    assert {name: len(S.points(g)) for name, g in S.FULL.items()} == {
        "LinearRegression": 1, "Ridge": 6, "Lasso": 6, "ElasticNet": 25, "RandomForest": 12, "GBT_TargetEncoded": 27,
        "GBT_Ordinal": 18, "GBT_Categorical": 27, "SVR_RBF": 36, "KernelRidge_RBF": 16}


def test_best_point_puts_non_finite_scores_last():
    rows = [({"a": 1}, 0, math.nan), ({"a": 1}, 1, 0.0), ({"a": 2}, 0, 4.0), ({"a": 2}, 1, 4.0), ({"a": 3}, 0, 4.0), ({"a": 3}, 1, 4.0)]
    assert S.best_point(rows, [{"a": 1}, {"a": 2}, {"a": 3}]) == ({"a": 2}, 2.0)
    assert S.finite_rmse([math.nan, None]) == (math.inf, pytest.approx(math.nan, nan_ok=True))


def test_linear_search_refits_and_predicts(train):
    r = train.search("Ridge", {"alpha": [0.1, 1000.0]})
    assert r.params == {"alpha": 0.1} and math.isnan(r.std)
    p = pdf_of(train)
    x = KR.matrix(KR.view_of(train.linear, None), p)
    z = np.column_stack([np.ones(len(x)), x])
    want = z @ np.linalg.solve(z.T @ z + np.diag([0.0] + [0.1] * x.shape[1]), z.T @ p["y"])
    assert score(train, r.model) == pytest.approx(want, abs=1e-6)
    j = 1
    x = KR.matrix(KR.view_of(train.linear, j), p)
    z, own = np.column_stack([np.ones(len(x)), x]), (p["fold"] != j).to_numpy()
    w = np.linalg.solve(z[own].T @ z[own] + np.diag([0.0] + [0.1] * x.shape[1]), z[own].T @ p["y"][own])
    mse = dict(((q, k), m) for q, k, m in r.rows)[json.dumps({"alpha": 0.1}), j]
    assert mse == pytest.approx(np.mean((p["y"][~own] - z[~own] @ w) ** 2), rel=1e-6)
    assert score(train, r.by_fold(j)) == pytest.approx(z @ w, abs=1e-6)


def test_kernel_ridge_equals_row_level_ridge(train):
    r = train.search("KernelRidge_RBF", {"alpha": [0.1, 1.0], "gamma": [0.05, 0.2]})
    p = pdf_of(train)
    for q, j, m in r.rows:
        q = json.loads(q)
        z = KR.FourierMap(q["gamma"], 24, 42).of(KR.matrix(KR.view_of(train.linear, j), p))
        own = (p["fold"] != j).to_numpy()
        w = np.linalg.solve(z[own].T @ z[own] + q["alpha"] * np.eye(24), z[own].T @ p["y"][own])
        assert m == pytest.approx(np.mean((p["y"][~own] - z[~own] @ w) ** 2), rel=1e-6)
    z = KR.FourierMap(r.params["gamma"], 24, 42).of(KR.matrix(KR.view_of(train.linear, None), p))
    w = np.linalg.solve(z.T @ z + r.params["alpha"] * np.eye(24), z.T @ p["y"])
    assert score(train, r.model) == pytest.approx(z @ w, abs=1e-6)


def test_random_features_approach_the_kernel():
    x = np.random.default_rng(0).normal(size=(30, 4))
    z = KR.FourierMap(0.1, 20000, 3).of(x)
    want = np.exp(-0.1 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert z @ z.T == pytest.approx(want, abs=0.05)


@pytest.mark.parametrize("c, eps", [(1.0, 0.05), (10.0, 0.2)])
def test_svr_meets_the_subgradient_conditions(train, c, eps):
    """w = C Σ s_i z_i and Σ s_i = 0 for subgradients s_i: ±1 outside the tube, 0 inside, between on its edge."""
    view, fmap = KR.view_of(train.linear, None), KR.FourierMap(0.2, 24, 42)
    (t, _, _, w, b, _), = KR.svr_solve(train.df, {KR.ALL: view}, fmap, [(c, eps)])
    p = pdf_of(train)
    z = fmap.of(KR.matrix(view, p))
    r = (p["y"] - z @ w - b).to_numpy()
    edge = 12 * KR.WIDTHS[-1] * eps
    fixed = np.where(np.abs(r) > eps + edge, np.sign(r), 0.0)
    free = (np.abs(r) > eps - edge) & (np.abs(r) <= eps + edge)
    z1 = np.column_stack([z, np.ones(len(z))])
    want = np.append(w, 0.0) / c - z1.T @ fixed
    side = np.sign(r[free])
    from_edge = z1[free] * side[:, None]  # s_i = side * u_i with 0 <= u_i <= 1
    u, _, _, _ = np.linalg.lstsq(np.vstack([from_edge.T, 1e-6 * np.eye(free.sum())]),
                                 np.append(want, 1e-6 * 0.5 * np.ones(free.sum())), rcond=None)
    def objective(v):
        res = np.abs(p["y"].to_numpy() - z @ v[:-1] - v[-1])
        return 0.5 * v[:-1] @ v[:-1] + c * np.maximum(res - eps, 0).sum()
    best = objective(np.append(w, b))
    rng = np.random.default_rng(1)
    for scale in (1e-3, 1e-2, 1e-1):  # no direction lowers the objective beyond the smoothing
        for _ in range(200):
            assert objective(np.append(w, b) + scale * rng.normal(size=25)) >= best - c * len(r) * KR.WIDTHS[-1] * eps * math.log(2)
    assert np.abs(from_edge.T @ np.clip(u, 0, 1) - want).max() < 0.05 * len(r) ** 0.5


def test_fold_problems_start_from_the_solution_of_all_rows(spark, monkeypatch):
    df = assign_folds(spark.createDataFrame(table(20000), "id long, a double, b double, c string, y double"), 3, 1)
    train = S.Training(written(df, "search-large"), NUM, CAT, 3, features=24)
    views = {t: KR.view_of(train.linear, None if t == KR.ALL else t) for t in (KR.ALL, 0, 1, 2)}
    fmap, collect, open_ = KR.FourierMap(0.2, 24, 42), KR._collect, []

    def counted(parts, names):
        found = collect(parts, names)
        open_.append(len(found))
        return found
    monkeypatch.setattr(KR, "_collect", counted)
    got = KR.svr_solve(train.df, views, fmap, [(5.0, 0.05)])
    warm = sum(open_)
    open_.clear()
    cold = [KR.svr_solve(train.df, {t: view}, fmap, [(5.0, 0.05)])[0] for t, view in views.items()]
    assert warm < sum(open_)
    assert [r[:3] for r in got] == [r[:3] for r in cold]
    for g, c in zip(got, cold):
        assert g[3] == pytest.approx(c[3], abs=1e-3) and g[4] == pytest.approx(c[4], abs=1e-3)
        assert g[5] == pytest.approx(c[5], rel=1e-4)


def test_cosine_of_turns_equals_the_cosine():
    u = np.concatenate([np.linspace(-3, 3, 10001), [1e6 + 0.3, -0.25, 0.5, np.nan, np.inf]])
    got = u.copy()
    KR._cos_of_turns(got)
    want = np.cos(2 * math.pi * (u - np.rint(u)))
    assert np.allclose(got, want, rtol=0, atol=1e-14, equal_nan=True)


def test_svr_search_scores_held_out_rows(train):
    r = train.search("SVR_RBF", {"C": [1.0, 5.0], "gamma": ["scale"], "epsilon": [0.05]})
    p = pdf_of(train)
    j = 2
    guess = score(train, r.by_fold(j))
    held = (p["fold"] == j).to_numpy()
    mse = {(q, k): m for q, k, m in r.rows}[json.dumps(r.params), j]
    assert mse == pytest.approx(np.mean((p["y"][held] - guess[held]) ** 2), rel=1e-6)
    assert r.score < p["y"].std()


def test_sums_in_two_levels(spark):
    parts = spark.range(5000, numPartitions=150).select((F.col("id") % 2).cast("int").alias("k"), F.lit(0).alias("block"),
                                                        F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    got = {r.k: r.v.toArray().tolist() for r in KR.sum_blocks(parts, ["k", "block"]).collect()}
    assert got == {0: pytest.approx([sum(range(0, 5000, 2)), 2500.0]), 1: pytest.approx([sum(range(1, 5000, 2)), 2500.0])}


def test_boosting_grid_equals_fits_of_their_own(train):
    r = train.search("GBT_Categorical", {"rounds": [2, 5], "rate": [0.3], "max_depth": [2]})
    j = 0
    own, held = train.df.filter(F.col("fold") != j), train.df.filter(F.col("fold") == j)
    pre = Pipeline(stages=categorical_view_stages(NUM, CAT)).fit(own)
    for rounds in (2, 5):
        rows = pre.transform(own).select("y", "features").coalesce(1)
        m = GBTRegressor(featuresCol="features", labelCol="y", maxIter=rounds, stepSize=0.3, maxDepth=2, seed=42, maxBins=64).fit(rows)
        mse = m.transform(pre.transform(held)).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
        got = {(q, k): e for q, k, e in r.rows}[json.dumps({"rounds": rounds, "rate": 0.3, "max_depth": 2}), j]
        assert got == pytest.approx(mse, rel=1e-9)
    assert r.params["rounds"] == 5 and r.model.stages[-1].getNumTrees == 5


@pytest.mark.parametrize("name, grid", [
    ("RandomForest", {"trees": [4], "max_depth": [None, 30, 2], "min_leaf": [1]}),
    ("GBT_TargetEncoded", {"rounds": [3], "rate": [0.5], "max_depth": [2]}),
    ("GBT_Ordinal", {"rounds": [3], "rate": [0.5], "leaves": [3, 4]})])
def test_tree_searches_beat_the_mean(train, name, grid):
    r = train.search(name, grid)
    p = pdf_of(train)
    assert len(r.rows) == 3 * len(S.points(grid))
    assert r.score < p["y"].std()
    assert score(train, r.model).std() > 0


def test_stack_of_a_tree_and_a_linear_base_equals_a_row_level_stack(train):
    bases = [train.search("Ridge", {"alpha": [1.0]}), train.search("GBT_Ordinal", {"rounds": [3], "rate": [0.5], "leaves": [4]})]
    r = train.stack(bases, 10.0, candidates={"Ridge", "GBT_Ordinal"})
    p = pdf_of(train)
    oof = np.zeros((len(p), 2))
    for j in range(3):
        held = (p["fold"] == j).to_numpy()
        for i, b in enumerate(bases):
            oof[held, i] = score(train, b.by_fold(j))[held]
    y = p["y"].to_numpy()

    def meta(rows):
        m, ybar = oof[rows].mean(0), y[rows].mean()
        w = np.linalg.solve((oof[rows] - m).T @ (oof[rows] - m) + 10 * np.eye(2), (oof[rows] - m).T @ (y[rows] - ybar))
        return w, ybar - w @ m
    w, b0 = meta(np.ones(len(p), bool))
    assert r.model.stages[0].weights_ == pytest.approx(list(w), abs=1e-6)
    full = np.column_stack([score(train, b.model) for b in bases])
    assert score(train, r.model) == pytest.approx(full @ w + b0, abs=1e-6)
    errors = []
    for j in range(3):
        held = (p["fold"] == j).to_numpy()
        w, b0 = meta(~held)
        errors.append(math.sqrt(np.mean((y[held] - oof[held] @ w - b0) ** 2)))
    assert r.score == pytest.approx(np.mean(errors), rel=1e-6) and r.std == pytest.approx(np.std(errors), rel=1e-4)
    with pytest.raises(ValueError):
        train.stack(bases[:1], candidates={"Ridge"})


def test_store_orders_blends_and_reloads(spark, train):
    results = [train.search("Ridge", {"alpha": [1.0]}), train.search("Lasso", {"alpha": [0.01]}),
               train.search("LinearRegression", {}), train.search("KernelRidge_RBF", {"alpha": [1.0], "gamma": [0.05]})]
    results[2].score = math.inf  # sorts last and takes no part in a blend
    store = S.ModelStore(spark)
    store.add(results)
    store.add(results[:1])  # already there
    rows = store.comparison().collect()
    scores = [r.cv_rmsle_mean for r in rows]
    assert len(rows) == 4 and scores == sorted(scores) and rows[-1].model == "LinearRegression"
    assert json.loads([r for r in rows if r.model == "Ridge"][0].best_params) == {"alpha": 1.0}
    again = S.ModelStore(spark, store.path)
    assert again.best()[0]["model"] == rows[0].model
    for r in results:
        assert score(train, again.load(r.name)) == pytest.approx(score(train, r.model), abs=1e-12)
    inverse = {r.model: 1 / r.cv_rmsle_mean for r in rows[:3]}
    want = sum(w / sum(inverse.values()) * score(train, next(r.model for r in results if r.name == n)) for n, w in inverse.items())
    assert score(train, again.blend(3)) == pytest.approx(want, abs=1e-9)
    with pytest.raises(KeyError):
        again.load("none")


def test_permutation_importance_equals_brute_force(spark, train):
    model = train.search("GBT_Ordinal", {"rounds": [3], "rate": [0.5], "leaves": [4]}).model
    got = X.permutation_importance(model, train.df, NUM + CAT, repeats=3, seed=9).collect()
    p = pdf_of(train)
    h = lambda k: int(hashlib.md5(f"{k}:permute9".encode()).hexdigest()[:8], 16)
    order = sorted(p["id"], key=lambda k: (h(k), k))
    place = {k: i for i, k in enumerate(order)}
    rows = p.set_index("id")
    base = np.mean((p["y"] - score(train, model)) ** 2)
    want = {}
    for c in NUM + CAT:
        rises = []
        for s in X.donor_shifts(len(p), 3, 9):
            donor = [order[(place[k] + s) % len(p)] for k in p["id"]]
            assert sorted(donor) == sorted(p["id"]) and all(d != k for d, k in zip(donor, p["id"]))
            q = p.copy()
            q[c] = rows.loc[donor, c].to_numpy()
            q = q.astype(object).where(q.notna(), None)
            df = spark.createDataFrame([tuple(r) for r in q[["id", "a", "b", "c", "y"]].to_numpy()], "id long, a double, b double, c string, y double")
            rises.append(model.transform(df).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0] - base)
        want[c] = (np.mean(rises), np.std(rises))
    assert {r.feature: (r.importance, r.std) for r in got} == {c: (pytest.approx(m, abs=1e-9), pytest.approx(s, abs=1e-9)) for c, (m, s) in want.items()}
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)


def test_ranks_and_balanced_folds(spark):
    df = spark.range(1003).withColumn("v", (F.col("id") * 37) % 11)
    ranked = {r.id: r.rank for r in with_rank(df, "v", "id").collect()}
    order = sorted(range(1003), key=lambda k: (k * 37 % 11, k))
    assert [ranked[k] for k in order] == list(range(1003))
    sizes = [r["count"] for r in balanced_folds(df, 5, 42).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert with_rank(df.limit(0), "id").count() == 0


@pytest.fixture(scope="module")
def priced(spark):
    rows = [(k, a, b, c, math.exp(y)) for k, a, b, c, y in table()] + [(9999, 1.0, 1.0, "x", None)]
    return spark.createDataFrame(rows, "id long, a double, b double, c string, price double")


def test_two_model_chain(spark, priced):
    cfg = TM.TrainConfig(folds=3, rounds=4, depth=2, rate=0.5)
    m = TM.fit_two_models(priced, NUM, CAT, "price", cfg)
    k = m.metrics
    assert k["cv_rmsle_blend"] <= min(k["cv_rmsle_linear"], k["cv_rmsle_catboost"]) + 1e-12
    assert (k["cv_folds"], k["n_numeric_features"], k["n_categorical_features"]) == (3, 2, 1)
    again = TM.TwoModels.load(spark, m.save(scratch_path(spark, "two-test")))
    assert again.metrics == k and again.target == "log1p"
    a, b = (pd.DataFrame([tuple(r) for r in x.predict(priced).select("id", "price").collect()]).sort_values(0) for x in (m, again))
    assert np.array_equal(a.to_numpy(), b.to_numpy())
    lin, tree = m.branches.each(priced).select("id", "b0", "b1"), m.branches.weights_
    want = {r.id: math.expm1(tree[0] * r.b0 + tree[1] * r.b1) for r in lin.collect()}
    assert dict(a.itertuples(index=False)) == {i: pytest.approx(v, rel=1e-9) for i, v in want.items()}


def test_two_model_net_is_searched_inside_every_fold(spark, priced):
    """The out-of-fold error of the linear branch equals that of explicit searches on the rows outside each fold."""
    cfg = TM.TrainConfig(folds=3, rounds=1, depth=1, alphas=(0.001, 0.5), l1_ratios=(0.5,))
    m = TM.fit_two_models(priced, NUM, CAT, "price", cfg)
    from hearth.operators.folds import assign_inner_folds
    from hearth.operators.gram import LinearCV, LinearSpec
    rows = assign_inner_folds(assign_folds(priced.filter("price is not null").withColumn("y", F.log1p("price")), 3, 42), 3, 42)
    cv = LinearCV(rows, NUM, CAT, "y", "fold", 3, inner_col="inner", k_inner=3)
    total, n = 0.0, 0
    for j in range(3):
        specs = [LinearSpec("elasticnet", a, 0.5) for a in cfg.alphas]
        best = min(specs, key=lambda s: cv.inner_errors(s, j))
        held = FM.LinearFormula.of(cv, best, j).transform(rows.filter(F.col("fold") == j))
        r = held.agg(F.sum((F.col("y") - F.col("prediction")) ** 2).alias("s"), F.count("*").alias("n")).first()
        total, n = total + r.s, n + r.n
    assert m.metrics["cv_rmsle_linear"] == pytest.approx(math.sqrt(total / n), rel=1e-6)


def test_linear_formula_in_sql(duck, priced):
    """A saved linear branch is the sum that SQL computes from its state."""
    df = assign_folds(priced.filter("price is not null").withColumn("y", F.log1p("price")), 3, 42)
    from hearth.operators.gram import LinearCV, LinearSpec
    f = FM.LinearFormula.of(LinearCV(df, NUM, CAT, "y", "fold", 3), LinearSpec("ridge", 1.0))
    s = f.s
    rows = df.select("id", *NUM, *CAT).toPandas()
    terms = [repr(s["intercept"])] + [f"(coalesce({c}, {m!r}) - {mean!r}) * {w / sd!r}" for c, w, m, mean, sd in s["numeric"]]
    terms += [f"CASE coalesce(c, '{v['mode']}') {' '.join(f'''WHEN '{x}' THEN {w!r}''' for x, w in v['weights'].items())} ELSE 0 END"
              for v in s["categorical"].values()]
    duck.register("two_rows", rows.astype(object).where(rows.notna(), None).astype({"a": float, "b": float, "id": int}))
    want = dict(duck.execute(f"SELECT id, {' + '.join(terms)} FROM (SELECT id, CASE WHEN isnan(a) THEN NULL ELSE a END AS a, b, c FROM two_rows)").fetchall())
    got = {r.id: r.prediction for r in f.transform(df).collect()}
    assert got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}


def test_branches_load_inside_a_pipeline(spark, train):
    r = train.search("Ridge", {"alpha": [1.0]})
    both = FM.Branches([r.model, r.by_fold(0)], [0.25, 0.75], 1.0)
    path = FM.save(both, scratch_path(spark, "branches"))
    again = FM.load(path)
    assert isinstance(again, PipelineModel)
    assert score(train, again) == pytest.approx(1.0 + 0.25 * score(train, r.model) + 0.75 * score(train, r.by_fold(0)), abs=1e-9)
    assert again.transform(train.df).columns == [*train.df.columns, "prediction"]


def test_medians_by_digits(spark):
    """Continuous, whole, tied, negative, tiny, infinite and absent values; all rows and all rows but each fold."""
    from hearth.operators.selection import exact_medians_by_set
    rng = np.random.default_rng(2)
    n = 3001
    cols = {"u": rng.uniform(-1, 1, n), "big": np.round(rng.normal(0, 1e6, n)), "ties": rng.integers(0, 3, n) * 1.0,
            "tiny": rng.normal(size=n) * 1e-300, "mixed": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
            "one": np.where(np.arange(n) == 7, 2.5, np.nan), "none": np.full(n, np.nan),
            "inf": np.where(np.arange(n) % 3 == 0, np.inf, -0.0)}
    p = pd.DataFrame(cols).assign(fold=rng.integers(0, 3, n))
    df = spark.createDataFrame(p.astype(object).where(p.notna(), None), ", ".join(f"{c} double" for c in cols) + ", fold int").repartition(6)
    got = exact_medians_by_set(df, list(cols), "fold", 3)
    for t in (-1, 0, 1, 2):
        rows = p if t == -1 else p[p["fold"] != t]
        for c in cols:
            x = rows[c].dropna().to_numpy()
            want = None if not len(x) else float(np.median(x))
            assert got[t][c] == want, (t, c)


def test_encoders_of_a_million_levels(spark):
    """Levels beyond the literal limit become a table: same values, saved and reloaded, nulls and unknown levels too."""
    from hearth.operators import transformers as T
    from hearth.operators.levels import LevelTableModel
    n = 1_000_000
    df = spark.range(n).select("id", F.concat(F.lit("u"), F.col("id")).alias("u"),
                               F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("v"),
                               (F.col("id") % 10).cast("double").alias("y"))
    ordinal = T.OrdinalEncoder(["u", "v"]).fit(df)
    assert isinstance(ordinal, LevelTableModel)
    again = FM.load(FM.save(ordinal, scratch_path(spark, "ordinal")))
    rows = spark.createDataFrame([(1, "u0", "hot"), (2, "u999999", "k6"), (3, None, None), (4, "new", "k0")], "id long, u string, v string")
    got = {r.id: (r.u_ord, r.v_ord) for r in again.transform(rows).collect()}
    assert got == {1: (0.0, 0.0), 2: (float(n - 1), 7.0), 3: (-1.0, -1.0), 4: (-1.0, 1.0)}
    few = df.filter("id < 3000")
    wide = T.TargetEncoder(["u", "v"], "y", literal_levels=100).fit(few)
    literal = T.TargetEncoder(["u", "v"], "y", literal_levels=10**6).fit(few)
    assert isinstance(wide, LevelTableModel) and not isinstance(literal, LevelTableModel)
    a, b = ({r.id: (r.u_te, r.v_te) for r in m.transform(rows).collect()} for m in (wide, literal))
    assert a == {k: pytest.approx(v) for k, v in b.items()}


@pytest.mark.parametrize("fold", [None, 1])
@pytest.mark.parametrize("view", ["onehot", "ordinal", "categorical", "target"])
def test_tree_views_from_shared_statistics_equal_fitted_ones(train, view, fold):
    """Two categories of unlike level counts, gaps in both."""
    df = train.df.withColumns({"d": F.when(F.col("id") % 7 > 1, F.concat(F.lit("l"), (F.col("id") % 7).cast("string")))})
    one = S.Training(df, NUM, [*CAT, "d"], 3)
    two = S.Training(df, NUM, [*CAT, "d"], 3)
    two.few_levels = False  # every stage is fitted on the rows
    shown = []
    for t in (one, two):
        rows, pre = t._prepared(view, fold)
        new = pre.transform(t.df).select("id", F.col("features").cast("string").alias("held"))
        both = rows.select("id", F.col("features").cast("string").alias("own")).join(new, "id")
        shown.append((sorted(map(tuple, both.collect())), rows.schema["features"].metadata))
    assert shown[0] == shown[1]


def test_stack_sums_give_the_same_meta_model(train):
    df = train.df.select("fold", "y", (F.col("y") * 0.9 + 0.1).alias("p"), F.coalesce("a", F.lit(0.0)).alias("q"))
    cells = E.fold_moments(df, "y", ["p", "q"], "fold", 3, 1.5)
    for j in range(3):
        b0, w = E.ridge_meta(df.filter(F.col("fold") != j), "y", ["p", "q"], 10.0)
        c0, v = E.meta_of(sum(cells.values()) - cells[j], 10.0)
        assert np.allclose([b0, *w], [c0 + 1.5 * (1 - sum(v)), *v], atol=1e-9)


def passes_of(monkeypatch):
    passes, collect = [], KR._collect
    monkeypatch.setattr(KR, "_collect", lambda *a: passes.append(1) or collect(*a))
    return passes


def test_feature_ridge_takes_one_pass_and_equals_mllib(train, monkeypatch):
    from hearth.operators import trees as TR
    passes = passes_of(monkeypatch)
    found = KR.fold_rmse(train.df, train.linear, 0.001, KR.FourierMap(0.01, 64, 42))
    expected = TR.fold_rmse(train.df, lambda: TR._RFFPipeline(NUM, CAT, "squaredError", 0.001, 0.01, 64, 0), 3)
    assert [j for j, _ in found] == [0, 1, 2] and len(passes) == 1
    assert np.allclose([r for _, r in found], [r for _, r in expected], rtol=1e-7)


def test_huber_folds_share_their_passes(train, monkeypatch):
    passes = passes_of(monkeypatch)
    found = KR.fold_rmse(train.df, train.linear, 0.001, KR.FourierMap(0.01, 64, 42), "huber")
    assert [j for j, _ in found] == [0, 1, 2] and 2 <= len(passes) <= 40
    assert all(r < 0.6 for _, r in found)  # MLlib stops on this table before its minimum


def test_huber_solution_has_no_slope(train):
    views = {j: KR.view_of(train.linear, j) for j in range(3)}
    fmap = KR.FourierMap(0.05, 16, 1)
    found = KR.huber_solve(train.df, views, fmap, 0.01, {j: np.append(np.zeros(17), 1.0) for j in views})
    pdf = pdf_of(train)
    for j, p in found.items():
        own = pdf[pdf["fold"] != j]
        z1 = np.column_stack([fmap.of(KR.matrix(views[j], own)), np.ones(len(own))])
        loss = lambda q: KR._huber_sums(z1, own["y"].to_numpy(), q)[1] / len(own) + 0.005 * (q[:16] ** 2).sum()
        slopes = [(loss(p + 1e-5 * e) - loss(p - 1e-5 * e)) / 2e-5 for e in np.eye(18)]
        assert np.abs(slopes).max() < 1e-6


def test_forest_grid_equals_fits_of_their_own_depth(train, monkeypatch):
    asked, regressor = [], S.regressor
    monkeypatch.setattr(S, "regressor", lambda *a: asked.append(a[1]) or regressor(*a))
    grid = {"trees": [5], "max_depth": [1, 3, 6], "min_leaf": [1, 4]}
    found = train.search("RandomForest", grid)
    errors = {(p, j): m for p, j, m in found.rows}
    assert len(errors) == 6 * 3 and len(asked) == 2 * 3 + 1  # the deepest forest a fold and leaf size, and the refit
    for j in range(3):
        rows, pre = train._prepared("onehot", j)
        held = pre.transform(train.df.filter(F.col("fold") == j))
        for p in S.points(grid):
            alone = regressor("RandomForest", S._fit_key("RandomForest", p), None, train.seed, rows).fit(train._kept(rows))
            mse = alone.transform(held).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
            assert abs(errors[S.as_json(p), j] - mse) < 1e-9


def test_trees_of_a_small_forest_are_those_of_mllib(train):
    """Fully grown, so that most splits are of a few rows and many are equal; on the rows of a fold and refitted, saved and loaded."""
    grid = {"trees": [30], "max_depth": [None, 4], "min_leaf": [1, 3]}
    found = train.search("RandomForest", grid)
    assert "BoostedTrees" in type(found.model.stages[-1]).__name__  # grown in tasks
    errors = {(p, j): m for p, j, m in found.rows}
    rows, pre = train._prepared("onehot", 1)
    held = pre.transform(train.df.filter(F.col("fold") == 1))
    for p in S.points(grid):
        alone = S.regressor("RandomForest", S._fit_key("RandomForest", p), None, train.seed, rows).fit(train._kept(rows))
        mse = alone.transform(held).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
        assert errors[S.as_json(p), 1] == pytest.approx(mse, rel=1e-9)
    rows, pre = train._prepared("onehot", None)
    alone = S.regressor("RandomForest", S._fit_key("RandomForest", found.params), None, train.seed, rows).fit(train._kept(rows))
    again = FM.load(FM.save(found.model, scratch_path(train.df.sparkSession, "small-forest")))
    assert score(train, again) == pytest.approx(score(train, PipelineModel(stages=[pre, alone])), rel=1e-9)
