"""Grid × fold search with refit over all model families (survey V1, V2, V5–V7, M2–M12, P15).

A family is a grid of parameters and a way to score all of its points on the same folds; the best point
(root of the mean fold MSE) is refitted on all rows. The default grids are those of the reference's full
mode; its fast mode is ``FAST``. What can be shared is computed once:

* the linear family reads fold statistics only, whatever the grid;
* kernel families make one pass (ridge) or one series of passes (ε-insensitive) per γ for all other parameters;
* tree families take the medians, modes and levels of every training set from the same statistics (categories of many
  levels are fitted once per fold, as tables). Boosted models of all points and training sets grow in the same passes
  (``boosting``; with categories of many levels MLlib fits them one by one), those of a small table a task each; a model grows the most rounds of the grid and
  is scored after every number of rounds in it, which gives the same trees as a fit of its own. Forests run from one
  queue; one is fitted with the largest depth of the grid and scored at every depth in it, as its trees grow level by
  level; depth None is MLlib's largest, 30.
"""

from __future__ import annotations

import json
import math
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property
from itertools import product

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..session import scratch_path, written
from . import boosting
from . import kernel as KR
from . import transformers as T
from .boosting import BoostedTrees, Coding, Job, Slot, boost, grow_apart, thresholds_of
from .ensemble import fold_moments, meta_of
from .fitted import Branches, LinearFormula, load, predictions, save
from .folds import fold_col
from .forest import bootstrap_counts, grow_forests
from .gram import LinearCV, LinearSpec
from .levels import LITERAL_LEVELS, long_levels, most_levels
from .trees import PARTITION_CELLS, at_depths, categorical_view_stages

# The parameter grids of the full and of the fast mode.
FULL = {
    "LinearRegression": {},
    "Ridge": {"alpha": [0.01, 0.1, 1.0, 10.0, 30.0, 100.0]},
    "Lasso": {"alpha": [0.0001, 0.0005, 0.001, 0.01, 0.1, 1.0]},
    "ElasticNet": {"alpha": [0.0001, 0.0005, 0.001, 0.01, 0.1], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9]},
    "RandomForest": {"trees": [500], "max_depth": [None, 10, 20, 30], "min_leaf": [1, 2, 5]},
    "GBT_TargetEncoded": {"rounds": [300, 500, 1000], "rate": [0.03, 0.05, 0.1], "max_depth": [2, 3, 5]},
    "GBT_Ordinal": {"rounds": [500, 1000], "rate": [0.03, 0.05, 0.1], "leaves": [15, 31, 63]},
    "GBT_Categorical": {"rounds": [500, 1000, 1500], "rate": [0.03, 0.05, 0.1], "max_depth": [4, 6, 8]},
    "SVR_RBF": {"C": [1.0, 5.0, 10.0, 30.0], "gamma": ["scale", 0.001, 0.01], "epsilon": [0.01, 0.03, 0.05]},
    "KernelRidge_RBF": {"alpha": [0.03, 0.1, 0.3, 1.0], "gamma": [0.0005, 0.001, 0.003, 0.01]},
}
FAST = {
    "LinearRegression": {},
    "Ridge": {"alpha": [0.1, 1.0, 10.0, 30.0]},
    "Lasso": {"alpha": [0.0005, 0.001, 0.005]},
    "ElasticNet": {"alpha": [0.0005, 0.001, 0.005], "l1_ratio": [0.3, 0.5, 0.7]},
    "RandomForest": {"trees": [200], "max_depth": [None, 20], "min_leaf": [1, 2]},
    "GBT_TargetEncoded": {"rounds": [300, 500], "rate": [0.03, 0.05], "max_depth": [2, 3]},
    "GBT_Ordinal": {"rounds": [300, 500], "rate": [0.03, 0.05], "leaves": [15, 31]},
    "GBT_Categorical": {"rounds": [300, 500], "rate": [0.03, 0.05], "max_depth": [4, 6]},
    "SVR_RBF": {"C": [5.0, 10.0], "gamma": ["scale"], "epsilon": [0.01, 0.03]},
    "KernelRidge_RBF": {"alpha": [0.1, 0.3], "gamma": [0.001, 0.003]},
}
#: Families that a stack may take, in this set's order of results, and how many of them at most.
STACK_CANDIDATES = frozenset(("ElasticNet", "Ridge", "Lasso", "SVR_RBF", "KernelRidge_RBF"))
STACK_MOST = 4
STACK_ALPHA = 10.0

_LINEAR = {"LinearRegression": "ols", "Ridge": "ridge", "Lasso": "lasso", "ElasticNet": "elasticnet"}
#: Pre-processing that a tree family sees.
TREE_VIEWS = {"RandomForest": "onehot", "GBT_TargetEncoded": "target", "GBT_Ordinal": "ordinal", "GBT_Categorical": "categorical"}
#: What the categorical view fills gaps with, and bins of a feature (more if a category has more levels).
MISSING, BINS = "Missing", 64
#: Fits that run at once.
QUEUE = 6


def points(grid: dict) -> list[dict]:
    """The grid as a list of points, the last parameter running fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


@dataclass
class Result:
    """What a search gives: its best point, score, one row (params, fold, mse) per point and fold, and the refitted model.

    ``by_fold`` gives the best point's model fitted outside a fold.
    """

    name: str
    params: dict
    score: float
    std: float
    rows: list[tuple[str, int, float]]
    model: PipelineModel
    by_fold: Callable[[int], PipelineModel] | None = None


def finite_rmse(mses) -> tuple[float, float]:
    """Mean and population std of the finite root errors; none: (inf, NaN)."""
    r = [math.sqrt(m) for m in mses if m is not None and math.isfinite(m)]
    if not r:
        return math.inf, math.nan
    mean = sum(r) / len(r)
    return mean, math.sqrt(sum((x - mean) ** 2 for x in r) / len(r))


def best_point(rows: list[tuple[dict, int, float]], grid: list[dict]) -> tuple[dict, float]:
    """The first point of the grid with the least root of the mean fold MSE; points with a non-finite fold come last."""
    def score(p):
        errors = [m for q, _, m in rows if q == p]
        return math.sqrt(sum(errors) / len(errors)) if errors and all(map(math.isfinite, errors)) else math.inf
    best = min(grid, key=score)
    return best, score(best)


@dataclass
class Training:
    """The training rows (id, y, fold, features) of a search; ``df`` should be a written or cheap table."""

    df: DataFrame
    numeric: list[str]
    categorical: list[str]
    k: int = 5
    seed: int = 42
    features: int = KR.FEATURES
    queue: int = QUEUE
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        self.df = self.df.filter(F.col("y").isNotNull()).select("id", "y", "fold", *self.numeric, *self.categorical)

    @cached_property
    def partitions(self) -> int:
        """Partitions of the feature tables: one per ``PARTITION_CELLS`` cells, so that small data costs few tasks a job."""
        return max(1, -(-self.cells // PARTITION_CELLS))

    @cached_property
    def cells(self) -> int:
        """Rows × features."""
        return self.df.count() * (len(self.numeric) + len(self.categorical))

    def _kept(self, rows: DataFrame) -> DataFrame:
        return rows.select("y", "features").coalesce(self.partitions).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def linear(self) -> LinearCV:
        return LinearCV(self.df, self.numeric, self.categorical, "y", "fold", self.k)

    def search(self, name: str, grid: dict | None = None) -> Result:
        """The named family over ``grid`` (the full grid of the reference by default), refitted at its best point."""
        grid = FULL[name] if grid is None else grid
        if name in _LINEAR:
            return self._search_linear(name, points(grid))
        if name == "KernelRidge_RBF":
            return self._search_kernel_ridge(name, points(grid))
        if name == "SVR_RBF":
            return self._search_svr(name, points(grid))
        return self._search_trees(name, points(grid))

    def _result(self, name, grid, errors, model, by_fold) -> Result:
        """``errors``: [(point, fold, mse)]."""
        best, score = best_point(errors, grid)
        std = math.nan
        if not best:  # a family without parameters is summarised by fold, as a plain cross-validation is
            score, std = finite_rmse([m for _, _, m in errors])
        return Result(name, best, score, std, [(as_json(p), j, m) for p, j, m in errors], model(best), lambda j: by_fold(best, j))

    # linear -----------------------------------------------------------------
    def _search_linear(self, name, grid):
        def spec(p):
            return LinearSpec(_LINEAR[name], float(p.get("alpha", 0.0)), float(p.get("l1_ratio", 1.0)))
        found = self.linear.grid_errors([spec(p) for p in grid])
        errors = [(p, j, m) for p in grid for j, _, m in found[spec(p)]]
        one = lambda p, j=None: PipelineModel(stages=[LinearFormula.of(self.linear, spec(p), j)])
        return self._result(name, grid, errors, one, one)

    # kernels ------------------------------------------------------------------
    def _gamma(self, g) -> float:
        return KR.scale_gamma(self.linear) if g == "scale" else float(g)

    def _map(self, g) -> KR.FourierMap:
        return KR.FourierMap(self._gamma(g), self.features, self.seed)

    def _search_kernel_ridge(self, name, grid):
        errors, models = [], {}
        for g in dict.fromkeys(p["gamma"] for p in grid):
            alphas = [p["alpha"] for p in grid if p["gamma"] == g]
            rows, fitted = KR.ridge_grid(self.df, self.linear, alphas, self._map(g))
            errors += [({"alpha": a, "gamma": g}, j, m) for a, j, m in rows]
            models.update({(a, g): m for a, m in fitted.items()})
        folds: dict = {}

        def by_fold(p, j):
            if not folds:
                folds.update(KR.fold_ridge(self.df, self.linear, p["alpha"], self._map(p["gamma"])))
            return PipelineModel(stages=[folds[j]])
        return self._result(name, grid, errors, lambda p: PipelineModel(stages=[models[p["alpha"], p["gamma"]]]), by_fold)

    def _search_svr(self, name, grid):
        errors, models, folds = [], {}, {}
        for g in dict.fromkeys(p["gamma"] for p in grid):
            settings = [(p["C"], p["epsilon"]) for p in grid if p["gamma"] == g]
            rows, fitted, by = KR.svr_grid(self.df, self.linear, settings, self._map(g))
            errors += [({"C": c, "gamma": g, "epsilon": e}, j, m) for c, e, j, m in rows]
            models.update({(c, g, e): m for (c, e), m in fitted.items()})
            folds.update({(c, g, e): m for (c, e), m in by.items()})
        at = lambda p: (p["C"], p["gamma"], p["epsilon"])
        return self._result(name, grid, errors, lambda p: PipelineModel(stages=[models[at(p)]]),
                            lambda p, j: PipelineModel(stages=[folds[at(p)][j]]))

    # trees ------------------------------------------------------------------------
    @cached_property
    def few_levels(self) -> bool:
        """Every category has levels that a plan may hold as literals, so the fold statistics serve the tree views too."""
        return most_levels(long_levels(self.df, self.categorical)) <= LITERAL_LEVELS if self.categorical else True

    def _share(self) -> None:
        """Has the statistics that all fits read made once, before they start side by side."""
        if self.few_levels:
            self.linear  # noqa: B018

    def _view_stages(self, view: str, fold: int | None) -> list:
        """Pre-processing of a tree view for the rows outside ``fold`` (None: all): medians, modes and levels of all
        training sets come from one pass (``linear``); categories of many levels are fitted on the rows, as tables."""
        num, cat = self.numeric, self.categorical
        stages = {"onehot": T.tree_pipeline, "ordinal": T.ordinal_pipeline, "target": target_pipeline,
                  "categorical": lambda num, cat: Pipeline(stages=categorical_view_stages(num, cat))}[view](num, cat).getStages()
        if not self.few_levels:
            return stages
        tf = self.linear.transform_for(fold)
        levels = lambda c: self._levels(view, fold, c)

        def known(stage):
            if isinstance(stage, T.MedianImputer):
                return [T.MedianImputerModel(medians=tf.medians)]
            if isinstance(stage, T.ModeImputer):
                return [T.ModeImputerModel(modes=tf.modes)]
            if isinstance(stage, T.OrdinalEncoder):
                return [T.OrdinalEncoderModel(levels={c: levels(c) for c in cat}, suffix=stage.suffix)]
            if isinstance(stage, StringIndexer):  # a model a column: label lists of several lengths do not go through as one array
                return [StringIndexerModel.from_labels(levels(c), i, o, stage.getHandleInvalid())
                        for c, i, o in zip(cat, stage.getInputCols(), stage.getOutputCols())]
            return [stage]
        return [x for s in stages for x in known(s)] if all(levels(c) for c in cat) else stages

    def _levels(self, view: str, fold: int | None, c: str) -> list[str]:
        """Levels of a category among the rows outside ``fold``, as the view's encoder knows them."""
        empty = self.linear.design.index[("h", c, None)]
        filled = view == "categorical" and self.linear.train_S(fold)[empty, empty] > 0
        return sorted({*self.linear.transform_for(fold).kept[c], *([MISSING] if filled else [])})

    def _prepared(self, view: str, fold: int | None):
        """(rows outside ``fold`` (None: all) with features, pre-processing for other rows) of a tree view."""
        rows = self.df if fold is None else self.df.filter(F.col("fold") != fold)
        pre = Pipeline(stages=self._view_stages(view, fold)).fit(rows)
        if view == "target":
            return target_encoded(rows, pre, self.numeric, self.categorical, self.k, self.seed)
        return pre.transform(rows), pre

    def _search_trees(self, name, grid):
        view = TREE_VIEWS[name]
        self._share()
        if name != "RandomForest" and self._shared_passes(view):
            return self._search_boosted(name, grid)
        if name == "RandomForest" and self._held_by_a_task():
            return self._search_small_forests(name, grid)
        # depth None and 30 are one model; a boosted model of the most rounds holds those of fewer, the deepest forest the shallower
        fits: dict[tuple, dict[int, list]] = {}
        for p in grid:
            key, size = _fit_key(name, p), p.get("rounds")
            if name == "RandomForest":
                (trees, size, leaf) = key
                key = trees, leaf
            fits.setdefault(key, {}).setdefault(size, []).append(p)
        views: dict[int, tuple] = {}
        lock = {j: threading.Lock() for j in range(self.k)}
        left = dict.fromkeys(range(self.k), len(fits))

        def features(j):
            with lock[j]:
                if j not in views:
                    train, pre = self._prepared(view, j)
                    held = pre.transform(self.df.filter(F.col("fold") == j))
                    views[j] = self._kept(train), self._kept(held)
                return views[j]

        def run(job):
            j, key = job
            train, held = features(j)
            most = max(fits[key])
            if name == "RandomForest":
                trees, leaf = key
                model = regressor(name, (trees, most, leaf), None, self.seed, train).fit(train)
                shallower = [d for d in fits[key] if d < most]
                square = lambda c: F.avg((F.col("y") - c) ** 2)
                scored = model.transform(held).withColumn("__at", at_depths(model, shallower)(vector_to_array("features"))) if shallower \
                    else model.transform(held)
                row = scored.agg(square(F.col("prediction")), *[square(F.col("__at")[i]) for i in range(len(shallower))]).first()
                after = dict(zip([most, *shallower], row))
            else:
                model = regressor(name, key, most, self.seed, train).fit(train)
                curve = model.evaluateEachIteration(held, "squared")
                after = {r: curve[r - 1] for r in fits[key]}
            with lock[j]:
                left[j] -= 1
                if not left[j]:
                    for x in views.pop(j):
                        x.unpersist()
            return [(p, j, math.nan if after[r] is None else after[r]) for r, ps in fits[key].items() for p in ps]

        jobs = [(j, key) for j in range(self.k) for key in fits]
        with ThreadPoolExecutor(max_workers=self.queue) as pool:
            errors = [e for found in pool.map(run, jobs) for e in found]

        fit = lambda p, j=None: self.tree_fitter(name, p)(j)
        return self._result(name, grid, errors, fit, fit)

    def tree_fitter(self, name: str, p: dict) -> Callable[[int | None], PipelineModel]:
        """fold → the tree family's model of point ``p``, with its pre-processing, fitted outside the fold (None: on all rows)."""
        self._share()

        def fit(j=None):
            train, pre = self._prepared(TREE_VIEWS[name], j)
            train = self._kept(train)
            try:
                model = regressor(name, _fit_key(name, p), p.get("rounds"), self.seed, train).fit(train)
            finally:
                train.unpersist()
            return PipelineModel(stages=[pre, model])
        return fit

    def tree_models(self, name: str, p: dict) -> dict[int | None, PipelineModel]:
        """The boosted family's models of point ``p`` outside every fold and (None) on all rows."""
        self._share()
        folds = [None, *range(self.k)]
        if self._shared_passes(TREE_VIEWS[name]):
            grown = self._boosted(TREE_VIEWS[name], [Job(j, *_fit_key(name, p), p["rounds"]) for j in folds], True)
            return {j: model for j, (model, _) in zip(folds, grown)}
        with ThreadPoolExecutor(max_workers=self.queue) as pool:
            return dict(zip(folds, pool.map(self.tree_fitter(name, p), folds)))

    # forests of small tables --------------------------------------------------------
    def _held_by_a_task(self) -> bool:
        """Every training set has rows, and they are one partition's, so that whole trees grow in a task (``forest``)."""
        return self.partitions == 1 and self.few_levels and all(self.linear.train_S(j)[0, 0] >= 1 for j in [None, *range(self.k)])

    def _forest_table(self, name: str, keys: list[tuple], fold: int | None):
        """(rows by tree view for ``grow_forests``, target of the held rows, pre-processing, regressors of ``keys``, which have as many
        trees each) of the rows outside ``fold``."""
        train, pre = self._prepared("onehot", fold)
        train = self._kept(train)
        try:
            asked = [regressor(name, key, None, self.seed, train) for key in keys]
            rf = asked[0]
            read = lambda rows: rows.select("y", vector_to_array("features").alias("x")).toPandas()
            own = read(train)
            about = train.schema["features"].metadata["ml_attr"]
            width, nominal = about["num_attrs"], {a["idx"] for a in about["attrs"].get("binary", [])}  # categories to MLlib too
            held = read(pre.transform(self.df.filter(F.col("fold") == fold))) if fold is not None else own.iloc[:0]
            n = len(own)
            bins = min(rf.getMaxBins(), n)
            needed = max(bins * bins, 10_000)  # rows that MLlib looks for thresholds in
            share = needed / n if needed < n else 1.0
            seen = read(drawn_as_mllib(train, share, self.seed)) if share < 1.0 else own
        finally:
            train.unpersist()
        matrix = lambda p: np.array(p["x"].tolist(), float).reshape(len(p), width)
        x, z, drawn = matrix(own), matrix(held), matrix(seen)
        limits = [np.array([0.5]) if i in nominal else thresholds_of(drawn[:, i], share * n, bins - 1) for i in range(width)]
        coded = lambda m: np.array([np.searchsorted(t, m[:, i], "left") for i, t in enumerate(limits)], np.uint8 if bins <= 256 else np.uint16).reshape(width, len(m))
        slots = [Slot(np.empty(0), np.empty(0), None if i in nominal else t, len(t) + 1) for i, t in enumerate(limits)]
        counts = bootstrap_counts(self.df.sparkSession, n, rf.getNumTrees(), rf.getSeed())
        return (coded(x), own["y"].to_numpy(float), counts, coded(z), slots), held["y"].to_numpy(float), pre, asked

    def _search_small_forests(self, name, grid):
        stops: dict[tuple, set] = {}  # depths by trees and leaf size
        for p in grid:
            trees, depth, leaf = _fit_key(name, p)
            stops.setdefault((trees, leaf), set()).add(depth)
        keys: dict[int, list] = {}
        for (trees, leaf), depths in stops.items():
            keys.setdefault(trees, []).append((trees, max(depths), leaf))
        spark, at = self.df.sparkSession, {}
        for trees, own in keys.items():
            with ThreadPoolExecutor(max_workers=self.queue) as pool:
                made = dict(enumerate(pool.map(lambda j: self._forest_table(name, own, j), range(self.k))))
            jobs = [_forest_job(j, rf, sorted(stops[trees, rf.getMinInstancesPerNode()])) for j, m in made.items() for rf in m[3]]
            for (j, _, leaf, _, depths), (_, predicted) in zip(jobs, grow_forests(spark, {j: m[0] for j, m in made.items()}, jobs, False)):
                y = made[j][1]
                at.update({(j, trees, leaf, d): float(((y - guess) ** 2).mean()) if len(y) else math.nan for d, guess in zip(depths, predicted)})
        errors = [(p, j, at[j, trees, leaf, depth]) for j in range(self.k) for p in grid for trees, depth, leaf in [_fit_key(name, p)]]

        def fit(p, j=None):
            table, _, pre, (rf,) = self._forest_table(name, [_fit_key(name, p)], j)
            (state, _), = grow_forests(spark, {j: table}, [_forest_job(j, rf, [])], True)
            return PipelineModel(stages=[pre, BoostedTrees.of_state(state)])
        return self._result(name, grid, errors, fit, fit)

    # boosting in shared passes ------------------------------------------------------
    def _shared_passes(self, view: str) -> bool:
        """Every training set has rows, a median for every number and a level for every category, few enough for tables."""
        if not self.few_levels:
            return False
        sets = [None, *range(self.k)]
        return all(self.linear.train_S(j)[0, 0] >= 1 and all(self.linear.transform_for(j).medians.get(c) is not None for c in self.numeric)
                   and all(self._levels(view, j, c) for c in self.categorical) for j in sets)

    def _set_view(self, view: str, fold: int | None):
        """(pre-processing of other rows, thresholds by feature (None: nominal), value by (feature, level, part) of the
        set's own rows or (feature, level) of others, bins) of the rows outside ``fold``."""
        rows = self.df if fold is None else self.df.filter(F.col("fold") != fold)
        pre = Pipeline(stages=self._view_stages(view, fold)).fit(rows)
        count = int(round(self.linear.train_S(fold)[0, 0]))
        known = {c: self._levels(view, fold, c) for c in self.categorical}
        bins = min(max(BINS, *(len(v) + 1 for v in known.values())) if view == "categorical" and known else BINS, count)
        needed = max(bins * bins, 10_000)  # rows that MLlib looks for thresholds in
        share = needed / count if needed < count else 1.0
        sample = rows.coalesce(self.partitions)
        if share < 1.0:
            sample = drawn_as_mllib(sample, share, self.seed)
        modes, own, held = self.linear.transform_for(fold).modes, {}, {}
        if view == "target":
            stats, full = encodings(rows, pre, self.categorical, self.k, self.seed)
            prior, enc = full.s["prior"], {(r["column"], r["level"], r["__te_fold"]): r["enc"] for r in stats.collect()}  # few levels
            slots = VectorAssembler(inputCols=list(self.numeric) + [c + "_te" for c in self.categorical], outputCol="features")
            seen = slots.transform(with_encodings(pre.transform(sample).withColumn("__te_fold", fold_col("id", self.k, self.seed, "te")),
                                                  stats, self.categorical))
            pre = PipelineModel(stages=[*pre.stages, full, slots])
            value = lambda c, v, part: enc.get((c, v, part), prior)
            other = lambda c, v: full.s["enc"].get(c, {}).get(v, prior)
        else:
            seen = pre.transform(sample)
            place = {c: {v: float(i) for i, v in enumerate(known[c])} for c in self.categorical}
            value = lambda c, v, part: place[c].get(v, -1.0 if view == "ordinal" else float(len(known[c])))
            other = None
        found = seen.select(vector_to_array("features").alias("x")).toPandas()["x"]  # the sample only
        x = np.array(found.tolist()).reshape(len(found), len(self.numeric) + len(self.categorical))
        limits = [None if view == "categorical" and i >= len(self.numeric) else thresholds_of(x[:, i], share * count, bins - 1)
                  for i in range(x.shape[1])]
        for c in self.categorical:
            fill = MISSING if view == "categorical" else modes[c]
            levels = [*self.linear.design.levels[c], fill]
            parts = range(self.k) if view == "target" else (0,)
            own[c] = np.array([value(c, v, part) for v in levels for part in parts])
            held[c] = None if other is None else np.array([other(c, v) for v in levels for _ in parts])
        return pre, limits, own, held, {c: len(known[c]) + 1 for c in self.categorical}

    def _coded(self, view: str):
        """(rows to code, coding, features by training set, pre-processing by training set) of a view, made once."""
        if view in self.extra:
            return self.extra[view]
        sets = [None, *range(self.k)]
        self.partitions  # noqa: B018 - counted once, before the sets start side by side
        with ThreadPoolExecutor(max_workers=self.queue) as pool:
            views = dict(zip(sets, pool.map(lambda j: self._set_view(view, j), sets)))
        edges = {c: np.unique(np.concatenate([v[1][i] for v in views.values()])) for i, c in enumerate(self.numeric)}
        coding = Coding(edges, {c: list(self.linear.design.levels[c]) for c in self.categorical}, self.k if view == "target" else 1)

        def slots(j):
            _, limits, own, held, sizes = views[j]
            out = []
            for i, c in enumerate(self.numeric):
                t = limits[i]
                bins = np.concatenate([np.searchsorted(t, edges[c], "left"), [len(t), np.searchsorted(t, self.linear.transform_for(j).medians[c], "left")]])
                out.append(Slot(bins, bins, t, len(t) + 1))
            for i, c in enumerate(self.categorical, len(self.numeric)):
                t = limits[i]
                bins = own[c].astype(int) if t is None else np.searchsorted(t, own[c], "left")
                out.append(Slot(bins, bins if held[c] is None else np.searchsorted(t, held[c], "left"), t, sizes[c] if t is None else len(t) + 1))
            return out
        rows = self.df.withColumn("__te_fold", fold_col("id", self.k, self.seed, "te")) if view == "target" else self.df
        self.extra[view] = rows, coding, {j: slots(j) for j in sets}, {j: v[0] for j, v in views.items()}
        return self.extra[view]

    def _boosted(self, view: str, jobs: list[Job], keep: bool) -> list[tuple[PipelineModel | None, list[float]]]:
        """(model with its pre-processing, if ``keep``; held-out errors by round) of every job."""
        rows, coding, slots, pre = self._coded(view)
        if self.cells <= boosting.LOCAL_CELLS:  # a task holds the table
            grown = [(state and BoostedTrees.of_state(state), curve)
                     for state, curve in grow_apart(rows, coding, slots, jobs, self.partitions, keep)]
        else:
            grown = [(keep and BoostedTrees.of(trees, job.rate, slots[job.fold]), curve)
                     for job, (trees, curve) in zip(jobs, boost(rows, coding, slots, jobs, self.partitions, keep))]
        return [(PipelineModel(stages=[*pre[job.fold].stages, model]) if keep else None, curve) for job, (model, curve) in zip(jobs, grown)]

    def _search_boosted(self, name, grid):
        keys: dict[tuple, int] = {}
        for p in grid:
            keys[_fit_key(name, p)] = max(p["rounds"], keys.get(_fit_key(name, p), 0))
        jobs = [Job(j, *key, rounds) for j in range(self.k) for key, rounds in keys.items()]
        curves = {(job.fold, (job.rate, job.depth)): curve for job, (_, curve) in zip(jobs, self._boosted(TREE_VIEWS[name], jobs, False))}
        errors = [(p, j, curves[j, _fit_key(name, p)][p["rounds"] - 1]) for j in range(self.k) for p in grid]

        def model(p, j=None):  # the trees of the other points are not kept: a full grid has millions of nodes
            return self._boosted(TREE_VIEWS[name], [Job(j, *_fit_key(name, p), p["rounds"])], True)[0][0]
        return self._result(name, grid, errors, model, model)

    # stacking -----------------------------------------------------------------------
    def stack(self, results: list[Result], alpha: float = STACK_ALPHA, candidates=STACK_CANDIDATES, most: int = STACK_MOST) -> Result:
        """Ridge meta model on the out-of-fold predictions of the first ``most`` candidates among ``results``.

        Bases may be of any family; fewer than two raise ``ValueError``. The out-of-fold matrix is written once, one
        column a base. Score: by fold, with the meta model fitted on the out-of-fold rows of the other folds.
        """
        bases = [r for r in results if r.name in candidates][:most]
        if len(bases) < 2:
            raise ValueError("stacking needs two base models at least")
        names = [f"b{i}" for i in range(len(bases))]
        oof = out_of_fold(self, bases, names)
        centre = float(self.linear.total[0, self.linear.design.index[("y",)]] / self.linear.total[0, 0])
        cells = fold_moments(oof, "y", names, "fold", self.k, centre)
        total = sum(cells.values())
        errors, metas = [], {}
        for j, own in cells.items():
            b0, w = meta_of(total - own, alpha)
            metas[j] = (w, b0 + centre * (1 - sum(w)))
            residual = np.array([-b0, *(-x for x in w), 1.0])
            errors.append(({}, j, float(max(residual @ own @ residual, 0.0) / own[0, 0]) if own[0, 0] else math.nan))
        b0, w = meta_of(total, alpha)
        b0 += centre * (1 - sum(w))
        score, std = finite_rmse([m for _, _, m in errors])
        return Result("StackingRegressor", {}, score, std, [("{}", j, m) for _, j, m in errors],
                      PipelineModel(stages=[Branches([r.model for r in bases], w, b0)]),
                      lambda j: PipelineModel(stages=[Branches([r.by_fold(j) for r in bases], *metas[j])]))


def as_json(params: dict) -> str:
    return json.dumps(params)


def _fit_key(name: str, p: dict) -> tuple:
    if name == "RandomForest":
        return p["trees"], min(p["max_depth"] or 30, 30), p["min_leaf"]
    depth = int(math.ceil(math.log2(p["leaves"]))) if "leaves" in p else p["max_depth"]
    return p["rate"], depth


def _forest_job(table, rf: RandomForestRegressor, stops: list[int]) -> tuple:
    """A job of ``grow_forests`` with the parameters of ``rf``."""
    return table, rf.getMaxDepth(), rf.getMinInstancesPerNode(), rf.getNumTrees(), stops


def regressor(name: str, key: tuple, rounds: int | None, seed: int, train: DataFrame):
    """The MLlib regressor of a fit; bins follow the widest nominal feature (64 at least)."""
    attrs = train.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    levels = max((len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in attrs.get("nominal", [])), default=0)
    bins = max(64, levels)
    if name == "RandomForest":
        trees, depth, leaf = key
        return RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf,
                                     featureSubsetStrategy="all", seed=seed, maxBins=bins)
    rate, depth = key
    return GBTRegressor(featuresCol="features", labelCol="y", maxIter=rounds, stepSize=rate, maxDepth=depth, seed=seed, maxBins=bins,
                        checkpointInterval=10)


def drawn_as_mllib(df: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows that MLlib's trees would draw from ``df`` to look for thresholds in (``DataFrame.sample`` seeds its partitions otherwise)."""
    spark = df.sparkSession
    draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    drawn = df._jdf.javaRDD().sample(False, share, draw)
    return type(df)(spark._jsparkSession.createDataFrame(drawn, df._jdf.schema()), spark)


def target_pipeline(num, cat) -> Pipeline:
    """median for numerics ∥ mode for categories: what target encoding starts from."""
    return Pipeline(stages=[T.MedianImputer(num), T.ModeImputer(cat)])


def target_encoded(rows: DataFrame, filled: PipelineModel, num, cat, k: int, seed: int, key: str = "id"):
    """(rows with cross-fitted encodings, pre-processing with the encoder of all rows for others); ``filled`` fills gaps."""
    stats, full = encodings(rows, filled, cat, k, seed, key)
    slots = VectorAssembler(inputCols=list(num) + [c + "_te" for c in cat], outputCol="features")
    x = with_encodings(filled.transform(rows).withColumn("__te_fold", fold_col(key, k, seed, "te")), stats, cat)
    return slots.transform(x), PipelineModel(stages=[*filled.stages, full, slots])


def encodings(rows: DataFrame, filled: PipelineModel, cat, k: int, seed: int, key: str = "id"):
    """(table of cross-fitted encodings, one row a level and part; encoder of all rows)."""
    x = filled.transform(rows).withColumn("__te_fold", fold_col(key, k, seed, "te"))
    return written(T.target_encoding_stats(x, cat, "y", "__te_fold"), "encodings"), T.TargetEncoder(cat, "y").fit(x)


def with_encodings(x: DataFrame, stats: DataFrame, cat) -> DataFrame:
    for c in cat:
        s = stats.filter(F.col("column") == c).select(F.col("level").alias(c), "__te_fold", F.col("enc").alias(c + "_te"))
        x = x.join(s, [c, "__te_fold"], "left")
    return x


def out_of_fold(train: Training, bases: list[Result], names: list[str]) -> DataFrame:
    """Written table (id, fold, y, one column per base): each row scored by models that have not seen its fold."""
    out = None
    for j in range(train.k):
        part = predictions(train.df.filter(F.col("fold") == j), {c: r.by_fold(j) for c, r in zip(names, bases)}).select("id", "fold", "y", *names)
        out = part if out is None else out.unionByName(part)
    return written(out, "out-of-fold")


# ---------------------------------------------------------------- results as tables

COMPARISON = "model string, cv_rmsle_mean double, cv_rmsle_std double, best_params string, path string, position int"


class ModelStore:
    """Fitted models with their scores and parameters: one saved ``PipelineModel`` each, and a table that names them."""

    def __init__(self, spark, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "models")

    def add(self, results: list[Result]) -> None:
        """Saves the models and appends their rows; names that are there already are left as they are."""
        known = {r["model"] for r in self._rows().select("model").collect()} if self._exists() else set()
        new = [r for r in results if r.name not in known]
        paths = [f"{self.path}/model-{r.name.lower()}" for r in new]
        with ThreadPoolExecutor(max_workers=QUEUE) as pool:
            list(pool.map(lambda job: save(job[0].model, job[1]), zip(new, paths)))
        rows = [(r.name, float(r.score), float(r.std), as_json(r.params), path, i)
                for i, (r, path) in enumerate(zip(new, paths), len(known))]
        if rows:
            self.spark.createDataFrame(rows, COMPARISON).coalesce(1).write.mode("append").parquet(f"{self.path}/results")

    def _exists(self) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/results")
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(p)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(COMPARISON).parquet(f"{self.path}/results")

    def comparison(self) -> DataFrame:
        """Models in ascending order of their score, those without a finite one last (ties: in order of arrival)."""
        finite = ~F.isnan("cv_rmsle_mean") & (F.abs("cv_rmsle_mean") < math.inf)
        return self._rows().orderBy(F.when(finite, F.col("cv_rmsle_mean")).otherwise(F.lit(math.inf)), "position")

    def best(self, n: int = 1) -> list:
        """The first ``n`` rows of the comparison with a finite score."""
        return self.comparison().filter(~F.isnan("cv_rmsle_mean") & (F.abs("cv_rmsle_mean") < math.inf)).limit(n).collect()

    def load(self, name: str) -> PipelineModel:
        rows = self._rows().filter(F.col("model") == name).collect()
        if not rows:
            raise KeyError(name)
        return load(rows[0]["path"])

    def blend(self, n: int = 3) -> PipelineModel:
        """The ``n`` best models, weighted by their inverse errors."""
        rows = self.best(n)
        inverse = [1.0 / max(r["cv_rmsle_mean"], 1e-6) for r in rows]
        return PipelineModel(stages=[Branches([load(r["path"]) for r in rows], [x / sum(inverse) for x in inverse])])
