"""Tree and kernel-approximation regressors through MLlib (survey M6–M11).

Every candidate is a ``Pipeline`` (pre-processing + regressor) refitted inside
each fold, so the pre-processing never sees the validation rows. Folds are
fitted concurrently from a thread pool, the way ``CrossValidator(parallelism)``
does. Inputs are cached once; ``checkpointInterval`` keeps GBT lineage short.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from . import transformers as T


#: Cells (rows × columns) of a partition that boosting rounds go over.
PARTITION_CELLS = 1_000_000


def rf_pipeline(num, cat, num_trees=20, max_depth=10, min_leaf=1, seed=42, max_bins=64) -> Pipeline:
    """Random forest on the one-hot tree view; every feature is a split
    candidate (scikit-learn's regressor default); depth None maps to MLlib's cap 30."""
    rf = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=num_trees,
                               maxDepth=min(max_depth or 30, 30), minInstancesPerNode=min_leaf,
                               featureSubsetStrategy="all", seed=seed, maxBins=max_bins)
    return Pipeline(stages=[*T.tree_pipeline(num, cat).getStages(), rf])


def gbt(max_iter=20, step=0.1, depth=3, seed=42, max_bins=64) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol="y", maxIter=max_iter, stepSize=step,
                        maxDepth=depth, seed=seed, maxBins=max_bins, checkpointInterval=10)


class TargetEncodedGBT(T.Estimator):
    """GBT on target-encoded categories with the encoder's train/score split:
    training rows are encoded *cross-fitted* (statistics of the other internal
    folds, so a row never sees its own target), the fitted model carries the
    encoder fitted on all training rows for scoring. Returns a PipelineModel."""

    def __init__(self, num, cat, k: int = 5, seed: int = 42, key: str = "id", **gbt_kw):
        super().__init__()
        self.num, self.cat, self.k, self.seed, self.key, self.gbt_kw = list(num), list(cat), k, seed, key, gbt_kw

    def _fit(self, df):
        from pyspark.ml import PipelineModel

        from .folds import fold_col
        imp = T.MedianImputer(self.num).fit(df)
        mode = T.ModeImputer(self.cat).fit(df)
        x = mode.transform(imp.transform(df)).withColumn("__te_fold", fold_col(self.key, self.k, self.seed, "te"))
        # (column, level, fold) statistics: levels × k rows, computed once and
        # joined per column (the planner broadcasts them by their measured size)
        stats = T.target_encoding_stats(x, self.cat, "y", "__te_fold").persist()
        try:
            for c in self.cat:
                s = stats.filter(F.col("column") == c).select(F.col("level").alias(c), "__te_fold",
                                                               F.col("enc").alias(c + "_te"))
                x = x.join(s, [c, "__te_fold"], "left")
            asm = VectorAssembler(inputCols=self.num + [c + "_te" for c in self.cat], outputCol="features")
            x = x.persist(StorageLevel.MEMORY_AND_DISK)
            model = gbt(**self.gbt_kw).fit(asm.transform(x))
            full = T.TargetEncoder(self.cat, "y").fit(x)
            x.unpersist()
        finally:
            stats.unpersist()
        return PipelineModel(stages=[imp, mode, full, asm, model])


def gbt_target_encoded_pipeline(num, cat, **kw):
    return TargetEncodedGBT(num, cat, **kw)


def gbt_ordinal_pipeline(num, cat, leaves=31, **kw) -> Pipeline:
    """Leaf budget L ↦ depth ceil(log2 L)."""
    depth = int(math.ceil(math.log2(leaves)))
    return Pipeline(stages=[*T.ordinal_pipeline(num, cat).getStages(), gbt(depth=depth, **kw)])


def categorical_view_stages(num, cat):
    """Indexed categories carry nominal metadata through the assembler, so the
    trees split on category sets (MLlib's native categorical handling)."""
    idx = StringIndexer(inputCols=list(cat), outputCols=[c + "_cat" for c in cat],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    asm = VectorAssembler(inputCols=list(num) + [c + "_cat" for c in cat], outputCol="features")
    return [T.MedianImputer(num), T.FillMissingStage(cat), idx, asm]


def spread(df: DataFrame) -> DataFrame:
    """Rows with features in a partition per ``PARTITION_CELLS`` cells at least: a task of a fit reads so many, whatever the table's size."""
    attrs = df.schema["features"].metadata["ml_attr"]
    wanted = -(-df.count() * attrs.get("num_attrs", sum(map(len, attrs["attrs"].values()))) // PARTITION_CELLS)
    return df.repartition(wanted) if wanted > df.rdd.getNumPartitions() else df


class CategoricalGBT(T.Estimator):
    """GBT with a bin for every level of its widest nominal feature, 64 at least
    (MLlib stops at a category with more levels than bins)."""

    def __init__(self, **gbt_kw):
        super().__init__()
        self.gbt_kw = gbt_kw

    def _fit(self, df):
        nominal = df.schema["features"].metadata["ml_attr"]["attrs"].get("nominal", [])
        levels = max((len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in nominal), default=0)
        return gbt(**{"max_bins": max(64, levels), **self.gbt_kw}).fit(spread(df.select("y", "features")))


def gbt_categorical_pipeline(num, cat, **kw) -> Pipeline:
    return Pipeline(stages=[*categorical_view_stages(num, cat), CategoricalGBT(**kw)])


def nodes_to_depth(node, depth: int, out: list) -> int:
    """Appends a tree's nodes down to ``depth`` as (level, prediction, feature, threshold or categories that go left, left
    child, right child), children by their place in ``out``; a node at ``depth`` has no split. Returns the root's place."""
    def walk(node, level):
        at = len(out)
        out.append(None)
        if level == depth or node.getClass().getSimpleName() == "LeafNode":
            out[at] = level, float(node.prediction()), -1, None, at, at
            return at
        split = node.split()
        rule = float(split.threshold()) if split.getClass().getSimpleName() == "ContinuousSplit" else [float(c) for c in split.leftCategories()]
        left, right = walk(node.leftChild(), level + 1), walk(node.rightChild(), level + 1)
        out[at] = level, float(node.prediction()), int(split.featureIndex()), rule, left, right
        return at
    return walk(node, 0)


def at_depths(model, depths: list[int]):
    """Column function: the features' array → the forest's mean prediction when its trees end at each of ``depths``.

    Trees grow level by level and a node's prediction does not depend on what grows below it, so this is what a
    forest of that depth, with the same seed, rows and parameters, predicts."""
    most = max(depths)
    nodes: list = []
    roots = [nodes_to_depth(t._java_obj.rootNode(), most, nodes) for t in model.trees]
    worth = np.array([n[1] for n in nodes])

    @F.pandas_udf("array<double>")
    def predict(x: pd.Series) -> pd.Series:
        rows = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        sums = np.zeros((len(rows), len(depths)))

        def descend(at, own):
            level, _, feature, rule, left, right = nodes[at]
            ends = [i for i, d in enumerate(depths) if d == level or (feature < 0 and d > level)]
            sums[np.ix_(own, ends)] += worth[at]
            if feature >= 0 and len(own):
                v = rows[own, feature]
                goes = v <= rule if isinstance(rule, float) else np.isin(v, rule)
                descend(left, own[goes])
                descend(right, own[~goes])

        for root in roots:
            descend(root, np.arange(len(rows)))
        return pd.Series(list(sums / len(roots)))

    return predict


class RandomFourierFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """z(x) = sqrt(2/D)·cos(Wx + b), W ~ N(0, 2γ), b ~ U(0, 2π) (Rahimi & Recht,
    2007): an explicit map whose inner products approximate the RBF kernel.
    One Arrow-batched pandas UDF per batch: a (rows × dim) @ (dim × D) product."""

    seed = Param(Params._dummy(), "seed", "seed", typeConverter=TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "RBF gamma", typeConverter=TypeConverters.toFloat)
    nComponents = Param(Params._dummy(), "nComponents", "D", typeConverter=TypeConverters.toInt)
    inputDim = Param(Params._dummy(), "inputDim", "input size", typeConverter=TypeConverters.toInt)
    inputCol = Param(Params._dummy(), "inputCol", "input", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output", typeConverter=TypeConverters.toString)

    def __init__(self, input_dim: int = 1, n_components: int = 64, gamma: float = 0.01, seed: int = 42,
                 inputCol: str = "features", outputCol: str = "rff"):
        super().__init__()
        self._set(seed=seed, gamma=gamma, nComponents=n_components, inputDim=input_dim,
                  inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector, vector_to_array
        g = self.getOrDefault
        rng = np.random.default_rng(g(self.seed))
        D, dim = g(self.nComponents), g(self.inputDim)
        W = rng.normal(0.0, math.sqrt(2 * g(self.gamma)), size=(dim, D))
        b = rng.uniform(0, 2 * math.pi, size=D)
        scale = math.sqrt(2.0 / D)

        @F.pandas_udf("array<double>")
        def rff(x: pd.Series) -> pd.Series:
            X = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, dim))
            Z = np.cos(X @ W + b) * scale
            return pd.Series(list(Z))

        return df.withColumn(g(self.outputCol), array_to_vector(rff(vector_to_array(g(self.inputCol)))))


def rff_pipeline(num, cat, loss: str = "squaredError", alpha: float = 0.1, gamma: float = 0.01,
                 n_components: int = 64) -> Pipeline:
    """Kernel ridge / RBF-SVR re-aimed: standardised linear design → random
    Fourier features → ridge (squared loss) or Huber-loss regression."""
    input_dim = len(num) + sum(1 for _ in cat)  # refined at fit time
    return _RFFPipeline(num, cat, loss, alpha, gamma, n_components, input_dim)


class _RFFPipeline(T.Estimator):
    def __init__(self, num, cat, loss, alpha, gamma, n_components, input_dim):
        super().__init__()
        self.num, self.cat, self.loss = list(num), list(cat), loss
        self.alpha, self.gamma, self.n = alpha, gamma, n_components

    def _fit(self, df):
        pre = T.linear_pipeline(self.num, self.cat, out="lin").fit(df)
        x = pre.transform(df)
        dim = x.schema["lin"].metadata["ml_attr"]["num_attrs"]
        rff = RandomFourierFeatures(dim, self.n, self.gamma, inputCol="lin", outputCol="features")
        lr = LinearRegression(featuresCol="features", labelCol="y", loss=self.loss,
                              regParam=self.alpha, elasticNetParam=0.0, standardization=False,
                              maxIter=100)
        feats = rff.transform(x).select("features", "y").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = lr.fit(feats)
        finally:
            feats.unpersist()
        from pyspark.ml import PipelineModel
        return PipelineModel(stages=[pre, rff, model])


#: Folds fitted at once.
FOLD_PARALLELISM = 4


def fold_rmse(df: DataFrame, make_pipeline, k: int, fold_col: str = "fold", parallelism: int = FOLD_PARALLELISM):
    """Per-fold RMSE of a pipeline refitted on the other folds."""
    data = df.persist(StorageLevel.MEMORY_AND_DISK)

    def one(j):
        model = make_pipeline().fit(data.filter(F.col(fold_col) != j))
        pred = model.transform(data.filter(F.col(fold_col) == j))
        return j, pred.agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as ex:
            out = sorted(ex.map(one, range(k)))
    finally:
        data.unpersist()
    return out


def oof_prediction(df: DataFrame, make_pipeline, k: int, fold_col: str = "fold", parallelism: int = FOLD_PARALLELISM,
                   key: str = "id") -> DataFrame:
    """Out-of-fold predictions (id, prediction) as a union of fold outputs."""
    def one(j):
        model = make_pipeline().fit(df.filter(F.col(fold_col) != j))
        return model.transform(df.filter(F.col(fold_col) == j)).select(key, "prediction")

    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        parts = list(ex.map(one, range(k)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
