"""Fitted regressors as ``pyspark.ml`` models that save, load and chain (survey M12–M17, S10).

``LinearFormula`` is a linear model fitted from fold statistics, as column expressions over raw
columns. ``Branches`` holds several fitted models and adds their predictions up by weight: a blend,
a stack (weights of its meta model) and the two-model ensemble are all one of these.
"""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import expm1_target, inverse_log, log1p_target, log_target
from .transformers import _StateModel

#: Target transforms with their inverses.
TARGETS = {"log": (log_target, inverse_log), "log1p": (log1p_target, expm1_target)}


class LinearFormula(_StateModel):
    """State: intercept, numeric [[name, weight, median, mean, scale]], categorical {name: {mode, weights}}."""

    @classmethod
    def of(cls, cv, spec, fold: int | None = None) -> LinearFormula:
        """The model that ``spec`` gives on the rows outside ``fold`` (None: on all) of a ``LinearCV``."""
        tf, b0, b = cv.fit(spec, fold)
        numeric = [[c, float(b[j]), tf.medians.get(c), float(tf.means[c]), float(tf.scales[c])] for j, c in enumerate(cv.numeric)]
        at, categorical = len(cv.numeric), {}
        for c in cv.categorical:
            kept = tf.kept[c]
            categorical[c] = {"mode": tf.modes[c], "weights": {x: float(w) for x, w in zip(kept, b[at:at + len(kept)])}}
            at += len(kept)
        return cls(intercept=float(b0), numeric=numeric, categorical=categorical)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.s
        out = F.lit(float(s["intercept"]))
        for c, w, median, mean, scale in s["numeric"]:
            x = F.col(c).cast("double")
            x = x if median is None else F.coalesce(x, F.lit(median))
            out = out + (x - F.lit(mean)) * F.lit(w / scale)
        for c, v in s["categorical"].items():
            if v["weights"]:
                m = F.create_map(*[F.lit(x) for pair in v["weights"].items() for x in pair])
                key = F.col(c) if v["mode"] is None else F.coalesce(F.col(c), F.lit(v["mode"]))
                out = out + F.coalesce(m[key], F.lit(0.0))
        return df.withColumn("prediction", out)


class _BranchesWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for i, m in enumerate(self.instance.branches):
            m.write().save(f"{path}/branch-{i}")


class _BranchesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls()
        DefaultParamsReader.getAndSetParams(out, metadata)
        out.branches = [PipelineModel.load(f"{path}/branch-{i}") for i in range(len(out.weights_))]
        return out


class Branches(Model, MLWritable, MLReadable):
    """prediction = intercept + Σ weight · prediction of the branch. Columns of the branches' inner stages stay inside."""

    weights = Param(Params._dummy(), "weights", "weight of each branch", typeConverter=TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "added to the sum", typeConverter=TypeConverters.toFloat)

    def __init__(self, branches=(), weights=(), intercept: float = 0.0):
        super().__init__()
        self.branches = [m if isinstance(m, PipelineModel) else PipelineModel(stages=[m]) for m in branches]
        self._set(weights=[float(w) for w in weights], intercept=float(intercept))

    @property
    def weights_(self) -> list[float]:
        return self.getOrDefault(self.weights)

    def each(self, df: DataFrame, names=None) -> DataFrame:
        """``df`` with the prediction of every branch as a column (``b0``, ``b1``, … unless named)."""
        return predictions(df, dict(zip(names or [f"b{i}" for i in range(len(self.branches))], self.branches)))

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [f"__branch{i}" for i in range(len(self.branches))]
        out = F.lit(self.getOrDefault(self.intercept))
        for w, c in zip(self.weights_, names):
            out = out + F.lit(w) * F.col(c)
        return self.each(df, names).select(*df.columns, out.alias("prediction"))

    def write(self) -> _BranchesWriter:
        return _BranchesWriter(self)

    @classmethod
    def read(cls) -> _BranchesReader:
        return _BranchesReader(cls)


def predictions(df: DataFrame, models: dict) -> DataFrame:
    """``df`` with one prediction column per model, in one chain of projections (no join)."""
    keep = list(df.columns)
    for name, m in models.items():
        df = m.transform(df).select(*keep, F.col("prediction").alias(name))
        keep.append(name)
    return df


def price_of(prediction, target: str = "log"):
    """The price that a prediction on the scale of ``target`` stands for."""
    return TARGETS[target][1](prediction)


def save(model, path: str) -> str:
    """Any fitted model as a saved ``PipelineModel``."""
    model = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
