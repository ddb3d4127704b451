"""Feature transformers as ``pyspark.ml`` Estimator/Model pairs (survey 2.10).

Each ``fit`` is one aggregate over the training rows (partial aggregation on
the map side); each fitted model is a handful of literals applied with
column expressions, so ``transform`` stays inside whole-stage codegen.
MLlib's own ``Imputer`` (median differs from the interpolated median on even
counts, rejects strings) and ``StandardScaler`` (sample std) do not match the
reference's semantics, hence these small estimators.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from ..session import scratch_path, written
from .levels import LITERAL_LEVELS, LevelTableModel, most_levels, ordinal_codes
from .selection import exact_medians_by_set


class _StateModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted values kept as one JSON param, so the model saves and loads with
    ``PipelineModel.write()`` / ``PipelineModel.load`` like MLlib stages."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, **values):
        super().__init__()
        self._setDefault(state="{}")
        if values:
            self._set(state=json.dumps(values))

    @property
    def s(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class MedianImputerModel(_StateModel):
    @property
    def medians(self) -> dict:
        return self.s.get("medians", {})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m))
                               for c, m in self.medians.items()})


def exact_medians(df: DataFrame, cols) -> dict:
    """Exact (interpolated) medians of many columns: values of whole-number types are
    counted per (column, value) with partial aggregation, and each column's
    median is read off cumulative counts in its own window partition; columns of
    a fractional type are settled by digit counts, as they may hold a value a row."""
    fractional = [c for c in cols if isinstance(df.schema[c].dataType, TY.FractionalType)]
    if fractional:
        out = dict.fromkeys(cols)
        out.update(exact_medians_by_set(df, fractional)[-1])
        rest = [c for c in cols if c not in fractional]
        out.update(exact_medians(df, rest) if rest else {})
        return out
    items = [F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("x")) for c in cols]
    cnt = df.select(F.explode(F.array(*items)).alias("v")).select("v.col", "v.x") \
        .filter(F.col("x").isNotNull()).groupBy("col", "x").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("col").orderBy("x")
    cnt = cnt.withColumn("cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("tot", F.sum("n").over(Window.partitionBy("col")))
    p1, p2 = F.floor((F.col("tot") + 1) / 2), F.floor(F.col("tot") / 2) + 1
    rows = cnt.groupBy("col").agg(((F.min(F.when(F.col("cum") >= p1, F.col("x")))
                                    + F.min(F.when(F.col("cum") >= p2, F.col("x")))) / 2).alias("m")).collect()  # per column
    out = {c: None for c in cols}
    out.update({r["col"]: float(r["m"]) for r in rows})
    return out


class MedianImputer(Estimator):
    """Null → median of the training column (interpolated on even counts)."""

    def __init__(self, cols):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        return MedianImputerModel(medians=exact_medians(df, self.cols))


class ModeImputerModel(_StateModel):
    @property
    def modes(self) -> dict:
        return self.s.get("modes", {})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast(df.schema[c].dataType)) for c, m in self.modes.items()})


class ModeImputer(Estimator):
    """Null → most frequent value; ties go to the smallest value. Values are
    counted per (column, value) first, so no task holds all values of a column."""

    def __init__(self, cols):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        modes = dict.fromkeys(self.cols)
        if self.cols:
            long = df.select(*[F.col(c).cast("string").alias(c) for c in self.cols]).unpivot([], self.cols, "column", "level")
            counts = long.filter(F.col("level").isNotNull()).groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
            top = counts.groupBy("column").agg(F.min_by("level", F.struct((-F.col("n")).alias("n"), "level")).alias("mode"))
            modes.update({r["column"]: r["mode"] for r in top.collect()})  # one row per column
        return ModeImputerModel(modes=modes)


class PopulationScalerModel(_StateModel):
    @property
    def stats(self) -> dict:
        return self.s.get("stats", {})

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(mu)) / F.lit(sd)
                               for c, (mu, sd) in self.stats.items()})


class PopulationScaler(Estimator):
    """(x − mean) / population std; a zero-variance column is divided by 1."""

    def __init__(self, cols):
        super().__init__()
        self.cols = list(cols)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        aggs = []
        for c in self.cols:
            aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s")]
        row = df.agg(*aggs).first()
        stats = {}
        for c in self.cols:
            if row[f"{c}__m"] is None:  # no value to scale by: the column stays null
                continue
            sd = row[f"{c}__s"]
            stats[c] = (float(row[f"{c}__m"]), float(sd) if sd else 1.0)
        return PopulationScalerModel(stats=stats)


class OrdinalEncoderModel(_StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        st = self.s
        suffix = st.get("suffix", "_ord")
        for c, lv in st.get("levels", {}).items():
            m = F.create_map(*[x for i, v in enumerate(lv) for x in (F.lit(v), F.lit(float(i)))])
            out[c + suffix] = F.coalesce(m[F.col(c)], F.lit(-1.0)) if lv else F.lit(-1.0)
        return df.withColumns(out)


class OrdinalEncoder(Estimator):
    """Lexicographic codes 0..k-1 of the training levels; unseen (or null) → −1."""

    def __init__(self, cols, suffix: str = "_ord", literal_levels: int = LITERAL_LEVELS):
        super().__init__()
        self.cols, self.suffix, self.literal_levels = list(cols), suffix, literal_levels

    def _fit(self, df: DataFrame):
        codes = ordinal_codes(df, self.cols)
        if most_levels(codes) > self.literal_levels:
            return LevelTableModel(_kept_table(codes), self.cols, self.suffix, -1.0)
        levels: dict = {c: [] for c in self.cols}
        for r in codes.orderBy("column", "value").collect():  # at most literal_levels a column
            levels[r["column"]].append(r["level"])
        return OrdinalEncoderModel(levels=levels, suffix=self.suffix)


def _kept_table(table: DataFrame) -> str:
    path = scratch_path(table.sparkSession, "levels")
    table.select("column", "level", "value").write.parquet(path)
    return path


def one_hot_stages(cols, suffix: str = "_oh"):
    """StringIndexer(alphabetAsc, keep) + OneHotEncoder(dropLast): the k seen
    levels get their own slot; an unseen level falls in the dropped last slot,
    i.e. an all-zero block, as ``handle_unknown='ignore'`` does."""
    idx = StringIndexer(inputCols=list(cols), outputCols=[c + "_idx" for c in cols],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    ohe = OneHotEncoder(inputCols=[c + "_idx" for c in cols], outputCols=[c + suffix for c in cols],
                        dropLast=True)
    return [idx, ohe]


class FillMissingModel(_StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.s
        return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(st["token"])) for c in st["cols"]})


class FillMissingStage(Estimator):
    """Categories as text, null → 'Missing' (the tree view); nothing to fit."""

    def __init__(self, cols, token: str = "Missing"):
        super().__init__()
        self.cols, self.token = list(cols), token

    def _fit(self, df: DataFrame) -> FillMissingModel:
        return FillMissingModel(cols=self.cols, token=self.token)


class TargetEncoderModel(_StateModel):
    """Encodings per (column, level) — one entry per level, bounded by the
    category dictionary — applied as literal map lookups."""

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.s
        out = {}
        for c in st["cols"]:
            enc = st["enc"].get(c, {})
            pairs = [x for lv, v in enc.items() for x in (F.lit(lv), F.lit(float(v)))]
            looked = F.create_map(*pairs)[F.col(c)] if pairs else F.lit(None).cast("double")
            out[c + st["suffix"]] = F.coalesce(looked, F.lit(st["prior"]))
        return df.withColumns(out)


def target_encoding_stats(df: DataFrame, cols, target: str, fold_col: str | None = None) -> DataFrame:
    """Empirical-Bayes encodings per (column, level) — and per held-out fold when
    ``fold_col`` is given (statistics of all *other* folds: total − fold).
    λ = n·σ²_y / (n·σ²_y + σ²_level), enc = λ·mean_level + (1−λ)·mean_y, with
    population variances; σ²_level = 0 gives λ = 1."""
    keys = [fold_col] if fold_col else []
    long = df.select(*keys, F.col(target).cast("double").alias("y"), *cols) \
        .unpivot([*keys, "y"], list(cols), "column", "level")
    cell = long.groupBy("column", "level", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss"))
    glob = df.select(*keys, F.col(target).cast("double").alias("y")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("gn"), F.sum("y").alias("gs"), F.sum(F.col("y") * F.col("y")).alias("gss"))
    if fold_col:
        # leave-fold-out: totals over all folds minus the fold's own sums; the
        # window spans the k folds of one (column, level), a bounded group
        w = Window.partitionBy("column", "level")
        cell = cell.select("column", "level", fold_col,
                           *[(F.sum(x).over(w) - F.col(x)).alias(x) for x in ("n", "s", "ss")])
        wg = Window.partitionBy()
        glob = glob.select(fold_col, *[(F.sum(x).over(wg) - F.col(x)).alias(x) for x in ("gn", "gs", "gss")])
        cell = cell.join(F.broadcast(glob), fold_col)
    else:
        g = glob.first()  # one row of three sums
        cell = cell.withColumns({"gn": F.lit(g["gn"]), "gs": F.lit(g["gs"]), "gss": F.lit(g["gss"])})
    mean = F.col("s") / F.col("n")
    var = F.greatest(F.col("ss") / F.col("n") - mean * mean, F.lit(0.0))
    gmean = F.col("gs") / F.col("gn")
    gvar = F.greatest(F.col("gss") / F.col("gn") - gmean * gmean, F.lit(0.0))
    mean = F.when(F.col("n") > 0, mean)
    lam = F.when(F.col("n") * gvar + var > 0, F.col("n") * gvar / (F.col("n") * gvar + var)).otherwise(F.lit(1.0))
    enc = F.coalesce(lam * mean + (1 - lam) * gmean, gmean)
    return cell.select("column", "level", *keys, enc.alias("enc"),
                       gmean.alias("prior"))


class TargetEncoder(Estimator):
    """Fit on all training rows (used at scoring time)."""

    def __init__(self, cols, target: str, suffix: str = "_te", literal_levels: int = LITERAL_LEVELS):
        super().__init__()
        self.cols, self.target, self.suffix, self.literal_levels = list(cols), target, suffix, literal_levels

    def _fit(self, df: DataFrame):
        known = df.filter(F.col(self.target).isNotNull())
        prior = float(known.agg(F.avg(self.target)).first()[0])
        stats = written(target_encoding_stats(known, self.cols, self.target).filter("level is not null")
                        .select("column", "level", F.col("enc").alias("value")), "encodings")
        if most_levels(stats) > self.literal_levels:
            return LevelTableModel(_kept_table(stats), self.cols, self.suffix, prior)
        enc: dict = {}
        for r in stats.collect():  # at most literal_levels a column
            enc.setdefault(r["column"], {})[r["level"]] = r["value"]
        return TargetEncoderModel(cols=self.cols, enc=enc, prior=prior, suffix=self.suffix)


def linear_pipeline(num_cols, cat_cols, out: str = "features") -> Pipeline:
    """median → population scaling for numerics ∥ mode → one-hot for categories."""
    return Pipeline(stages=[MedianImputer(num_cols), PopulationScaler(num_cols), ModeImputer(cat_cols),
                            *one_hot_stages(cat_cols),
                            VectorAssembler(inputCols=list(num_cols) + [c + "_oh" for c in cat_cols],
                                            outputCol=out)])


def tree_pipeline(num_cols, cat_cols, out: str = "features") -> Pipeline:
    """median for numerics ∥ mode → one-hot for categories, no scaling."""
    return Pipeline(stages=[MedianImputer(num_cols), ModeImputer(cat_cols), *one_hot_stages(cat_cols),
                            VectorAssembler(inputCols=list(num_cols) + [c + "_oh" for c in cat_cols],
                                            outputCol=out)])


def ordinal_pipeline(num_cols, cat_cols, out: str = "features") -> Pipeline:
    """median for numerics ∥ mode → ordinal codes (−1 unseen) for categories."""
    return Pipeline(stages=[MedianImputer(num_cols), ModeImputer(cat_cols), OrdinalEncoder(cat_cols),
                            VectorAssembler(inputCols=list(num_cols) + [c + "_ord" for c in cat_cols],
                                            outputCol=out)])


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, from its ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = [a for group in meta.values() for a in group]
    return [a["name"] for a in sorted(slots, key=lambda a: a["idx"])]
