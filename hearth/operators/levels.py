"""Encodings of categories with any number of levels (survey T5, T6).

A fitted encoder with few levels is a literal map in the plan; one with more keeps its levels as a table of
(column, level, value) that rows are joined with, so that levels pass neither the driver nor the plan.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranks import with_rank

#: Levels of a column up to which a literal map is used.
LITERAL_LEVELS = 1000


def long_levels(df: DataFrame, cols) -> DataFrame:
    """(column, level) of every distinct non-null level."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return text.unpivot([], list(cols), "column", "level").filter("level is not null").distinct()


def ordinal_codes(df: DataFrame, cols) -> DataFrame:
    """(column, level, value): the place of each level in the order of its column's levels, from 0. A written table."""
    ranked = with_rank(long_levels(df, cols), "column", "level")
    first = ranked.groupBy("column").agg(F.min("rank").alias("first"))  # one row a column
    return ranked.join(F.broadcast(first), "column").select("column", "level", (F.col("rank") - F.col("first")).cast("double").alias("value"))


def most_levels(table: DataFrame) -> int:
    return table.groupBy("column").count().agg(F.max("count")).first()[0] or 0


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table(self.sparkSession).write.parquet(f"{path}/levels")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        out = self.cls()
        DefaultParamsReader.getAndSetParams(out, DefaultParamsReader.loadMetadata(path, self.sparkSession))
        return out._set(path=f"{path}/levels")


class LevelTableModel(Model, MLWritable, MLReadable):
    """Adds column + suffix: the level's value in the table, or ``default`` for null and unknown levels."""

    path = Param(Params._dummy(), "path", "table of (column, level, value)", typeConverter=TypeConverters.toString)
    cols = Param(Params._dummy(), "cols", "encoded columns", typeConverter=TypeConverters.toListString)
    suffix = Param(Params._dummy(), "suffix", "of the added columns", typeConverter=TypeConverters.toString)
    default = Param(Params._dummy(), "default", "value of other levels", typeConverter=TypeConverters.toFloat)

    def __init__(self, path: str = "", cols=(), suffix: str = "", default: float = 0.0):
        super().__init__()
        self._set(path=path, cols=list(cols), suffix=suffix, default=float(default))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("column string, level string, value double").parquet(self.getOrDefault(self.path))

    def _transform(self, df: DataFrame) -> DataFrame:
        table, suffix = self.table(df.sparkSession), self.getOrDefault(self.suffix)
        keep = list(df.columns)
        for c in self.getOrDefault(self.cols):
            one = table.filter(F.col("column") == c).select(F.col("level").alias("__level"), F.col("value").alias("__value"))
            # rows without a level stay out of the exchange, in which they would meet in one task
            known = df.filter(F.col(c).isNotNull()).join(one, F.col(c).cast("string") == F.col("__level"), "left")
            absent = df.filter(F.col(c).isNull()).withColumns({"__level": F.lit(None).cast("string"), "__value": F.lit(None).cast("double")})
            keep.append(c + suffix)
            df = known.unionByName(absent).withColumn(c + suffix, F.coalesce("__value", F.lit(self.getOrDefault(self.default)))).select(*keep)
        return df

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)
