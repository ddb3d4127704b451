"""Fold assignment (survey 2.9).

Folds come from a seeded hash of the row key, so they are stable across
re-runs and executors, need no global sort or shuffle, and DuckDB can
reproduce them (``hash_int_sql``). Fold sizes are equal in expectation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_int, hash_int_sql


def fold_col(key: str = "id", k: int = 5, seed: int = 42, salt: str = "fold"):
    return (hash_int(key, f"{salt}{seed}") % k).cast("int")


def fold_sql(key: str = "id", k: int = 5, seed: int = 42, salt: str = "fold") -> str:
    return f"CAST({hash_int_sql(key, f'{salt}{seed}')} % {k} AS INTEGER)"


def assign_folds(df: DataFrame, k: int = 5, seed: int = 42, key: str = "id",
                 col: str = "fold") -> DataFrame:
    return df.withColumn(col, fold_col(key, k, seed))


def assign_inner_folds(df: DataFrame, k: int = 3, seed: int = 42, key: str = "id",
                       col: str = "inner") -> DataFrame:
    """Second, independent split used by searches nested inside an outer fold."""
    return df.withColumn(col, fold_col(key, k, seed, salt="inner"))


def fold_split_counts(df: DataFrame, col: str = "fold") -> DataFrame:
    """Train / validation sizes per fold: validation = the fold, train = the rest."""
    per = df.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("n_valid"))
    total = F.sum("n_valid").over(Window.partitionBy())
    return per.select(F.col(col).alias("fold"), "n_valid", (total - F.col("n_valid")).alias("n_train"))
