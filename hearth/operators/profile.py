"""Profiles of a listing table (survey 2.5, A1–A11).

Every profile is one wide aggregate over the table (partial aggregation on
the map side, a single tiny shuffle), turned into a long table with
``unpivot``. Nothing is collected row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import rnd
from .clean import column_roles


def _long(wide: DataFrame, cols: list[str], name: str, value: str) -> DataFrame:
    return wide.unpivot([], cols, name, value)


def missing_profile(df: DataFrame, top: int = 20) -> DataFrame:
    """Columns with gaps: count and percent of rows, largest first, top ``top``."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["__n"], cols, "column", "missing_count").select(
        "column", F.col("missing_count").cast("bigint").alias("missing_count"),
        rnd(F.col("missing_count") * 100.0 / F.col("__n"), 6).alias("missing_percent"))
    return (long.filter(F.col("missing_count") > 0)
            .orderBy(F.desc("missing_count"), F.asc("column")).limit(top))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, r in column_roles(df, exclude=()).items() if r == "numeric"]


def target_correlation(df: DataFrame, target: str = "sale_price", top: int = 20) -> DataFrame:
    """|Pearson r| of every numeric column with the target, pairwise-complete
    (SQL ``corr`` skips a row with a null on either side). The target itself
    is listed with 1.0, as in the reference output."""
    cols = numeric_columns(df)
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c)
                    for c in cols])
    long = _long(wide, cols, "column", "r").select(
        "column", rnd(F.abs("r"), 6).alias("abs_corr"))
    return long.filter(F.col("abs_corr").isNotNull()) \
        .orderBy(F.desc("abs_corr"), F.asc("column")).limit(top)


def correlation_matrix(df: DataFrame, target: str = "sale_price", top: int = 11) -> DataFrame:
    """Pairwise correlations of the target and its ``top - 1`` best columns.
    The column choice is a bounded (``top``-row) driver read; the matrix is
    one more aggregate."""
    best = [r["column"] for r in target_correlation(df, target, top).collect()]
    pairs = [(a, b) for i, a in enumerate(best) for b in best[i:]]  # the other half is the mirror image
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}||{b}")
                    for a, b in pairs])
    long = _long(wide, [f"{a}||{b}" for a, b in pairs], "pair", "r")
    parts = F.split(F.col("pair"), r"\|\|")
    one = F.struct(parts[0].alias("col_a"), parts[1].alias("col_b"))
    two = F.struct(parts[1].alias("col_a"), parts[0].alias("col_b"))
    both = F.when(parts[0] == parts[1], F.array(one)).otherwise(F.array(one, two))
    return long.select(F.explode(both).alias("p"), rnd("r", 6).alias("corr")).select("p.col_a", "p.col_b", "corr")


def target_skew(df: DataFrame, target: str = "sale_price") -> DataFrame:
    """Sample skewness (bias-adjusted, as pandas) of the target and its log.
    Spark's ``skewness`` is the population form g1; G1 = g1·sqrt(n(n-1))/(n-2)."""
    n = F.count(F.col(target))
    adj = F.sqrt(n * (n - 1)) / (n - 2)
    return df.agg(rnd(F.skewness(target) * adj, 6).alias("skew_raw"),
                  rnd(F.skewness(F.log(target)) * adj, 6).alias("skew_log"))


def target_histogram(df: DataFrame, target: str = "sale_price", bins: int = 30) -> DataFrame:
    """Equal-width histogram of the target and of its log (plot data).
    Bin edges come from a one-row min/max aggregate joined back (broadcast of
    one row)."""
    vals = df.select(F.col(target).cast("double").alias("raw"),
                     F.log(F.col(target)).alias("log")) \
        .unpivot([], ["raw", "log"], "kind", "x").filter(F.col("x").isNotNull())
    rng = vals.groupBy("kind").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    w = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.floor((F.col("x") - F.col("lo")) / w), F.lit(bins - 1)).cast("int")
    return (vals.join(F.broadcast(rng), "kind")
            .withColumn("bin", F.when(w > 0, b).otherwise(F.lit(0)))
            .groupBy("kind", "bin")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 rnd(F.first("lo") + F.col("bin") * F.first(w), 6).alias("bin_lo")))


def scatter_bins(df: DataFrame, x: str = "area", y: str = "sale_price", x_width: float = 250.0,
                 y_width: float = 25000.0, color: str = "overall_qual") -> DataFrame:
    """2-D binned counts of area × price with the mean quality per cell."""
    return (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(F.floor(F.col(x) / x_width).cast("bigint").alias("x_bin"),
                     F.floor(F.col(y) / y_width).cast("bigint").alias("y_bin"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 rnd(F.avg(color), 6).alias("mean_color")))


def category_dictionary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sorted distinct values per categorical column, with their 0-based code
    and count (null is not a level). The window runs over (column, level)
    pairs, whose number is bounded by the levels, not by the rows."""
    long = df.select(*cols).unpivot([], cols, "column", "level").filter(F.col("level").isNotNull())
    counts = long.groupBy("column", "level").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    w = Window.partitionBy("column").orderBy("level")
    return counts.withColumn("code", (F.row_number().over(w) - 1).cast("int"))
