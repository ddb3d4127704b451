"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.session import scratch_path

#: ASCII white space; a word is a maximal run of anything else.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = f"[{SPACE_CLASS}]+"
WORD = f"[^{SPACE_CLASS}]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared checkpoint folder, read it back.

    The files are on storage that every executor sees, so a lost executor costs
    only the tasks that ran on it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words of a text (null: empty array)."""
    # split, then drop the empty ends: a pattern anchored at the end takes quadratic time on runs of blanks
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


#: Arrays that grow in an accumulator are kept in runs of this length: a growing array is copied at each step.
RUN = 256


def running(values: Column, combine: Callable[[Column, Column], Column], zero: int) -> Column:
    """Running totals of an array of bigint under ``combine``, each with its own element included.

    Totals run inside runs of ``RUN`` elements, and over the runs, so that no long array is copied once per element.
    """
    def totals(a: Column, with_own: bool) -> Column:
        start = F.struct(F.lit(zero).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            return let(combine(acc["at"], x), lambda y: F.struct(
                y.alias("at"), F.concat(acc["out"], F.array(y if with_own else acc["at"])).alias("out")))
        return F.aggregate(a, start, step)["out"]

    def joined(runs: Column) -> Column:
        before = totals(F.transform(runs, lambda r: F.element_at(r, -1)), False)
        return F.flatten(F.zip_with(runs, before, lambda r, b: F.transform(r, lambda x: combine(x, b))))

    def cut(a: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / RUN).cast("int")),
                           lambda k: totals(F.slice(a, k * RUN + 1, RUN), True))
        return let(runs, joined)

    return let(F.transform(values, lambda x: x.cast("bigint")),
               lambda a: F.when(F.size(a) > 0, cut(a)).otherwise(F.array().cast("array<bigint>")))


def prefix_sums(values: Column) -> Column:
    """Running sums of an array of integers."""
    return running(values, lambda a, b: a + b, 0)


def prefix_maxima(values: Column) -> Column:
    """Running maxima of an array of integers."""
    return running(values, F.greatest, -(1 << 62))


def word_count(text: Column) -> Column:
    """Number of words as long, without building them (null: 0)."""
    t = F.coalesce(text, F.lit(""))
    return F.regexp_count(t, F.lit(WORD)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from hearth.sources.tables import read_table
    return read_table(spark, sf_dir, name)
