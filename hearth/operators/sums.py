"""Sums of long vectors that every task has one of, in two levels."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of tasks whose partial sums are added first.
REDUCE_GROUPS = 64


def sum_blocks(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of the arrays ``v`` by ``keys``, as vectors: over groups of tasks first, then over the groups, so that no
    reducer gets a row from every task."""
    group = F.spark_partition_id() % REDUCE_GROUPS
    add = Summarizer.sum(F.col("v")).alias("v")
    some = parts.withColumn("v", array_to_vector("v")).withColumn("group", group).groupBy(*keys, "group").agg(add)
    return some.groupBy(*keys).agg(add)
