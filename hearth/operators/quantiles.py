"""Exact quantiles of a column without gathering its values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def exact_quantiles(df: DataFrame, value, probs: Sequence[float]) -> list[float | None]:
    """Linearly interpolated quantiles (nulls skipped; all null or empty: None).

    A range sort numbers the values; one count per partition and two values per
    quantile go to the driver.
    """
    spark = df.sparkSession
    v = df.select((F.col(value) if isinstance(value, str) else value).cast("double").alias("v")).filter("v is not null")
    path = scratch_path(spark, "quantiles")
    (v.repartitionByRange("v").sortWithinPartitions("v").withColumn("m", F.monotonically_increasing_id())
     .write.parquet(path))  # the numbering is fixed before it is used
    s = spark.read.schema("v double, m long").parquet(path)
    counts = sorted((r["p"], r["count"]) for r in s.groupBy(F.shiftright("m", 33).alias("p")).count().collect())
    n = sum(c for _, c in counts)
    if not n:
        return [None] * len(probs)

    def number(rank: int) -> int:
        for p, c in counts:
            if rank < c:
                return (p << 33) + rank
            rank -= c
        raise IndexError(rank)

    ends = [((n - 1) * q, number(math.floor((n - 1) * q)), number(math.ceil((n - 1) * q))) for q in probs]
    wanted = sorted({m for _, a, b in ends for m in (a, b)})
    at = {r["m"]: r["v"] for r in s.filter(F.col("m").isin(wanted)).collect()}
    return [at[a] + (h - math.floor(h)) * (at[b] - at[a]) for h, a, b in ends]
