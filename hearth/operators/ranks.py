"""Row numbers over a whole table without a single-task sort (survey K1, X1).

A range sort deals the rows; they are numbered inside each partition, and one
row count per partition (the only thing the driver sees) completes the numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hash_int
from ..session import written

_AT, _PART, _START = "__at", "__part", "__start"


def with_rank(df: DataFrame, *order, col: str = "rank") -> DataFrame:
    """Adds ``col``: 0 … n−1 in the given order (of equal rows either comes first). The result is a written table."""
    s = df.repartitionByRange(*order).sortWithinPartitions(*order)
    s = written(s.withColumn(_AT, F.monotonically_increasing_id()), "ranked")
    part = F.shiftright(_AT, 33)
    starts, n = [], 0
    counts = s.groupBy(part.alias("p")).count().collect()  # one row per partition
    for r in sorted(counts, key=lambda r: r["p"]):
        starts.append((r["p"], n))
        n += r["count"]
    table = F.broadcast(df.sparkSession.createDataFrame(starts, f"{_PART} long, {_START} long"))
    inside = F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))
    return s.withColumn(_PART, part).join(table, _PART).withColumn(col, F.col(_START) + inside).drop(_AT, _PART, _START)


def balanced_folds(df: DataFrame, k: int = 5, seed: int = 42, key: str = "id", col: str = "fold") -> DataFrame:
    """Seeded folds whose sizes differ by at most 1: the place of a row in the order of its key's hash, modulo ``k``."""
    ranked = with_rank(df, hash_int(key, f"balanced{seed}"), F.col(key), col=col)
    return ranked.withColumn(col, (F.col(col) % k).cast("int"))
