"""Mixing sources to target weights (operator 9).

Words are summed per source, the target of each source follows from its weight
(water-filling under a cap on repetition), and every document is then emitted
``floor(rate)`` times plus one hash-seeded Bernoulli copy with probability equal
to the fraction of the rate.  Two passes over the documents, one aggregate on the
source (map-side partial sums, so a source with a third of the rows is no hot
task) and a join with the per-source table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import word_count, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3.0


def source_ranks(sources: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0): code-point order of ``source``, null last; no single-task sort.

    A range sort numbers the rows inside each partition; only one row count per
    partition goes to the driver.
    """
    s = (sources.repartitionByRange(F.asc_nulls_last("source"))
         .sortWithinPartitions(F.asc_nulls_last("source"))
         .withColumn("_m", F.monotonically_increasing_id()))
    s = written(s, "mix-sources")  # the numbering is fixed before it is used
    part = F.shiftright("_m", 33)
    counts = s.groupBy(part.alias("p")).count().collect()  # one row per partition
    first, start = [0] * (1 + max((r["p"] for r in counts), default=0)), 0
    for r in sorted(counts, key=lambda r: r["p"]):
        first[r["p"]] = start
        start += r["count"]
    base = F.element_at(F.array(*[F.lit(x) for x in first]), (part + 1).cast("int"))
    return s.withColumn("rank", (base + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop("_m")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS,
                   max_repeat: float = MAX_REPEAT, share: float = 1.0) -> DataFrame:
    """(source, source_size) → adds ``target``.

    Sources in code-point order (null last) take the weights in turn and share
    ``share`` of the total.  A target above ``max_repeat`` times its source stops
    there; what is left is dealt again by weight among the others until no target
    is above.  Only sums over the source table reach the driver.
    """
    ranked = source_ranks(sizes)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = ranked.withColumn("weight", w).withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    total = float(total) * share
    # a source is full when weight * level reaches its cap; the level only rises, so full sources stay full
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= F.col("cap")
        r = s.agg(F.sum(F.when(full, F.col("cap"))).alias("capped"),
                  F.sum(F.when(~full, F.col("weight"))).alias("free")).first()
        if not r["free"]:
            break  # all sources are full
        new = max(total - (r["capped"] or 0.0), 0.0) / r["free"]
        if level is not None and new <= level:
            break
        level = new
    target = F.least(F.col("weight") * F.lit(level if level is not None else 0.0), F.col("cap"))
    if level is None or not total:
        target = F.lit(0.0)
    return s.select("source", "source_size", target.cast("double").alias("target"))


def copies(rate: Column, seed: int, *key: Column) -> Column:
    """floor(rate), plus one more with probability frac(rate): the first 60 bits of an md5 decide."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in key])
    u = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("double") / F.lit(float(1 << 60))
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _planned(docs: DataFrame, weights: Sequence[float], max_repeat: float, seed: int) -> DataFrame:
    """(row, size, source_size, target, n_copies) of every row, the row as one struct."""
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").alias("own_source"),
                        F.col("doc_id").alias("key"), word_count(F.col("text")).alias("size"))
    per_source = sized.groupBy(F.col("own_source").alias("source")).agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(per_source, weights, max_repeat), "mix-targets")
    j = sized.join(targets, F.col("own_source").eqNullSafe(F.col("source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return j.withColumn("n_copies", copies(rate, seed, F.col("key")))


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT,
             seed: int = 17) -> DataFrame:
    """Rows of ``docs`` with size, source_size, target, n_copies and taken added.

    Sizes count words of whole texts (null text: 0).  A null source is a source of
    its own.  Every row is kept; repeated rows are decided alike; a source without
    words has target 0 and none of its rows is taken.  A seed fixes the result.
    Columns of ``docs`` with the names of those added are replaced; ``mix`` keeps them.
    """
    plan = _planned(docs, weights, max_repeat, seed)
    added = ("size", "source_size", "target", "n_copies")
    own = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in (*added, "taken")]
    return plan.select(*own, *added, (F.col("size") * F.col("n_copies")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT,
        seed: int = 17) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as its source's rate asks, with all its columns."""
    plan = _planned(docs, weights, max_repeat, seed).filter(F.col("n_copies") > 0)
    each = plan.select("row", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))).alias("copy"))
    return each.select(*[F.col("row")[c].alias(c) for c in docs.columns])
