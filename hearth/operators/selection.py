"""Exact medians of many columns and training sets at once, by counting digits (survey A8, T1).

A double is read as a 64-bit number in the same order, and its digits are settled from the highest on: a round
counts, for every fold and column, the next digit of the values that share the digits found so far (a task counts
its rows first, and a digit has at most 2^13 values), and moves every wanted rank into one of them. Five rounds
settle any double; a round that finds one value left in a rank's bucket ends its search. No task reads a whole
column, and only the ranks' digits reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the digits: sign and exponent, then the mantissa.
DIGITS = (12, 13, 13, 13, 13)
ALL = -1


def _ordered(x: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers in the same order."""
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def _double(u: int) -> float:
    bits = u & ((1 << 63) - 1) if u >> 63 else ~u & ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def exact_medians_by_set(df: DataFrame, cols, fold_col: str | None = None, k: int = 0) -> dict[int, dict[str, float | None]]:
    """{set: {column: median}}: set -1 is all rows, set j all rows but fold j. Interpolated on even counts; nulls and
    NaN take no part, a column without a value has no median."""
    cols = list(cols)
    sets = [ALL, *range(k)] if fold_col else [ALL]
    out: dict[int, dict[str, float | None]] = {t: dict.fromkeys(cols) for t in sets}
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    rows = df.select(fold.alias("__fold"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    # (set, column, which of the two middle ranks) -> (digits found, rank among the values that have them)
    wanted: dict[tuple[int, int, int], tuple[int, int]] = {}
    found: dict[tuple[int, int, int], float] = {}
    spark = df.sparkSession
    done_bits = 0
    for bits in DIGITS:
        prefixes = {i: sorted({p for (_, c, _), (p, _) in wanted.items() if c == i}) for i in range(len(cols))} if done_bits else None
        counts = rows.mapInPandas(_counter(len(cols), prefixes, done_bits, bits), "fold int, col int, prefix string, digit int, n long, lo string, hi string")
        counts = counts.groupBy("fold", "col", "prefix", "digit").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        by_set = counts.withColumn("t", F.explode(F.array([F.lit(t) for t in sets]))).filter("t <> fold").groupBy(
            "t", "col", "prefix", "digit").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        w = Window.partitionBy("t", "col", "prefix")  # at most 2^13 digits
        cum = by_set.withColumn("upto", F.sum("n").over(w.orderBy("digit"))).withColumn("total", F.sum("n").over(w))
        if not done_bits:
            ranks = F.explode(F.array(F.struct(F.lit(0).alias("which"), F.floor((F.col("total") + 1) / 2).alias("rank")),
                                      F.struct(F.lit(1).alias("which"), (F.floor(F.col("total") / 2) + 1).alias("rank"))))
            at = cum.withColumn("r", ranks).select("*", "r.which", "r.rank").drop("r")
        else:
            table = spark.createDataFrame([(t, c, f"{p:016x}", which, r) for (t, c, which), (p, r) in wanted.items()],
                                          "t int, col int, prefix string, which int, rank long")
            at = cum.join(F.broadcast(table), ["t", "col", "prefix"])  # two rows a set and column
        hit = at.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        wanted = {}
        for r in hit.collect():  # two rows a set and column
            key, prefix = (r["t"], r["col"], r["which"]), int(r["prefix"], 16) << bits | r["digit"]
            if r["lo"] == r["hi"]:
                found[key] = _double(int(r["lo"], 16))
            else:
                wanted[key] = prefix, r["rank"] - (r["upto"] - r["n"])
        done_bits += bits
        if not wanted:
            break
    for t in sets:
        for i, c in enumerate(cols):
            if (t, i, 0) in found:
                out[t][c] = (found[t, i, 0] + found[t, i, 1]) / 2
    return out


def _counter(n_cols: int, prefixes: dict[int, list[int]] | None, done_bits: int, bits: int):
    """Counts of a task by fold, column, digits so far and next digit, with the least and greatest value."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fold = pdf["__fold"].to_numpy()
            for i in range(n_cols):
                x = pdf[f"c{i}"].to_numpy(dtype=float, na_value=np.nan)
                ok = ~np.isnan(x) & ~pd.isna(fold)
                u, f = _ordered(x[ok]), fold[ok].astype(np.int64)
                for p in [0] if prefixes is None else prefixes[i]:
                    if done_bits:
                        same = u >> np.uint64(64 - done_bits) == np.uint64(p)
                        v, g = u[same], f[same]
                    else:
                        v, g = u, f
                    if not len(v):
                        continue
                    digit = (v >> np.uint64(64 - done_bits - bits)) & np.uint64((1 << bits) - 1)
                    order = np.lexsort((v, digit, g))
                    v, g, digit = v[order], g[order], digit[order].astype(np.int64)
                    new = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (digit[1:] != digit[:-1])))
                    ends = np.append(new[1:], len(v))
                    yield pd.DataFrame({"fold": g[new], "col": i, "prefix": f"{p:016x}", "digit": digit[new], "n": ends - new,
                                        "lo": [f"{a:016x}" for a in v[new].tolist()], "hi": [f"{a:016x}" for a in v[ends - 1].tolist()]})
    return count
