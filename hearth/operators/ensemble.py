"""Out-of-fold bases, blends and stacks (survey J2, A14–A17, M12–M17).

Row-level work is column arithmetic on one frame; the only aggregates are
sums and per-group means, so every step is one pass with partial
aggregation. Blend weights and the meta model are chosen from a handful of
sums collected to the driver (a 21-point weight grid is a quadratic in w).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Blend-weight grid 0, 0.05, …, 1.0 (21 points).
BLEND_GRID = [round(i * 0.05, 2) for i in range(21)]


def group_mean_oof(df: DataFrame, group: str, target: str, fold_col: str = "fold") -> DataFrame:
    """Mean target of the row's group over the *other* folds; a group absent
    from the other folds falls back to their overall mean."""
    cell = df.groupBy(group, fold_col).agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("s"))
    w = Window.partitionBy(group)  # k rows per group
    cell = cell.select(group, fold_col, (F.sum("n").over(w) - F.col("n")).alias("n"),
                       (F.sum("s").over(w) - F.col("s")).alias("s"))
    glob = df.groupBy(fold_col).agg(F.count(F.lit(1)).alias("gn"), F.sum(target).alias("gs"))
    wg = Window.partitionBy()  # k rows
    glob = glob.select(fold_col, ((F.sum("gs").over(wg) - F.col("gs")) /
                                  (F.sum("gn").over(wg) - F.col("gn"))).alias("gmean"))
    stats = cell.join(glob, fold_col).select(
        group, fold_col, F.coalesce(F.when(F.col("n") > 0, F.col("s") / F.col("n")), F.col("gmean")).alias("__gm"))
    # every row's own (group, fold) cell exists; a null group is a group like any other
    stats = stats.withColumnsRenamed({group: "__g", fold_col: "__f"})
    own = df[group].eqNullSafe(F.col("__g")) & (df[fold_col] == F.col("__f"))
    return df.join(stats, own, "left").drop("__g", "__f").withColumnRenamed("__gm", "pred_group")


def group_mean_full(train: DataFrame, score: DataFrame, group: str, target: str) -> DataFrame:
    """Group mean over all training rows, overall mean for unseen groups."""
    gm = train.groupBy(group).agg(F.avg(target).alias("__gm"))
    overall = train.agg(F.avg(target)).first()[0]
    gm = gm.withColumnRenamed(group, "__g")
    return score.join(gm, score[group].eqNullSafe(F.col("__g")), "left").withColumn(
        "pred_group", F.coalesce(F.col("__gm"), F.lit(overall))).drop("__gm", "__g")


def rmse_col(y: str, p) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return F.sqrt(F.avg(F.pow(F.col(y) - p, 2)))


def blend_scores(df: DataFrame, y: str, a: str, b: str, grid=BLEND_GRID) -> DataFrame:
    """Pooled RMSE of w·a + (1−w)·b for every w of the grid from three sums
    (the squared error is a quadratic in w) — one aggregate, no row fan-out."""
    e, d = F.col(y) - F.col(b), F.col(a) - F.col(b)
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("see"),
                  F.sum(e * d).alias("sed"), F.sum(d * d).alias("sdd"))
    w = F.col("w")
    scored = sums.select(F.explode(F.array(*[F.lit(float(x)) for x in grid])).alias("w"), "*") \
        .select("w", F.sqrt(F.greatest((F.col("see") - 2 * w * F.col("sed") + w * w * F.col("sdd"))
                                       / F.col("n"), F.lit(0.0))).alias("rmse"))
    return scored


def pick_blend(scores_rows) -> tuple[float, float]:
    """Smallest grid weight with the strictly lowest score; default 0.5."""
    finite = [(r["rmse"], float(r["w"])) for r in scores_rows if r["rmse"] is not None and math.isfinite(r["rmse"])]
    rmse, w = min(finite, default=(float("inf"), 0.5))
    return w, rmse


def inverse_error_weights(scores: dict[str, float], top: int = 3) -> dict[str, float]:
    """w = (1/max(e, 1e-6)) / Σ over the ``top`` best finite scores."""
    finite = sorted([(s, m) for m, s in scores.items() if s is not None and math.isfinite(s)])[:top]
    inv = {m: 1.0 / max(s, 1e-6) for s, m in finite}
    tot = sum(inv.values())
    return {m: v / tot for m, v in inv.items()}


def ridge_meta(df: DataFrame, y: str, bases: list[str], alpha: float = 10.0):
    """Ridge (intercept free) on the base predictions from centred sums."""
    q = len(bases)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("my")]
    aggs += [F.avg(b).alias(f"m{i}") for i, b in enumerate(bases)]
    aggs += [F.covar_pop(bases[i], bases[j]).alias(f"c{i}_{j}") for i in range(q) for j in range(i, q)]
    aggs += [F.covar_pop(b, y).alias(f"cy{i}") for i, b in enumerate(bases)]
    r = df.agg(*aggs).first()
    n = r["n"]
    C = np.zeros((q, q))
    for i in range(q):
        for j in range(i, q):
            C[i, j] = C[j, i] = r[f"c{i}_{j}"] * n
    cy = np.array([r[f"cy{i}"] * n for i in range(q)])
    w = np.linalg.solve(C + alpha * np.eye(q), cy)
    b0 = r["my"] - sum(w[i] * r[f"m{i}"] for i in range(q))
    return float(b0), [float(x) for x in w]


def fold_moments(df: DataFrame, y: str, bases: list[str], fold_col: str, k: int, centre: float = 0.0) -> dict[int, np.ndarray]:
    """Σ zzᵀ of z = (1, bases − centre, y − centre) per fold 0..k−1, in one aggregate: every meta model and its held-out
    error follow from these sums. A centre near the mean of ``y`` keeps their digits."""
    z = [F.lit(1.0)] + [F.col(c).cast("double") - F.lit(centre) for c in [*bases, y]]
    at = [(a, b) for a in range(len(z)) for b in range(a, len(z))]
    sums = df.groupBy(F.col(fold_col).alias("__fold")).agg(*[F.sum(z[a] * z[b]).alias(f"s{a}_{b}") for a, b in at])
    out = {j: np.zeros((len(z), len(z))) for j in range(k)}
    for r in sums.collect():  # one row a fold
        for a, b in at:
            out[r["__fold"]][a, b] = out[r["__fold"]][b, a] = r[f"s{a}_{b}"]
    return out


def meta_of(moments: np.ndarray, alpha: float) -> tuple[float, list[float]]:
    """(intercept, weights) of the ridge on the bases, intercept free, from ``fold_moments`` in their centred terms."""
    n = moments[0, 0]
    means = moments[0, 1:] / n
    c = moments[1:, 1:] - n * np.outer(means, means)
    q = len(c) - 1
    w = np.linalg.solve(c[:q, :q] + alpha * np.eye(q), c[:q, q])
    return float(means[q] - w @ means[:q]), [float(x) for x in w]


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """Exact top-k rows per group. The planner puts a group limit below the
    exchange, so each task sends at most k rows of a group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
