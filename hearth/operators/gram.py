"""Cross-validation of the linear family from per-fold sufficient statistics.

Two Spark jobs, whatever the size of the parameter grid:

1. ``fold_statistics``: per training set (all rows, and "all but fold j" for
   each j) the median of every numeric column — rows are fanned out to the
   training sets they belong to and Spark's partial aggregation folds them —
   plus, over all rows, column means (used to centre) and sorted levels.
2. ``gram_cells``: for every cell of (fold[, inner fold]) the matrix Σ z zᵀ of
   the raw design z = [1, x−c (null→0), null flags, one-hot incl. a null
   level, y]. Each task folds its rows into one matrix per cell with NumPy;
   the matrices are cut into fixed blocks and summed by (cell, block) in two
   levels, groups of tasks first, so no reducer receives a row from every
   task and nothing grows with the rows.

On the driver (p×p work only): the statistics of a training set are sums of
cells; the fold's median imputation, mode imputation and population-std
scaling are affine in z, so they become a matrix A and the processed Gram is
A S Aᵀ. OLS (minimum norm), ridge, lasso and elastic net are solved on it,
and a fold's validation error is a quadratic form on that fold's own cell —
no scoring pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from .selection import exact_medians_by_set
from .sums import sum_blocks

BLOCK = 2048


# ---------------------------------------------------------------------------
# design layout
# ---------------------------------------------------------------------------

@dataclass
class Design:
    numeric: list[str]
    categorical: list[str]
    centers: dict[str, float]
    levels: dict[str, list[str]]
    index: dict = field(default_factory=dict)

    def __post_init__(self):
        i = 1
        for c in self.numeric:
            self.index[("v", c)] = i
            i += 1
        for c in self.numeric:
            self.index[("m", c)] = i
            i += 1
        for c in self.categorical:
            for lv in self.levels[c]:
                self.index[("h", c, lv)] = i
                i += 1
            self.index[("h", c, None)] = i
            i += 1
        self.index[("y",)] = i
        self.d = i + 1


def fold_statistics(df: DataFrame, numeric, categorical, fold_col: str | None, k: int):
    """Medians per training set (-1 = all rows, j = all rows but fold j),
    plus centres and sorted levels over all rows — one pass over the rows.

    Rows are unpivoted once and counted per (fold, column, value) with map-side
    partial aggregation; only that distinct-value table is fanned out to the
    k + 1 training sets, and each median (interpolated on even counts) is read
    off cumulative counts. Columns of a fractional type, which may have a value
    of its own in every row, are not counted: their medians come from digit
    counts (``selection``) and their centres from a plain mean."""
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    fractional = [c for c in numeric if isinstance(df.schema[c].dataType, T.FractionalType)]
    counted = [c for c in numeric if c not in fractional]
    items = [F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("x"),
                      F.lit(None).cast("string").alias("s")) for c in counted]
    items += [F.struct(F.lit(c).alias("col"), F.lit(None).cast("double").alias("x"),
                       F.col(c).cast("string").alias("s")) for c in categorical]
    if not items:
        items = [F.struct(F.lit("").alias("col"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("string").alias("s"))]
    long = df.select(fold.alias("fold"), F.explode(F.array(*items)).alias("v")) \
        .select("fold", "v.col", "v.x", "v.s").filter(F.col("x").isNotNull() | F.col("s").isNotNull())
    cnt = long.groupBy("fold", "col", "x", "s").agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        sets = F.array(F.lit(-1), *[F.when(F.col("fold") != j, F.lit(j)) for j in range(k)]) if fold_col \
            else F.array(F.lit(-1))
        per = cnt.filter(F.col("x").isNotNull()).select(F.explode(sets).alias("t"), "col", "x", "n") \
            .filter(F.col("t").isNotNull()).groupBy("t", "col", "x").agg(F.sum("n").alias("n"))
        w = Window.partitionBy("t", "col").orderBy("x")
        per = per.withColumn("cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
            .withColumn("tot", F.sum("n").over(Window.partitionBy("t", "col")))
        p1, p2 = F.floor((F.col("tot") + 1) / 2), F.floor(F.col("tot") / 2) + 1
        stats = per.groupBy("t", "col").agg(
            ((F.min(F.when(F.col("cum") >= p1, F.col("x"))) + F.min(F.when(F.col("cum") >= p2, F.col("x")))) / 2)
            .alias("med"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("avg")).collect()  # (k+1)·p rows
        lv = cnt.filter(F.col("s").isNotNull()).groupBy("col").agg(
            F.array_sort(F.collect_set("s")).alias("lv")).collect()  # one row per categorical column
    finally:
        cnt.unpersist()
    medians: dict = {t: {c: None for c in numeric} for t in [-1, *(range(k) if fold_col else [])]}
    centers = {c: 0.0 for c in numeric}
    for r in stats:
        medians[int(r["t"])][r["col"]] = r["med"]
        if r["t"] == -1:
            centers[r["col"]] = float(r["avg"])
    if fractional:
        for t, by_col in exact_medians_by_set(df, fractional, fold_col, k).items():
            medians[t].update(by_col)
        means = df.agg(*[F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(c) for c in fractional]).first()
        centers.update({c: float(means[c]) for c in fractional if means[c] is not None})
    levels = {c: [] for c in categorical}
    for r in lv:
        levels[r["col"]] = list(r["lv"])
    return medians, Design(list(numeric), list(categorical), centers, levels)


def _partition_grams(design: Design, keys: list[str], target: str):
    numeric, categorical = design.numeric, design.categorical
    d = design.d

    def fn(batches):
        import pandas as pd
        acc: dict = {}
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            z = np.zeros((n, d))
            z[:, 0] = 1.0
            for c in numeric:
                x = pdf[c].to_numpy(dtype=float, na_value=np.nan)
                miss = np.isnan(x)
                z[:, design.index[("v", c)]] = np.where(miss, 0.0, x - design.centers[c])
                z[:, design.index[("m", c)]] = miss
            for c in categorical:
                lv = design.levels[c]
                codes = pd.Categorical(pdf[c], categories=lv).codes
                cols = np.where(codes >= 0, design.index[("h", c, lv[0])] + codes if lv else 0,
                                design.index[("h", c, None)])
                z[np.arange(n), cols] = 1.0
            z[:, design.index[("y",)]] = pdf[target].to_numpy(dtype=float)
            kv = pdf[keys].to_numpy(dtype=np.int64)
            uniq, inv = np.unique(kv, axis=0, return_inverse=True)
            for gi, key in enumerate(map(tuple, uniq)):
                zk = z[inv.reshape(-1) == gi]
                g = zk.T @ zk
                acc[key] = acc[key] + g if key in acc else g
        out = []
        iu = np.triu_indices(d)
        for key, g in acc.items():
            flat = g[iu]  # symmetric: the upper triangle is enough
            for b in range(0, flat.size, BLOCK):
                row = {kname: int(kval) for kname, kval in zip(keys, key)}
                row["block"] = b // BLOCK
                row["v"] = flat[b:b + BLOCK].tolist()
                out.append(row)
        if out:
            yield pd.DataFrame(out)
    return fn


def gram_cells(df: DataFrame, design: Design, keys: list[str], target: str) -> dict:
    """Σ z zᵀ per cell of ``keys`` (e.g. ["fold"] or ["fold", "inner"])."""
    schema = ", ".join(f"{k} int" for k in keys) + ", block int, v array<double>"
    cols = [*keys, *design.numeric, *design.categorical, target]
    parts = df.select(*[F.col(c) for c in cols]).mapInPandas(_partition_grams(design, keys, target), schema)
    summed = sum_blocks(parts, [*keys, "block"]).collect()  # cells × blocks rows
    d = design.d
    iu = np.triu_indices(d)
    out: dict = {}
    for r in summed:
        key = tuple(int(r[k]) for k in keys)
        flat = out.setdefault(key, np.zeros(len(iu[0])))
        v = r["v"].toArray()
        b = int(r["block"]) * BLOCK
        flat[b:b + len(v)] = v
    mats = {}
    for k, flat in out.items():
        m = np.zeros((d, d))
        m[iu] = flat
        mats[k] = m + np.triu(m, 1).T
    return mats


# ---------------------------------------------------------------------------
# fold-safe pre-processing as a matrix
# ---------------------------------------------------------------------------

@dataclass
class Transform:
    A: np.ndarray
    names: list[str]
    medians: dict
    modes: dict
    means: dict       # mean of the imputed raw column
    scales: dict
    kept: dict        # categorical -> kept levels


def fold_transform(design: Design, S: np.ndarray, medians: dict, scale: bool = True) -> Transform:
    n = S[0, 0]
    rows, names = [np.eye(1, design.d, 0).ravel()], []
    means, scales, modes, kept = {}, {}, {}, {}
    for c in design.numeric:
        iv, im = design.index[("v", c)], design.index[("m", c)]
        med = medians.get(c)
        sh = (med - design.centers[c]) if med is not None else 0.0
        mu = (S[0, iv] + sh * S[0, im]) / n
        ex2 = (S[iv, iv] + 2 * sh * S[iv, im] + sh * sh * S[im, im]) / n
        var = max(ex2 - mu * mu, 0.0)
        sd = np.sqrt(var) if (scale and var > 1e-12 * max(1.0, mu * mu)) else 1.0
        loc = mu if scale else 0.0
        a = np.zeros(design.d)
        a[0], a[iv], a[im] = -loc / sd, 1.0 / sd, sh / sd
        rows.append(a)
        names.append(c)
        means[c] = loc + design.centers[c] if scale else 0.0
        scales[c] = sd
    for c in design.categorical:
        lv = design.levels[c]
        counts = np.array([S[design.index[("h", c, x)], design.index[("h", c, x)]] for x in lv])
        mode = lv[int(np.argmax(counts))] if len(lv) and counts.max() > 0 else None
        modes[c] = mode
        kept[c] = [x for x, cnt in zip(lv, counts) if cnt > 0]
        for x in kept[c]:
            a = np.zeros(design.d)
            a[design.index[("h", c, x)]] = 1.0
            if x == mode:
                a[design.index[("h", c, None)]] = 1.0
            rows.append(a)
            names.append(f"{c}_{x}")
    rows.append(np.eye(1, design.d, design.index[("y",)]).ravel())
    return Transform(np.vstack(rows), names, dict(medians), modes, means, scales, kept)


# ---------------------------------------------------------------------------
# solvers on a processed Gram G over w = [1, f_1..f_q, y]
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class LinearSpec:
    kind: str              # ols | ridge | lasso | elasticnet
    alpha: float = 0.0
    l1_ratio: float = 1.0
    max_iter: int = 20000

    @property
    def name(self) -> str:
        return {"ols": "LinearRegression", "ridge": "Ridge", "lasso": "Lasso",
                "elasticnet": "ElasticNet"}[self.kind]

    def params(self) -> dict:
        if self.kind == "ols":
            return {}
        if self.kind == "elasticnet":
            return {"alpha": self.alpha, "l1_ratio": self.l1_ratio}
        return {"alpha": self.alpha}


def _centered(G):
    q = G.shape[0] - 2
    n = G[0, 0]
    fbar, ybar = G[0, 1:q + 1] / n, G[0, q + 1] / n
    C = G[1:q + 1, 1:q + 1] / n - np.outer(fbar, fbar)
    cy = G[1:q + 1, q + 1] / n - fbar * ybar
    return n, fbar, ybar, C, cy


SWEEPS = 8


def _elastic_net(C, cy, l1, l2, max_iter, tol=1e-6, start=None):
    """Minimiser of ½bᵀCb − cyᵀb + l1‖b‖₁ + ½l2‖b‖², by working sets.

    A round takes the coordinates in use and those that break the optimality
    conditions, settles their signs with a few soft-threshold sweeps over their own
    small block of C, then solves the linear system that these signs leave. It ends
    when no condition is broken by more than ``tol`` of the largest correlation."""
    b = np.zeros(len(cy)) if start is None else start.copy()
    curve = np.diag(C)
    usable = curve > 1e-14 * curve.max(initial=0.0)
    limit = tol * np.abs(cy).max(initial=0.0)
    for _ in range(max_iter):
        pull = cy - C @ b - l2 * b
        broken = usable & (np.where(b != 0, np.abs(pull - l1 * np.sign(b)), np.abs(pull) - l1) > limit)
        if not broken.any():
            break
        work = np.flatnonzero(broken | (b != 0))
        block, x = C[np.ix_(work, work)], b[work]
        rest = cy[work] - C[work] @ b
        for _ in range(SWEEPS):
            for j in range(len(work)):
                reach = rest[j] + block[j, j] * x[j]
                step = np.sign(reach) * max(abs(reach) - l1, 0.0) / (block[j, j] + l2) - x[j]
                if step:
                    rest -= step * block[j]
                    x[j] += step
        used = np.flatnonzero(x)
        signs = np.sign(x[used])
        system, wanted = block[np.ix_(used, used)] + l2 * np.eye(len(used)), cy[work[used]] - l1 * signs
        exact = np.linalg.lstsq(system, wanted, rcond=None)[0]
        # collinear columns may leave no solution with these signs: then the sweeps go on
        if np.array_equal(np.sign(exact), signs) and np.allclose(system @ exact, wanted, rtol=0, atol=limit):
            x[used] = exact
        b[work] = x
    return b


def solve(G: np.ndarray, spec: LinearSpec, warm: np.ndarray | None = None):
    """(intercept, coefficients) in the scikit-learn parameterisation:
    ridge ‖y−Xb‖² + α‖b‖²; lasso/elastic net (1/2n)‖y−Xb‖² + α·l1‖b‖₁ + ½α(1−l1)‖b‖²;
    OLS by the minimum-norm least-squares solution."""
    n, fbar, ybar, C, cy = _centered(G)
    q = len(cy)
    if q == 0:
        return ybar, np.zeros(0)
    if spec.kind == "ols":
        b = np.linalg.pinv(C, rcond=1e-10, hermitian=True) @ cy
    elif spec.kind == "ridge":
        b = np.linalg.solve(n * C + spec.alpha * np.eye(q), n * cy)
    else:
        l1 = 1.0 if spec.kind == "lasso" else spec.l1_ratio
        b = _elastic_net(C, cy, spec.alpha * l1, spec.alpha * (1 - l1), spec.max_iter, start=warm)
    return ybar - fbar @ b, b


def sse(G: np.ndarray, b0: float, b: np.ndarray) -> float:
    c = np.concatenate([[-b0], -b, [1.0]])
    return float(max(c @ G @ c, 0.0))


# ---------------------------------------------------------------------------
# driver object
# ---------------------------------------------------------------------------

class LinearCV:
    """Fold statistics of one feature table, reusable by every linear model,
    grid point, blend and stack built on it."""

    def __init__(self, df: DataFrame, numeric, categorical, target: str = "y",
                 fold_col: str = "fold", k: int = 5, inner_col: str | None = None,
                 k_inner: int = 3, scale: bool = True):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.target, self.fold_col, self.k = target, fold_col, k
        self.inner_col, self.k_inner, self.scale = inner_col, k_inner, scale
        keys = [fold_col] + ([inner_col] if inner_col else [])
        cols = ["id", *keys, *self.numeric, *self.categorical, target]
        table = df.select(*cols).filter(F.col(target).isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.medians, self.design = fold_statistics(table, self.numeric, self.categorical, fold_col, k)
            self.cells = gram_cells(table, self.design, keys, target)
        finally:
            table.unpersist()
        d = self.design.d
        self.fold_S = {j: sum((S for key, S in self.cells.items() if key[0] == j), np.zeros((d, d)))
                       for j in range(k)}
        self.total = sum(self.fold_S.values(), np.zeros((d, d)))
        self._tf: dict = {}

    # training-set helpers ---------------------------------------------------
    def train_S(self, fold: int | None) -> np.ndarray:
        return self.total if fold is None else self.total - self.fold_S[fold]

    def transform_for(self, fold: int | None) -> Transform:
        key = -1 if fold is None else fold
        if key not in self._tf:
            self._tf[key] = fold_transform(self.design, self.train_S(fold), self.medians[key], self.scale)
        return self._tf[key]

    def fit(self, spec: LinearSpec, fold: int | None = None):
        tf = self.transform_for(fold)
        G = tf.A @ self.train_S(fold) @ tf.A.T
        b0, b = solve(G, spec)
        return tf, b0, b

    def fold_errors(self, spec: LinearSpec) -> list[tuple[int, int, float]]:
        """(fold, n_valid, mse) with pre-processing and model fitted on the other folds."""
        out = []
        for j in range(self.k):
            tf, b0, b = self.fit(spec, j)
            Gv = tf.A @ self.fold_S[j] @ tf.A.T
            nv = int(round(self.fold_S[j][0, 0]))
            out.append((j, nv, sse(Gv, b0, b) / nv if nv else float("nan")))
        return out

    def grid_errors(self, specs: list[LinearSpec]) -> dict:
        """fold_errors for many specs: each fold's Grams are formed once and each
        (kind, l1) path is solved from the largest α down, warm-started."""
        out = {s: [] for s in specs}
        paths: dict = {}
        for s in specs:
            paths.setdefault((s.kind, s.l1_ratio), []).append(s)
        for j in range(self.k):
            tf = self.transform_for(j)
            G = tf.A @ self.train_S(j) @ tf.A.T
            Gv = tf.A @ self.fold_S[j] @ tf.A.T
            nv = int(round(self.fold_S[j][0, 0]))
            for path in paths.values():
                warm = None
                for s in sorted(path, key=lambda x: -x.alpha):
                    b0, b = solve(G, s, warm)
                    warm = b if len(b) else None
                    out[s].append((j, nv, sse(Gv, b0, b) / nv if nv else float("nan")))
        return out

    # inner (nested) folds ---------------------------------------------------
    def inner_errors(self, spec: LinearSpec, outer: int) -> float:
        """Mean inner-fold MSE inside the training part of ``outer``; the
        outer fold's pre-processing is applied once, as a search on an
        already transformed matrix does."""
        tf = self.transform_for(outer)
        d = self.design.d
        cells = {i: sum((S for key, S in self.cells.items() if key[0] != outer and key[1] == i),
                        np.zeros((d, d))) for i in range(self.k_inner)}
        tot = sum(cells.values(), np.zeros((d, d)))
        errs = []
        for i in range(self.k_inner):
            G = tf.A @ (tot - cells[i]) @ tf.A.T
            b0, b = solve(G, spec)
            Gv = tf.A @ cells[i] @ tf.A.T
            nv = cells[i][0, 0]
            errs.append(sse(Gv, b0, b) / nv)
        return float(np.mean(errs))

    def stack_errors(self, bases: list[LinearSpec], meta_alpha: float = 10.0):
        """Stacked generalisation scored per outer fold, from the cells alone.
        Inside outer fold k, each base is fitted on the training part less one
        inner fold (pre-processing refitted there too, except that medians are
        those of the outer training part) and predicts that inner fold; the
        meta ridge is fitted on those predictions; the bases are then refitted
        on the whole training part and the stack scores the outer fold.
        Every prediction is linear in z, so each step is a quadratic form."""
        d = self.design.d
        iy = self.design.index[("y",)]
        e0, ey = np.eye(1, d, 0).ravel(), np.eye(1, d, iy).ravel()
        out = []
        for k in range(self.k):
            cells = {i: sum((S for key, S in self.cells.items() if key[0] != k and key[1] == i),
                            np.zeros((d, d))) for i in range(self.k_inner)}
            tot = sum(cells.values(), np.zeros((d, d)))
            q = len(bases)
            Gm = np.zeros((q + 2, q + 2))
            for i in range(self.k_inner):
                tf = fold_transform(self.design, tot - cells[i], self.medians[k], self.scale)
                G = tf.A @ (tot - cells[i]) @ tf.A.T
                rows = [e0]
                for spec in bases:
                    b0, b = solve(G, spec)
                    rows.append(tf.A.T @ np.concatenate([[b0], b, [0.0]]))
                rows.append(ey)
                M = np.vstack(rows)
                Gm += M @ cells[i] @ M.T
            a0, a = solve(Gm, LinearSpec("ridge", meta_alpha))
            tf = self.transform_for(k)
            q_vec = a0 * e0
            for w, spec in zip(a, bases):
                _, b0, b = self.fit(spec, k)
                q_vec = q_vec + w * (tf.A.T @ np.concatenate([[b0], b, [0.0]]))
            res = ey - q_vec
            nv = self.fold_S[k][0, 0]
            out.append((k, int(round(nv)), float(max(res @ self.fold_S[k] @ res, 0.0) / nv), [float(x) for x in a]))
        return out

    def inner_search(self, specs: list[LinearSpec], outer: int) -> dict:
        """Mean inner-fold MSE of every spec inside outer fold ``outer``: each
        inner training Gram is formed once and each (kind, l1) path is solved
        from the largest α down, warm-started (as a regularisation path is)."""
        tf = self.transform_for(outer)
        d = self.design.d
        cells = {i: sum((S for key, S in self.cells.items() if key[0] != outer and key[1] == i),
                        np.zeros((d, d))) for i in range(self.k_inner)}
        tot = sum(cells.values(), np.zeros((d, d)))
        errs = {s: [] for s in specs}
        paths: dict = {}
        for s in specs:
            paths.setdefault((s.kind, s.l1_ratio), []).append(s)
        for i in range(self.k_inner):
            G = tf.A @ (tot - cells[i]) @ tf.A.T
            Gv = tf.A @ cells[i] @ tf.A.T
            nv = cells[i][0, 0]
            for path in paths.values():
                warm = None
                for s in sorted(path, key=lambda x: -x.alpha):
                    b0, b = solve(G, s, warm)
                    warm = b
                    errs[s].append(sse(Gv, b0, b) / nv)
        return {s: float(np.mean(v)) for s, v in errs.items()}

    # row-level predictions ----------------------------------------------------
    def prediction_expr(self, tf: Transform, b0: float, b: np.ndarray) -> Column:
        """The fitted model as one column expression over the raw columns."""
        q_num = len(self.numeric)
        const = b0
        expr = None
        for j, c in enumerate(self.numeric):
            w = b[j] / tf.scales[c]
            const -= w * tf.means[c]
            med = tf.medians.get(c)
            x = F.col(c).cast("double")
            term = F.coalesce(x, F.lit(med)) * F.lit(float(w)) if med is not None else x * F.lit(float(w))
            expr = term if expr is None else expr + term
        pos = q_num
        for c in self.categorical:
            pairs = []
            for lv in tf.kept[c]:
                pairs += [F.lit(lv), F.lit(float(b[pos]))]
                pos += 1
            if pairs:
                m = F.create_map(*pairs)
                key = F.coalesce(F.col(c), F.lit(tf.modes[c])) if tf.modes[c] is not None else F.col(c)
                term = F.coalesce(m[key], F.lit(0.0))
                expr = term if expr is None else expr + term
        return F.lit(float(const)) if expr is None else expr + F.lit(float(const))

    def oof_expr(self, spec: LinearSpec) -> Column:
        """Out-of-fold prediction: each row scored by the model of its own fold."""
        expr = None
        for j in range(self.k):
            tf, b0, b = self.fit(spec, j)
            e = self.prediction_expr(tf, b0, b)
            expr = F.when(F.col(self.fold_col) == j, e) if expr is None else expr.when(F.col(self.fold_col) == j, e)
        return expr

    def full_expr(self, spec: LinearSpec) -> Column:
        tf, b0, b = self.fit(spec, None)
        return self.prediction_expr(tf, b0, b)
