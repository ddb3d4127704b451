"""Kernel regressors on random Fourier features (survey M10, M11), fitted from sums over the rows.

z(x) = sqrt(2/D)·cos(xW + b) with W ~ N(0, 2γ) and b ~ U(0, 2π) (Rahimi & Recht, 2007): inner products of z
approximate the RBF kernel. Features are made inside the tasks from the raw columns and never stored; each
training set (all rows, and all but fold j) has its own pre-processing, so every row is mapped once per set.

* Kernel ridge: one pass per γ adds up the Gram matrices of all training and validation sets; every α of the
  grid is then a D×D solve. No intercept, penalty α: the primal of kernel ridge regression.
* ε-insensitive regression: Newton's method on the loss smoothed over a shrinking width. A pass gives loss,
  gradient and curvature of all (C, ε) problems and training sets of one γ at once.

Partial sums of the tasks are added up in two levels (groups of tasks, then groups), so that no reducer gets a
row from every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sums import sum_blocks
from .transformers import _StateModel

BLOCK = 4096
#: Random features.
FEATURES = 256


# ---------------------------------------------------------------- features

def view_of(cv, fold: int | None) -> dict:
    """The pre-processing that the rows outside ``fold`` (None: all) give: values for ``matrix``."""
    tf = cv.transform_for(fold)
    return {"numeric": [[c, tf.medians.get(c), float(tf.means[c]), float(tf.scales[c])] for c in cv.numeric],
            "categorical": [[c, tf.modes[c], list(tf.kept[c])] for c in cv.categorical]}


def width(view: dict) -> int:
    return len(view["numeric"]) + sum(len(kept) for _, _, kept in view["categorical"])


def matrix(view: dict, pdf: pd.DataFrame) -> np.ndarray:
    """Median-filled, scaled numbers and one-hot mode-filled categories (an unknown level is all zeros)."""
    out = np.zeros((len(pdf), width(view)))
    at = 0
    for c, median, mean, scale in view["numeric"]:
        x = pdf[c].to_numpy(dtype=float, na_value=np.nan)
        x = np.where(np.isnan(x), 0.0 if median is None else median, x)
        out[:, at] = (x - mean) / scale
        at += 1
    for c, mode, kept in view["categorical"]:
        x, slots = pdf[c].astype("category").cat, {level: i for i, level in enumerate(kept)}
        slot_of = np.array([*(slots.get(level, -1) for level in x.categories), slots.get(mode, -1)])  # a null's code is -1
        codes = slot_of[x.codes]
        rows = np.flatnonzero(codes >= 0)
        out[rows, at + codes[rows]] = 1.0
        at += len(kept)
    return out


def hashed_once(view: dict, pdf: pd.DataFrame) -> pd.DataFrame:
    """The batch with its categories as codes, so that ``matrix`` reads their text once for all views."""
    return pdf.assign(**{c: pdf[c].astype("category") for c, *_ in view["categorical"]})


@dataclass(frozen=True)
class FourierMap:
    gamma: float
    n: int = FEATURES
    seed: int = 42

    def of(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        w = rng.normal(0.0, math.sqrt(2 * self.gamma), size=(x.shape[1], self.n)) / (2 * math.pi)
        b = rng.uniform(0, 2 * math.pi, size=self.n) / (2 * math.pi)
        out = np.empty((len(x), self.n))
        for at in range(0, len(x), CHUNK):
            part = out[at:at + CHUNK]
            np.matmul(x[at:at + CHUNK], w, out=part)
            part += b
            _cos_of_turns(part)
            part *= math.sqrt(2.0 / self.n)
        return out


#: Rows whose features are worked on at once: what the processor's cache holds.
CHUNK = 512
#: Taylor coefficients of sin(2πd) / d in d², to 3e-16 for |d| ≤ ¼.
_SINE = [(-1) ** i * (2 * math.pi) ** (2 * i + 1) / math.factorial(2 * i + 1) for i in range(10)]


def _cos_of_turns(u: np.ndarray) -> None:
    """cos(2πu) in place, as sin(2πd) of the distance d to the nearest quarter turn: array arithmetic, where the
    library's cosine goes number by number."""
    u -= np.rint(u)
    np.abs(u, out=u)
    np.subtract(0.25, u, out=u)
    square = u * u
    p = np.full_like(u, _SINE[-1])
    for c in reversed(_SINE[:-1]):
        p *= square
        p += c
    u *= p


class RandomFeatureModel(_StateModel):
    """prediction = intercept + weights · z(x), from the raw columns; features exist inside the task only."""

    @classmethod
    def of(cls, view: dict, fmap: FourierMap, weights: np.ndarray, intercept: float = 0.0) -> RandomFeatureModel:
        return cls(view=view, gamma=fmap.gamma, n=fmap.n, seed=fmap.seed, weights=[float(w) for w in weights],
                   intercept=float(intercept))

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.s
        view, fmap = s["view"], FourierMap(s["gamma"], s["n"], s["seed"])
        weights, intercept = np.array(s["weights"]), s["intercept"]

        @F.pandas_udf("double")
        def score(pdf: pd.DataFrame) -> pd.Series:
            return pd.Series(fmap.of(matrix(view, pdf)) @ weights + intercept)

        return df.withColumn("prediction", score(_raw(view)))


def _raw(view: dict):
    return F.struct(*[F.col(c).cast("double").alias(c) for c, *_ in view["numeric"]],
                    *[F.col(c).cast("string").alias(c) for c, *_ in view["categorical"]])


def _rows(df: DataFrame, view: dict, target: str, fold_col: str) -> DataFrame:
    """(fold, y, raw columns) of the rows with a target."""
    return df.filter(F.col(target).isNotNull()).select(F.col(fold_col).cast("int").alias("__fold"), F.col(target).cast("double").alias("__y"),
                                                       _raw(view).alias("r")).select("__fold", "__y", "r.*")


def _emit(acc: dict[tuple, np.ndarray], names: list[str]) -> Iterator[pd.DataFrame]:
    for key, flat in acc.items():
        n = -(-len(flat) // BLOCK)
        yield pd.DataFrame({**{c: [k] * n for c, k in zip(names, key)}, "block": range(n),
                            "v": [flat[b * BLOCK:(b + 1) * BLOCK] for b in range(n)]})


def _collect(parts: DataFrame, names: list[str]) -> dict[tuple, np.ndarray]:
    """The summed vectors by key; their number and length follow the grid and the features, not the rows."""
    found: dict[tuple, dict] = {}
    for r in sum_blocks(parts, [*names, "block"]).collect():
        found.setdefault(tuple(r[c] for c in names), {})[r["block"]] = r["v"].toArray()
    return {k: np.concatenate([b[i] for i in sorted(b)]) for k, b in found.items()}


# ---------------------------------------------------------------- kernel ridge

ALL = -1


def feature_grams(df: DataFrame, views: dict[int, dict], fmap: FourierMap, target: str = "y",
                  fold_col: str = "fold", intercept: bool = False) -> dict[tuple[int, int], np.ndarray]:
    """(training set, 0: its rows | 1: its held-out rows) → Gram matrix of [z, y] (``intercept``: [z, 1, y]), in one pass."""
    d = fmap.n + 1 + intercept
    upper = np.triu_indices(d)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            fold, y = pdf["__fold"].to_numpy(), pdf["__y"].to_numpy()
            pdf = hashed_once(next(iter(views.values())), pdf)
            for t, view in views.items():
                z = fmap.of(matrix(view, pdf))
                zy = np.column_stack([z, np.ones(len(y)), y] if intercept else [z, y])
                for part, rows in ((0, fold != t), (1, fold == t)):
                    if rows.any():
                        g = (zy[rows].T @ zy[rows])[upper]
                        acc[t, part] = acc[t, part] + g if (t, part) in acc else g
        yield from _emit(acc, ["t", "part"])

    rows = _rows(df, next(iter(views.values())), target, fold_col)
    out = {}
    for key, flat in _collect(rows.mapInPandas(add, "t int, part int, block int, v array<double>"), ["t", "part"]).items():
        m = np.zeros((d, d))
        m[upper] = flat
        out[key] = m + np.triu(m, 1).T
    return out


def ridge_weights(gram: np.ndarray, alpha: float) -> np.ndarray:
    n = len(gram) - 1
    return np.linalg.solve(gram[:n, :n] + alpha * np.eye(n), gram[:n, n])


def ridge_grid(df: DataFrame, cv, alphas, fmap: FourierMap, target: str = "y", fold_col: str = "fold"):
    """([(α, fold, mse)], {α: model on all rows}) of kernel ridge for every α at one γ."""
    views = {ALL: view_of(cv, None), **{j: view_of(cv, j) for j in range(cv.k)}}
    grams = feature_grams(df, views, fmap, target, fold_col)
    errors, models = [], {}
    for a in alphas:
        for j in range(cv.k):
            if (j, 1) not in grams or (j, 0) not in grams:
                continue  # an empty fold, or nothing outside it
            w = np.append(-ridge_weights(grams[j, 0], a), 1.0)
            errors.append((a, j, float(max(w @ grams[j, 1] @ w, 0.0)) / held_out(cv, j)))
        models[a] = RandomFeatureModel.of(views[ALL], fmap, ridge_weights(grams[ALL, 0], a))
    return errors, models


def held_out(cv, fold: int) -> int:
    return int(round(cv.fold_S[fold][0, 0]))


def fold_ridge(df: DataFrame, cv, alpha: float, fmap: FourierMap, target: str = "y", fold_col: str = "fold") -> dict:
    """fold → model fitted on the other folds."""
    views = {j: view_of(cv, j) for j in range(cv.k)}
    grams = feature_grams(df, views, fmap, target, fold_col)
    return {j: RandomFeatureModel.of(views[j], fmap, ridge_weights(grams[j, 0], alpha)) for j in range(cv.k)}


# ---------------------------------------------------------------- one penalty, squared error or Huber's loss

def scaled_ridge(gram: np.ndarray, penalty: float) -> np.ndarray:
    """[w, b] with the least mean squared error / 2 + penalty / σ_y · ‖w‖² / 2 (MLlib's ``LinearRegression`` scales its
    penalty by the target's deviation), from the Gram matrix of [z, 1, y]."""
    d = len(gram) - 1
    n, sy, syy = gram[d - 1, d - 1], gram[d - 1, d], gram[d, d]
    sd = math.sqrt(max(syy / n - (sy / n) ** 2, 0.0))
    pull = np.append(np.full(d - 1, n * penalty / sd if sd > 0 else 0.0), 0.0)
    return np.linalg.lstsq(gram[:d, :d] + np.diag(pull), gram[:d, d], rcond=None)[0]


def squared_sum(gram: np.ndarray, weights: np.ndarray) -> float:
    """Σ (y − [z, 1]·weights)² from the Gram matrix of [z, 1, y]."""
    w = np.append(-weights, 1.0)
    return float(max(w @ gram @ w, 0.0))


def fold_rmse(df: DataFrame, cv, penalty: float, fmap: FourierMap, loss: str = "squaredError", target: str = "y",
              fold_col: str = "fold") -> list[tuple[int, float]]:
    """(fold, root error on it) of a regression with intercept on the features, fitted outside the fold.

    All folds share their passes: one for the squared error, and one a Newton step from there for Huber's loss."""
    views = {j: view_of(cv, j) for j in range(cv.k) if 0 < held_out(cv, j) < int(round(cv.total[0, 0]))}
    if not views:
        return []
    grams = feature_grams(df, views, fmap, target, fold_col, intercept=True)
    fits = {j: scaled_ridge(grams[j, 0], penalty) for j in views}
    if loss == "huber":
        starts = {j: np.append(w, max(math.sqrt(squared_sum(grams[j, 0], w) / grams[j, 0][-2, -2]), 1e-6)) for j, w in fits.items()}
        fits = {j: p[:-1] for j, p in huber_solve(df, views, fmap, penalty, starts, target, fold_col).items()}
    return [(j, math.sqrt(squared_sum(grams[j, 1], w) / held_out(cv, j))) for j, w in fits.items()]


#: Residuals over this many scales count linearly (MLlib's default).
HUBER_EPSILON = 1.35
#: The scale shrinks to this share of itself in one step at most.
LEAST_SHRINK = 0.1


def _huber_sums(z1: np.ndarray, y: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Rows, loss, gradient and upper triangle of the curvature in p = [w, b, σ]; the rows of ``z1`` are [z, 1].

    Loss of a residual r: (σ + r²/σ) / 2 up to ε·σ, (σ + 2ε|r| − σε²) / 2 beyond."""
    w, scale, eps = p[:-1], p[-1], HUBER_EPSILON
    r = y - z1 @ w
    near = np.abs(r) <= eps * scale
    rn, zn = r[near], z1[near]
    far = len(r) - len(rn)
    loss = 0.5 * (scale * len(rn) + rn @ rn / scale) + 0.5 * (scale * (1 - eps ** 2) * far + 2 * eps * np.abs(r[~near]).sum())
    grad = np.append(-(z1.T @ np.where(near, r / scale, eps * np.sign(r))),
                     0.5 * (len(rn) - rn @ rn / scale ** 2) + 0.5 * (1 - eps ** 2) * far)
    d = len(p)
    curve = np.zeros((d, d))
    curve[:-1, :-1] = zn.T @ zn / scale
    curve[:-1, -1] = zn.T @ rn / scale ** 2
    curve[-1, -1] = rn @ rn / scale ** 3
    return np.concatenate([[len(r), loss], grad, curve[np.triu_indices(d)]])


def huber_solve(df: DataFrame, views: dict[int, dict], fmap: FourierMap, penalty: float, starts: dict[int, np.ndarray],
                target: str = "y", fold_col: str = "fold") -> dict[int, np.ndarray]:
    """Training set → [w, b, σ] with the least mean Huber loss + penalty · ‖w‖² / 2, by Newton's method in σ too.

    A pass gives loss, gradient and curvature of all sets; a step that does not lower the loss is halved."""
    rows = _rows(df, next(iter(views.values())), target, fold_col).persist()
    d = fmap.n + 2
    ridge = np.append(np.full(fmap.n, penalty), [0.0, 0.0])
    at, value, step, size = dict(starts), dict.fromkeys(starts, math.inf), {}, {}
    try:
        for _ in range(MAX_PASSES):
            trial = {t: at[t] + size[t] * step[t] if t in step else at[t] for t in starts if size.get(t) != 0.0}
            if not trial:
                break

            def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                acc: dict[tuple, np.ndarray] = {}
                for pdf in batches:
                    fold, y = pdf["__fold"].to_numpy(), pdf["__y"].to_numpy()
                    pdf = hashed_once(views[next(iter(trial))], pdf)
                    for t, p in trial.items():
                        own = fold != t
                        z1 = np.column_stack([fmap.of(matrix(views[t], pdf)), np.ones(len(pdf))])[own]
                        s = _huber_sums(z1, y[own], p)
                        acc[t,] = acc[t,] + s if (t,) in acc else s
                yield from _emit(acc, ["t"])

            for (t,), s in _collect(rows.mapInPandas(add, "t int, block int, v array<double>"), ["t"]).items():
                p, n = trial[t], max(s[0], 1.0)
                now = s[1] / n + 0.5 * float(ridge @ p ** 2)
                if t in step and now > value[t] + 1e-12 * abs(value[t]):
                    size[t] = size[t] * 0.5 if size[t] > 1e-4 else 0.0  # too far: the same step, shorter; 0: done
                    continue
                at[t], value[t] = p, now
                pull = s[2:2 + d] / n + ridge * p
                if np.abs(pull).max() <= HUBER_GRADIENT:
                    size[t] = 0.0
                    continue
                h = np.zeros((d, d))
                h[np.triu_indices(d)] = s[2 + d:] / n
                h += np.triu(h, 1).T + np.diag(ridge + 1e-10)
                step[t] = -np.linalg.lstsq(h, pull, rcond=None)[0]
                size[t] = min(1.0, (1 - LEAST_SHRINK) * p[-1] / -step[t][-1]) if step[t][-1] < 0 else 1.0
    finally:
        rows.unpersist()
    return at


#: A set is solved when no slope of its mean loss is larger.
HUBER_GRADIENT = 1e-8


# ---------------------------------------------------------------- ε-insensitive regression

#: Widths over which the corners of the loss are smoothed, in units of ε (the last one decides the result).
WIDTHS = (16.0, 4.0, 1.0, 0.25, 0.05)
MAX_PASSES = 400
#: The width at which a problem begins that starts from a neighbour's solution.
START_LEVEL = len(WIDTHS) - 1
#: A problem is solved when its gradient falls below this share of C·n; before the last width, below the rougher one.
GRADIENT, ROUGH_GRADIENT = 1e-6, 1e-3


@dataclass
class _Problem:
    """½‖w‖² + C Σ max(0, |y − f| − ε) with an intercept that is not penalised."""

    t: int
    c: float
    eps: float
    w: np.ndarray  # accepted
    level: int = 0
    value: float = math.inf
    step: np.ndarray | None = None
    size: float = 1.0
    done: bool = False
    sse: float = math.nan

    @property
    def width(self) -> float:
        return WIDTHS[self.level] * self.eps

    def trial(self) -> np.ndarray:
        return self.w if self.step is None else self.w + self.size * self.step

    def take(self, sums: np.ndarray, n_features: int, held: float) -> None:
        """Sums of a pass at ``trial``: number of rows, loss, gradient, curvature; then the next trial."""
        d = n_features + 1
        n, loss, grad, upper = sums[0], sums[1], sums[2:2 + d], sums[2 + d:]
        w = self.trial()
        value = 0.5 * float(w[:-1] @ w[:-1]) + self.c * loss
        if self.step is not None and value > self.value + 1e-12 * abs(self.value) and self.size > 1e-4:
            self.size *= 0.5  # too far: the same step, shorter
            return
        self.w, self.value, self.step, self.size, self.sse = w, value, None, 1.0, held
        pull = np.append(w[:-1], 0.0) - self.c * grad
        last = self.level == len(WIDTHS) - 1
        if np.abs(pull).max() <= (GRADIENT if last else ROUGH_GRADIENT) * self.c * max(n, 1.0):
            if last:
                self.done = True
                return
            self.level += 1
            self.value = math.inf  # another loss from here on
            return
        h = np.zeros((d, d))
        h[np.triu_indices(d)] = upper
        h = (h + np.triu(h, 1).T) * (self.c / self.width) + np.diag(np.append(np.ones(n_features), 1e-8 * self.c * max(n, 1.0)))
        self.step = -np.linalg.solve(h, pull)


def _loss_sums(z1: np.ndarray, y: np.ndarray, eps: float, width: float, w: np.ndarray) -> np.ndarray:
    """Rows, loss, Σ h'(r)·z1 and the upper triangle of Σ width·h''(r)·z1 z1ᵀ; the rows of ``z1`` are [z, 1].

    h is the sum of two soft corners, width·log(1 + exp((±r − ε)/width)): max(0, |r| − ε) as the width goes to 0.
    """
    r = y - z1 @ w
    over, under = (r - eps) / width, (-r - eps) / width
    loss = width * (np.logaddexp(0.0, over) + np.logaddexp(0.0, under)).sum()
    a, b = _sigmoid(over), _sigmoid(under)
    bend = a * (1 - a) + b * (1 - b)
    near = np.flatnonzero(bend > 1e-9)  # the rest adds nothing to the curvature
    curve = np.zeros((len(w), len(w)))
    for at in range(0, len(near), CHUNK):
        some = near[at:at + CHUNK]
        zb = z1[some]
        zb *= np.sqrt(bend[some])[:, None]
        curve += zb.T @ zb
    return np.concatenate([[len(z1), loss], z1.T @ (a - b), curve[np.triu_indices(len(w))]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def svr_solve(df: DataFrame, views: dict[int, dict], fmap: FourierMap, settings, target: str = "y", fold_col: str = "fold"):
    """Solves every (C, ε) of ``settings`` on every training set: [(t, C, ε, weights, intercept, held-out SSE)].

    The set of all rows goes first; the others start from its solution, near their own, and take few passes."""
    problems = [_Problem(t, float(c), float(e), np.zeros(fmap.n + 1)) for t in views for c, e in settings]
    rows = _rows(df, next(iter(views.values())), target, fold_col).persist()
    mean = rows.agg(F.avg("__y")).first()[0] or 0.0
    for p in problems:
        p.w[-1] = mean
    whole = [p for p in problems if p.t == ALL]
    try:
        _newton(rows, views, fmap, whole)
        solved = {(p.c, p.eps): p.w for p in whole}
        rest = [p for p in problems if p.t != ALL]
        for p in rest:
            if (p.c, p.eps) in solved:
                p.w, p.level = solved[p.c, p.eps].copy(), START_LEVEL
        _newton(rows, views, fmap, rest)
    finally:
        rows.unpersist()
    return [(p.t, p.c, p.eps, p.w[:-1], float(p.w[-1]), p.sse) for p in problems]


def _newton(rows: DataFrame, views: dict[int, dict], fmap: FourierMap, problems: list[_Problem]) -> None:
    """Passes over the rows until every problem is solved."""
    for _ in range(MAX_PASSES):
        open_: dict[int, list] = {}
        for i, p in enumerate(problems):
            if not p.done:
                open_.setdefault(p.t, []).append((i, p.eps, p.width, p.trial()))
        if not open_:
            break

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            acc: dict[tuple, np.ndarray] = {}
            for pdf in batches:
                fold, y = pdf["__fold"].to_numpy(), pdf["__y"].to_numpy()
                pdf = hashed_once(views[next(iter(open_))], pdf)
                for t, some in open_.items():
                    z1 = np.column_stack([fmap.of(matrix(views[t], pdf)), np.ones(len(pdf))])
                    own = fold != t
                    z_held, y_held = z1[~own], y[~own]
                    z1, y_own = (z1, y) if own.all() else (z1[own], y[own])
                    for i, eps, bend, w in some:
                        held = y_held - z_held @ w
                        s = np.concatenate([[held @ held], _loss_sums(z1, y_own, eps, bend, w)])
                        acc[i,] = acc[i,] + s if (i,) in acc else s
            yield from _emit(acc, ["problem"])

        for (i,), s in _collect(rows.mapInPandas(add, "problem int, block int, v array<double>"), ["problem"]).items():
            problems[i].take(s[1:], fmap.n, float(s[0]))


def svr_grid(df: DataFrame, cv, settings, fmap: FourierMap, target: str = "y", fold_col: str = "fold"):
    """([(C, ε, fold, mse)], {(C, ε): model on all rows}, {(C, ε): {fold: model}}) for every (C, ε) at one γ."""
    views = {ALL: view_of(cv, None), **{j: view_of(cv, j) for j in range(cv.k)}}
    errors, models, folds = [], {}, {}
    for t, c, e, w, b, sse in svr_solve(df, views, fmap, settings, target, fold_col):
        m = RandomFeatureModel.of(views[t], fmap, w, b)
        if t == ALL:
            models[c, e] = m
        else:
            folds.setdefault((c, e), {})[t] = m
            if held_out(cv, t):
                errors.append((c, e, t, sse / held_out(cv, t)))
    return errors, models, folds


def scale_gamma(cv) -> float:
    """1 / (number of features · variance over all entries of the processed matrix), from the sums of all rows."""
    tf = cv.transform_for(None)
    g = tf.A @ cv.total @ tf.A.T
    q, n = len(tf.names), g[0, 0]
    total, squares = g[0, 1:q + 1].sum(), np.trace(g[1:q + 1, 1:q + 1])
    var = squares / (n * q) - (total / (n * q)) ** 2
    return 1.0 / (q * var) if q and var > 0 else 1.0
