"""Folds and the linear family (survey 2.9, 2.11 M1–M5, 2.12 V1–V2, J7, A13).

Exact SQL twins exist for a one-feature design (log price on median-imputed,
standardised ``area``), where every fit has a closed form; the same Spark
code path (``LinearCV``) runs the full design, checked by invariants and by
a brute-force row-level test.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import functions as F

from ..functions.scalar import hash_int_sql
from ..operators.folds import assign_folds, assign_inner_folds, fold_sql
from ..operators.gram import LinearCV, LinearSpec
from ..operators.ranks import balanced_folds
from ..operators.search import FAST, FULL
from . import frames as fr
from .catalog import query
from .frames import with_base

B = with_base
K = fr.FOLDS

# Ridge penalties of the reference's fast mode (one-feature keys with an SQL twin).
RIDGE_ALPHAS = [0.1, 1.0, 10.0, 30.0]
# Notebook settings of the single-model runs.
NOTEBOOK_SPECS = [LinearSpec("ols"), LinearSpec("ridge", 10.0), LinearSpec("lasso", 0.0005),
                  LinearSpec("elasticnet", 0.001, 0.5)]
# The elastic-net search of the two-model package.
ENETCV_ALPHAS = [0.0005, 0.001, 0.005, 0.01, 0.05]
ENETCV_L1 = [0.1, 0.5, 0.9]


def folded(spark, sf):
    df = fr.model_frame(spark, sf).withColumn("y", F.log("sale_price"))
    df = assign_inner_folds(assign_folds(df, K, fr.SEED), 3, fr.SEED)
    return assign_inner_folds(df, 5, fr.SEED, col="inner5")


# --- folds -------------------------------------------------------------------

_FOLD = fold_sql("id", K, fr.SEED)


@query("kfold_assign", B() + f"SELECT id, {_FOLD} AS fold FROM model")
def kfold_assign_q(spark, sf):
    return assign_folds(fr.model_frame(spark, sf), K, fr.SEED).select("id", "fold")


@query("kfold_balanced", B() + f"""
SELECT id, CAST((row_number() OVER (ORDER BY {hash_int_sql('id', f'balanced{fr.SEED}')}, id) - 1) % {K} AS INTEGER) AS fold FROM model""")
def kfold_balanced_q(spark, sf):
    """Folds whose sizes differ by at most one."""
    return balanced_folds(fr.model_frame(spark, sf).select("id"), K, fr.SEED)


@query("inner_fold_assign", B() + f"SELECT id, {fold_sql('id', 3, fr.SEED, 'inner')} AS inner FROM model")
def inner_fold_assign_q(spark, sf):
    return assign_inner_folds(fr.model_frame(spark, sf), 3, fr.SEED).select("id", "inner")


@query("fold_split_counts", B() + f"""
SELECT fold, n_valid, CAST(sum(n_valid) OVER () - n_valid AS BIGINT) AS n_train
FROM (SELECT {_FOLD} AS fold, CAST(count(*) AS BIGINT) AS n_valid FROM model GROUP BY 1)""")
def fold_split_counts_q(spark, sf):
    from ..operators.folds import fold_split_counts
    return fold_split_counts(assign_folds(fr.model_frame(spark, sf), K, fr.SEED))


# --- one-feature closed forms -------------------------------------------------

def one_feature_ctes(target_sql: str = "ln(sale_price)") -> list[str]:
    """Per fold k: median of area over the other folds, imputed and standardised
    feature, and its covariance with y over the training part."""
    ks = ", ".join(f"({j})" for j in range(K))
    return [
        f"mf AS (SELECT id, {_FOLD} AS fold, area, neighborhood, sale_price, {target_sql} AS y FROM model)",
        f"ks AS (SELECT * FROM (VALUES {ks}) t(k))",
        "med AS (SELECT ks.k, median(m.area) AS med FROM ks JOIN mf m ON m.fold <> ks.k GROUP BY ks.k)",
        """st AS (SELECT ks.k, count(*) AS n, avg(coalesce(m.area, med.med)) AS mx,
                  stddev_pop(coalesce(m.area, med.med)) AS sx, avg(m.y) AS my,
                  covar_pop(coalesce(m.area, med.med), m.y) AS cxy
           FROM ks JOIN mf m ON m.fold <> ks.k JOIN med ON med.k = ks.k GROUP BY ks.k)""",
        """va AS (SELECT m.id, m.fold AS k, (coalesce(m.area, med.med) - st.mx) / st.sx AS f, m.y
           FROM mf m JOIN med ON med.k = m.fold JOIN st ON st.k = m.fold)""",
    ]


def _coef_sql(kind: str, alpha: float = 0.0, l1: float = 1.0) -> str:
    cfy = "(st.cxy / st.sx)"
    if kind == "ols":
        return cfy
    if kind == "ridge":
        return f"({cfy} * st.n / (st.n + {alpha}))"
    pen = alpha * l1
    soft = f"(sign({cfy}) * greatest(abs({cfy}) - {pen}, 0))"
    return f"({soft} / (1 + {alpha * (1 - l1)}))"


def one_feature_fit_sql(kind: str, alpha: float = 0.0, l1: float = 1.0) -> str:
    return B(*one_feature_ctes()) + f"""
SELECT st.k AS fold, round(st.my, 6) AS intercept, round({_coef_sql(kind, alpha, l1)}, 6) AS coef,
       round(avg(power(va.y - st.my - {_coef_sql(kind, alpha, l1)} * va.f, 2)), 6) AS mse
FROM st JOIN va ON va.k = st.k GROUP BY st.k, st.my, st.cxy, st.sx, st.n"""


def area_cv(spark, sf) -> LinearCV:
    return LinearCV(folded(spark, sf), ["area"], [], "y", "fold", K)


def one_feature_fit(spark, sf, spec: LinearSpec):
    cv = area_cv(spark, sf)
    rows = []
    for (j, nv, mse) in cv.fold_errors(spec):
        _, b0, b = cv.fit(spec, j)
        rows.append((j, round(float(b0), 6), round(float(b[0]), 6), round(float(mse), 6)))
    return spark.createDataFrame(rows, "fold int, intercept double, coef double, mse double")


@query("ols_fit", one_feature_fit_sql("ols"))
def ols_fit_q(spark, sf):
    return one_feature_fit(spark, sf, LinearSpec("ols"))


@query("ridge_fit", one_feature_fit_sql("ridge", 10.0))
def ridge_fit_q(spark, sf):
    return one_feature_fit(spark, sf, LinearSpec("ridge", 10.0))


@query("lasso_fit", one_feature_fit_sql("lasso", 0.01))
def lasso_fit_q(spark, sf):
    return one_feature_fit(spark, sf, LinearSpec("lasso", 0.01))


@query("elasticnet_fit", one_feature_fit_sql("elasticnet", 0.01, 0.5))
def elasticnet_fit_q(spark, sf):
    return one_feature_fit(spark, sf, LinearSpec("elasticnet", 0.01, 0.5))


_ridge_grid_sql = " UNION ALL ".join(
    f"SELECT 'Ridge' AS model, CAST({a} AS DOUBLE) AS alpha, st.k AS fold, "
    f"avg(power(va.y - st.my - {_coef_sql('ridge', a)} * va.f, 2)) AS mse "
    f"FROM st JOIN va ON va.k = st.k GROUP BY st.k, st.my, st.cxy, st.sx, st.n"
    for a in RIDGE_ALPHAS)


@query("grid_cross_folds", B(*one_feature_ctes(), f"g AS ({_ridge_grid_sql})") + """
SELECT model, alpha, fold, round(mse, 6) AS mse FROM g""")
def grid_cross_folds_q(spark, sf):
    """Every grid point × every fold, scored from the same statistics."""
    cv = area_cv(spark, sf)
    rows = [("Ridge", a, j, round(mse, 6)) for a in RIDGE_ALPHAS
            for (j, _, mse) in cv.fold_errors(LinearSpec("ridge", a))]
    return spark.createDataFrame(rows, "model string, alpha double, fold int, mse double")


@query("grid_score", B(*one_feature_ctes(), f"g AS ({_ridge_grid_sql})") + """
SELECT model, alpha, round(sqrt(avg(mse)), 6) AS cv_rmse FROM g GROUP BY model, alpha""")
def grid_score_q(spark, sf):
    """Grid-search score: root of the mean fold MSE."""
    cv = area_cv(spark, sf)
    rows = [("Ridge", a, round(math.sqrt(sum(m for _, _, m in cv.fold_errors(LinearSpec("ridge", a))) / K), 6))
            for a in RIDGE_ALPHAS]
    return spark.createDataFrame(rows, "model string, alpha double, cv_rmse double")


# --- full design --------------------------------------------------------------

def full_cv(spark, sf, inner: bool = False, inner_col: str = "inner", k_inner: int = 3) -> LinearCV:
    return LinearCV(folded(spark, sf), fr.MODEL_NUMERIC, fr.MODEL_CATEGORICAL, "y", "fold", K,
                    inner_col=inner_col if inner else None, k_inner=k_inner)


def grid_specs(grids: dict = FAST):
    """Every point of the reference's grids of the linear family."""
    specs = [LinearSpec("ols")]
    specs += [LinearSpec("ridge", a) for a in grids["Ridge"]["alpha"]]
    specs += [LinearSpec("lasso", a) for a in grids["Lasso"]["alpha"]]
    specs += [LinearSpec("elasticnet", a, r) for a in grids["ElasticNet"]["alpha"] for r in grids["ElasticNet"]["l1_ratio"]]
    return specs


def grid_table(cv: LinearCV, specs):
    """(model, params, cv_rmse = sqrt(mean fold MSE)) for each spec; best per model."""
    rows = []
    all_errs = cv.grid_errors(specs)
    for s in specs:
        errs = [m for _, _, m in all_errs[s]]
        rows.append((s.name, json.dumps(s.params()), math.sqrt(sum(errs) / len(errs))))
    best = {}
    for name, params, score in rows:
        if name not in best or score < best[name][1]:
            best[name] = (params, score)
    return [(n, p, round(sc, 6), best[n][0] == p) for n, p, sc in rows]


@query("grid_search")
def grid_search_q(spark, sf):
    cv = full_cv(spark, sf)
    return spark.createDataFrame(grid_table(cv, grid_specs()),
                                 "model string, params string, cv_rmse double, is_best boolean")


@query("grid_search_full")
def grid_search_full_q(spark, sf):
    """The same over the reference's full grids: no further pass over the data."""
    return spark.createDataFrame(grid_table(full_cv(spark, sf), grid_specs(FULL)),
                                 "model string, params string, cv_rmse double, is_best boolean")


def cv_summary(errs):
    """mean and population std of per-fold RMSE over the finite folds;
    no finite fold → (inf, NaN)."""
    r = [math.sqrt(m) for m in errs if m is not None and math.isfinite(m)]
    if not r:
        return float("inf"), float("nan")
    mu = sum(r) / len(r)
    return mu, math.sqrt(sum((x - mu) ** 2 for x in r) / len(r))


@query("model_family_run")
def model_family_run_q(spark, sf):
    """The linear family at the notebook settings: per-fold RMSE summarised."""
    cv = full_cv(spark, sf)
    rows = []
    for s in NOTEBOOK_SPECS:
        mu, sd = cv_summary([m for _, _, m in cv.fold_errors(s)])
        rows.append((s.name, round(mu, 6), round(sd, 6), json.dumps(s.params())))
    return spark.createDataFrame(rows, "model string, cv_rmsle_mean double, cv_rmsle_std double, best_params string")


@query("elasticnet_cv")
def elasticnet_cv_q(spark, sf):
    """Elastic net whose (α, l1) is chosen inside each outer fold by a 3-fold
    inner search, then scored on the outer fold — all from one set of cells."""
    cv = full_cv(spark, sf, inner=True)
    specs = [LinearSpec("elasticnet", a, l) for a in ENETCV_ALPHAS for l in ENETCV_L1]
    rows = []
    for j in range(K):
        scores = cv.inner_search(specs, j)
        best = min(specs, key=lambda s: (scores[s], specs.index(s)))
        tf, b0, b = cv.fit(best, j)
        from ..operators.gram import sse
        Gv = tf.A @ cv.fold_S[j] @ tf.A.T
        nv = cv.fold_S[j][0, 0]
        rows.append((j, best.alpha, best.l1_ratio, round(math.sqrt(sse(Gv, b0, b) / nv), 6)))
    return spark.createDataFrame(rows, "fold int, alpha double, l1_ratio double, rmse double")


# Stacking bases (the first candidates in result order that the
# fold statistics can express) and the meta learner's penalty.
STACK_BASES = [LinearSpec("ridge", 10.0), LinearSpec("lasso", 0.0005), LinearSpec("elasticnet", 0.001, 0.5)]
STACK_META_ALPHA = 10.0


@query("stacking_cv")
def stacking_cv_q(spark, sf):
    """Stacking of ridge, lasso and elastic net under a ridge(10) meta model,
    cross-validated (5 outer × 5 inner folds) from one set of cells."""
    cv = full_cv(spark, sf, inner=True, inner_col="inner5", k_inner=5)
    rows = [(k, round(math.sqrt(mse), 6), *[round(x, 6) for x in a])
            for k, _, mse, a in cv.stack_errors(STACK_BASES, STACK_META_ALPHA)]
    return spark.createDataFrame(rows, "fold int, rmse double, w_ridge double, w_lasso double, w_elasticnet double")
