"""Stacking from nested fold cells against an explicit row-level stack."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators.gram import LinearCV, LinearSpec, solve
from hearth.plans import frames as fr
from hearth.plans.q_models import STACK_BASES, folded
from tests.conftest import SF_SMALL

NUM, CAT = fr.MODEL_NUMERIC, fr.MODEL_CATEGORICAL


def _fit_prep(tr, medians):
    fit = {}
    for c in NUM:
        x = tr[c].astype(float).fillna(medians[c])
        sd = x.std(ddof=0)
        fit[c] = (medians[c], x.mean(), sd if sd > 1e-12 * max(1, x.mean() ** 2) else 1.0)
    for c in CAT:
        vc = tr[c].value_counts()
        mode = sorted(vc[vc == vc.max()].index)[0]
        fit[c] = (mode, sorted(tr[c].fillna(mode).unique()))
    return fit


def _prep(frame, fit):
    cols = [((frame[c].astype(float).fillna(fit[c][0]) - fit[c][1]) / fit[c][2]).to_numpy() for c in NUM]
    for c in CAT:
        x = frame[c].fillna(fit[c][0])
        cols += [(x == lv).astype(float).to_numpy() for lv in fit[c][1]]
    return np.column_stack(cols)


def _fit_predict(Xtr, ytr, Xte, spec):
    z = np.column_stack([np.ones(len(Xtr)), Xtr, ytr])
    b0, b = solve(z.T @ z, spec)
    return b0 + Xte @ b


def test_stack_matches_row_level(spark):
    df = folded(spark, SF_SMALL)
    cv = LinearCV(df, NUM, CAT, "y", "fold", 5, inner_col="inner5", k_inner=5)
    got = cv.stack_errors(STACK_BASES, 10.0)
    pdf = df.select("fold", "inner5", *NUM, *CAT, "y").toPandas()
    for k, _, mse, weights in got:
        T, V = pdf[pdf.fold != k], pdf[pdf.fold == k]
        med = {c: T[c].astype(float).median() for c in NUM}
        P = np.zeros((len(T), len(STACK_BASES)))
        for i in range(5):
            tr_mask = (T.inner5 != i).to_numpy()
            fit = _fit_prep(T[tr_mask], med)
            Xtr, Xte = _prep(T[tr_mask], fit), _prep(T[~tr_mask], fit)
            for j, spec in enumerate(STACK_BASES):
                P[~tr_mask, j] = _fit_predict(Xtr, T.y.to_numpy()[tr_mask], Xte, spec)
        a = _fit_predict(P, T.y.to_numpy(), np.eye(len(STACK_BASES)), LinearSpec("ridge", 10.0))
        a0 = _fit_predict(P, T.y.to_numpy(), np.zeros((1, len(STACK_BASES))), LinearSpec("ridge", 10.0))[0]
        w = a - a0
        assert np.allclose(w, weights, rtol=1e-5, atol=1e-7)
        fit = _fit_prep(T, med)
        Xtr, Xv = _prep(T, fit), _prep(V, fit)
        Pv = np.column_stack([_fit_predict(Xtr, T.y.to_numpy(), Xv, s) for s in STACK_BASES])
        brute = np.mean((V.y.to_numpy() - a0 - Pv @ w) ** 2)
        assert mse == pytest.approx(brute, rel=1e-5)


def test_synthetic_recipe_has_signal(spark):
    from __spark_entry__ import queries
    df = queries()["synthetic_listings"](spark, SF_SMALL)
    r = df.agg(F.corr("GrLivArea", "SalePrice").alias("r"), F.min("SalePrice").alias("lo"),
               F.count(F.lit(1)).alias("n")).first()
    assert r.r > 0.3 and r.lo >= 35000
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert r.n == orders  # one row per key, whole table
