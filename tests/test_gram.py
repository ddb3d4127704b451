"""One-pass fold statistics against brute-force fold-by-fold refits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators.folds import assign_folds
from hearth.operators.gram import LinearCV, LinearSpec, solve
from hearth.plans import frames as fr
from tests.conftest import SF_SMALL

NUM, CAT = fr.MODEL_NUMERIC, fr.MODEL_CATEGORICAL


@pytest.fixture(scope="module")
def data(spark):
    df = assign_folds(fr.model_frame(spark, SF_SMALL), 5, 42).withColumn("y", F.log("sale_price"))
    cv = LinearCV(df, NUM, CAT, "y", "fold", 5)
    pdf = df.select("id", "fold", *NUM, *CAT, "y").toPandas()
    return df, cv, pdf


def _brute(pdf, spec, k=5):
    out = []
    for j in range(k):
        tr, va = pdf[pdf.fold != j], pdf[pdf.fold == j]
        fit = {}
        for c in NUM:
            med = tr[c].astype(float).median()
            x = tr[c].astype(float).fillna(med)
            sd = x.std(ddof=0)
            fit[c] = (med, x.mean(), sd if sd > 0 else 1.0)
        for c in CAT:
            vc = tr[c].value_counts()
            mode = sorted(vc[vc == vc.max()].index)[0]
            fit[c] = (mode, sorted(tr[c].fillna(mode).unique()))

        def prep(frame):
            cols = [((frame[c].astype(float).fillna(fit[c][0]) - fit[c][1]) / fit[c][2]).to_numpy() for c in NUM]
            for c in CAT:
                x = frame[c].fillna(fit[c][0])
                cols += [(x == lv).astype(float).to_numpy() for lv in fit[c][1]]
            return np.column_stack(cols)

        X, Xv, y = prep(tr), prep(va), tr.y.to_numpy()
        xm, ym = X.mean(0), y.mean()
        Xc = X - xm
        if spec.kind == "ridge":
            b = np.linalg.solve(Xc.T @ Xc + spec.alpha * np.eye(X.shape[1]), Xc.T @ (y - ym))
        else:
            b = np.linalg.lstsq(Xc, y - ym, rcond=None)[0]
        out.append(np.mean((va.y.to_numpy() - (ym - xm @ b) - Xv @ b) ** 2))
    return np.array(out)


@pytest.mark.parametrize("spec", [LinearSpec("ridge", 10.0), LinearSpec("ridge", 0.1), LinearSpec("ols")])
def test_fold_errors_equal_row_level_refits(data, spec):
    _, cv, pdf = data
    got = np.array([e for _, _, e in cv.fold_errors(spec)])
    assert np.allclose(got, _brute(pdf, spec), rtol=1e-7)


def test_oof_expression_equals_quadratic_form(data):
    df, cv, _ = data
    spec = LinearSpec("ridge", 10.0)
    rows = df.withColumn("p", cv.oof_expr(spec)).groupBy("fold") \
        .agg(F.avg((F.col("y") - F.col("p")) ** 2).alias("mse")).orderBy("fold").collect()
    assert np.allclose([r.mse for r in rows], [e for _, _, e in cv.fold_errors(spec)], rtol=1e-7)


def _G(x, y):
    z = np.column_stack([np.ones(len(x)), x, y])
    return z.T @ z


def test_lasso_one_feature_soft_threshold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=200)
    x = (x - x.mean()) / x.std()
    y = 2.0 * x + rng.normal(size=200)
    cfy = np.mean(x * (y - y.mean()))
    for a in (0.1, 0.5, 3.0):
        b0, b = solve(_G(x, y), LinearSpec("lasso", a))
        assert b[0] == pytest.approx(np.sign(cfy) * max(abs(cfy) - a, 0), abs=1e-6)
        b0, b = solve(_G(x, y), LinearSpec("elasticnet", a, 0.5))
        assert b[0] == pytest.approx(np.sign(cfy) * max(abs(cfy) - a / 2, 0) / (1 + a / 2), abs=1e-6)


def test_ols_minimum_norm_with_collinear_columns():
    rng = np.random.default_rng(1)
    a = rng.normal(size=100)
    X = np.column_stack([a, a])  # exactly collinear
    y = 3 * a + rng.normal(size=100) * 0.1
    z = np.column_stack([np.ones(100), X, y])
    b0, b = solve(z.T @ z, LinearSpec("ols"))
    assert b[0] == pytest.approx(b[1])
    assert b.sum() == pytest.approx(np.linalg.lstsq(a[:, None] - a.mean(), y - y.mean(), rcond=None)[0][0])


@pytest.mark.parametrize("l1_ratio", [1.0, 0.5])
def test_elastic_net_meets_its_optimality_conditions(l1_ratio):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(300, 12))
    X = np.column_stack([X, X[:, 0] + X[:, 1], np.zeros(300)])  # a collinear and a constant column
    y = X[:, 0] - 2 * X[:, 3] + rng.normal(size=300)
    z = np.column_stack([np.ones(300), X, y])
    for a in (0.5, 0.05, 0.001):
        b0, b = solve(z.T @ z, LinearSpec("elasticnet", a, l1_ratio))
        slope = X.T @ (y - b0 - X @ b) / 300 - a * (1 - l1_ratio) * b
        used = b != 0
        assert np.allclose(slope[used], a * l1_ratio * np.sign(b[used]), atol=1e-5)
        assert (np.abs(slope[~used]) <= a * l1_ratio + 1e-5).all()
