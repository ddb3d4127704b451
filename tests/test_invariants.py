"""Invariants for the queries without an SQL twin (survey §5, R rows), and a
port of the reference's end-to-end smoke assertions."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from hearth.operators import explain as X
from hearth.operators.gram import LinearSpec
from hearth.plans import frames as fr
from hearth.plans.q_models import folded, full_cv
from tests.conftest import SF_SMALL

Q = queries()


@pytest.fixture(scope="module")
def mean_rmse(spark):
    """RMSE of predicting the mean log price: every model must beat it."""
    df = folded(spark, SF_SMALL)
    return df.agg(F.stddev_pop("y")).first()[0]


@pytest.mark.parametrize("name", ["rf_fit", "gbt_target_encoded", "gbt_ordinal", "gbt_categorical",
                                  "rff_ridge", "rff_huber"])
def test_model_families_beat_mean(spark, mean_rmse, name):
    rows = Q[name](spark, SF_SMALL).collect()
    assert len(rows) == fr.FOLDS
    for r in rows:
        assert math.isfinite(r.rmse) and r.rmse < mean_rmse


def test_forest_repeatable(spark):
    a = sorted(tuple(r) for r in Q["rf_fit"](spark, SF_SMALL).collect())
    b = sorted(tuple(r) for r in Q["rf_fit"](spark, SF_SMALL).collect())
    assert a == b


def test_linear_grid_and_families(spark, mean_rmse):
    g = Q["grid_search"](spark, SF_SMALL).collect()
    assert {r.model for r in g} == {"LinearRegression", "Ridge", "Lasso", "ElasticNet"}
    assert sum(r.is_best for r in g) == 4
    assert all(r.cv_rmse < mean_rmse for r in g)
    fam = Q["model_family_run"](spark, SF_SMALL).collect()
    assert all(r.cv_rmsle_mean < mean_rmse and r.cv_rmsle_std >= 0 for r in fam)
    e = Q["elasticnet_cv"](spark, SF_SMALL).collect()
    assert len(e) == fr.FOLDS and all(r.rmse < mean_rmse for r in e)


def test_model_roundtrip(spark):
    rows = Q["model_roundtrip"](spark, SF_SMALL).collect()
    assert rows and all(r.same for r in rows) and all(r.price > 0 for r in rows)


def test_linear_attribution_adds_up(spark):
    rows = Q["linear_attribution"](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        assert r.base_value + r.impact_sum == pytest.approx(r.prediction, abs=1e-6)
        assert r.n_factors == len(fr.MODEL_NUMERIC) + len(fr.MODEL_CATEGORICAL)
    bases = {round(r.base_value, 6) for r in rows}
    assert len(bases) == 1  # one base value for all rows


def _h(s):
    return int(hashlib.md5(s.encode()).hexdigest()[:8], 16)


def test_permutation_importance_equals_all_donors(spark):
    """The closed form is the mean rise when each row takes each row's value once."""
    df = folded(spark, SF_SMALL)
    cv = full_cv(spark, SF_SMALL)
    spec = LinearSpec("ridge", 10.0)
    got = {r.feature: r.importance for r in X.permutation_importance_linear(df, cv, spec, "y").collect()}
    tf, b0, b = cv.fit(spec, None)
    pred = cv.prediction_expr(tf, b0, b)
    terms = X.linear_terms(cv, tf, b)
    pdf = df.select((F.col("y") - pred).alias("e"), *[t.alias(f) for f, t in terms.items()]).toPandas()
    for feat in terms:
        e, t = pdf["e"].to_numpy(), pdf[feat].to_numpy()
        total = sum(np.sum((e + t - donor) ** 2 - e * e) for donor in t)
        assert got[feat] == pytest.approx(total / len(t) ** 2, rel=1e-6, abs=1e-9)
    assert got["area"] > 0


def test_linear_terms_add_up_to_the_prediction(spark):
    """Rescoring a row with another value of a column moves the prediction by the terms' difference."""
    df = folded(spark, SF_SMALL)
    cv = full_cv(spark, SF_SMALL)
    tf, b0, b = cv.fit(LinearSpec("ridge", 10.0), None)
    pred = cv.prediction_expr(tf, b0, b)
    gap = pred - sum(X.linear_terms(cv, tf, b).values(), F.lit(0.0))
    r = df.agg(F.min(gap).alias("lo"), F.max(gap).alias("hi")).first()
    assert r.hi - r.lo == pytest.approx(0, abs=1e-9)


def test_ensemble_smoke(spark):
    """The reference's smoke test, on the driver tables: finite blended score
    below 0.5, weight in [0, 1], reload works, positive prices, k finite factors."""
    m = Q["ensemble_fit"](spark, SF_SMALL).first()
    assert math.isfinite(m.cv_rmsle_blend) and m.cv_rmsle_blend < 0.5
    assert 0.0 <= m.blend_weight_linear <= 1.0
    assert m.cv_rmsle_blend <= min(m.cv_rmsle_linear, m.cv_rmsle_catboost) + 1e-12
    assert all(r.price > 0 for r in Q["ensemble_predict"](spark, SF_SMALL).collect())
    top = Q["top_k_factors"](spark, SF_SMALL).toPandas()
    assert (top.groupby("id").size() == 5).all()
    assert np.isfinite(top.impact_log).all()


def test_stream_dedupes_and_matches_batch(spark):
    rows = Q["alerts_stream"](spark, SF_SMALL).collect()
    keys = [(r.user_id, r.id) for r in rows]
    assert len(keys) == len(set(keys))  # re-sent listings are dropped


def test_step_status_records_failure(spark):
    rows = {r.step: r for r in Q["step_status"](spark, SF_SMALL).collect()}
    assert rows["scan_listings_csv"].status == "error: FileNotFoundError"
    assert rows["missing_profile"].status == "ok"


def test_every_family_is_compared_and_the_best_is_used(spark):
    rows = Q["model_comparison_all"](spark, SF_SMALL).collect()
    assert len(rows) == 11 and rows[0].model == Q["best_model_predict"](spark, SF_SMALL).first().model
    scores = [r.cv_rmsle_mean for r in rows]
    assert scores == sorted(scores) and all(0 < s < 0.2 for s in scores)
    assert all(r.status == "ok" and r.message is None for r in Q["model_status"](spark, SF_SMALL).collect())
    n = fr.model_frame(spark, SF_SMALL, "test").count()
    for name in ("best_model_predict", "weighted_blend_fitted", "stacking_fitted", "two_model_predict"):
        priced = Q[name](spark, SF_SMALL).collect()
        assert len(priced) == n and all(r.price >= 1 for r in priced)
    assert Q["submission_per_model"](spark, SF_SMALL).groupBy("submission").count().filter(f"count = {n}").count() == 11
    imp = Q["permutation_importance"](spark, SF_SMALL).collect()
    assert len(imp) == len(fr.MODEL_NUMERIC) + len(fr.MODEL_CATEGORICAL)
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)


def test_files_of_the_two_model_chain(spark):
    m = Q["ensemble_fit"](spark, SF_SMALL).first()
    j = Q["metrics_json"](spark, SF_SMALL).first()
    assert j.blend_weight_linear == m.blend_weight_linear and j.target == "log1p" and j.n_numeric_features == m.n_numeric_features
    log = Q["prediction_log"](spark, SF_SMALL).collect()
    assert len(log) == fr.model_frame(spark, SF_SMALL, "test").count()
    assert {(len(r.data_version), r.n_features) for r in log} == {(16, m.n_linear_features)}


def test_kernel_grids_cover_the_reference(spark):
    from hearth.operators.search import FAST, FULL, points
    rows = Q["kernel_ridge_search"](spark, SF_SMALL).collect()
    assert len(rows) == fr.FOLDS * len(points(FULL["KernelRidge_RBF"])) and sum(r.is_best for r in rows) == fr.FOLDS
    rows = Q["svr_search"](spark, SF_SMALL).collect()
    assert len(rows) == fr.FOLDS * len(points(FAST["SVR_RBF"])) and all(r.rmse < 0.15 for r in rows)


def test_full_linear_grid(spark):
    rows = Q["grid_search_full"](spark, SF_SMALL).collect()
    assert len(rows) == 38 and sum(r.is_best for r in rows) == 4
    fast = {(r.model, r.params): r.cv_rmse for r in Q["grid_search"](spark, SF_SMALL).collect()}
    both = [(r.cv_rmse, fast[r.model, r.params]) for r in rows if (r.model, r.params) in fast]
    assert len(both) > 10 and all(a == pytest.approx(b, abs=1e-6) for a, b in both)
