"""Gram ridge vs MLlib LinearRegression on the same processed features.

MLlib scales the label by its standard deviation inside and does not undo it
for the L2 term, so with ``standardization=False`` and the normal solver the
scikit-learn ridge α corresponds to regParam = α·s_y/n, s_y the population
standard deviation of the label.
"""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hearth.operators import transformers as T
from hearth.operators.gram import LinearCV, LinearSpec
from hearth.plans import frames as fr
from hearth.plans.q_models import folded
from tests.conftest import SF_SMALL

NUM, CAT = fr.MODEL_NUMERIC, fr.MODEL_CATEGORICAL


@pytest.mark.parametrize("alpha", [1.0, 10.0])
def test_ridge_matches_mllib(spark, alpha):
    df = folded(spark, SF_SMALL)
    cv = LinearCV(df, NUM, CAT, "y", "fold", 5)
    tf, b0, b = cv.fit(LinearSpec("ridge", alpha), None)
    feats = T.linear_pipeline(NUM, CAT).fit(df).transform(df)  # replaces the numeric columns
    assert T.feature_names(feats)[:len(NUM)] == NUM
    n, sy = df.agg(F.count("y"), F.stddev_pop("y")).first()
    lr = LinearRegression(featuresCol="features", labelCol="y", regParam=alpha * sy / n,
                          elasticNetParam=0.0, standardization=False, solver="normal", tol=1e-12)
    m = lr.fit(feats)
    ours = df.select("id", cv.prediction_expr(tf, b0, b).alias("p"))  # raw columns
    theirs = m.transform(feats).select("id", F.col("prediction").alias("q"))
    diff = ours.join(theirs, "id").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert diff < 1e-6
    coef = np.array(m.coefficients.toArray())
    assert np.allclose(coef[:len(NUM)], b[:len(NUM)], atol=1e-6)


def test_elastic_net_matches_mllib(spark):
    """(α, l1) ↔ λ = α·l1 + s_y·α·(1 − l1), elasticNetParam = α·l1/λ, with the
    sample std s_y for MLlib's quasi-Newton solver."""
    alpha, l1 = 0.001, 0.5
    df = folded(spark, SF_SMALL)
    cv = LinearCV(df, NUM, CAT, "y", "fold", 5)
    tf, b0, b = cv.fit(LinearSpec("elasticnet", alpha, l1, max_iter=100000), None)
    feats = T.linear_pipeline(NUM, CAT).fit(df).transform(df)
    sy = df.agg(F.stddev_samp("y")).first()[0]
    lam = alpha * l1 + sy * alpha * (1 - l1)
    lr = LinearRegression(featuresCol="features", labelCol="y", regParam=lam, elasticNetParam=alpha * l1 / lam,
                          standardization=False, maxIter=1000, tol=1e-12)
    m = lr.fit(feats)
    ours = df.select("id", cv.prediction_expr(tf, b0, b).alias("p"))
    theirs = m.transform(feats).select("id", F.col("prediction").alias("q"))
    diff = ours.join(theirs, "id").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert diff < 1e-3
