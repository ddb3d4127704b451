"""Null and edge cases on small hand-made frames (unit level)."""

import math

import pytest
from pyspark.sql import functions as F

from hearth.operators import clean as C
from hearth.operators import profile as P
from hearth.operators import transformers as T
from hearth.operators.ensemble import inverse_error_weights, pick_blend
from hearth.operators.features import derive_features
from hearth.plans.q_models import cv_summary


def test_age_floor_keeps_null(spark):
    df = spark.createDataFrame([(1, 2000, 1990, 1995), (2, 1990, 2000, None), (3, None, 1990, 1990)],
                               "id int, yr_sold int, year_built int, year_remod int")
    out = {r.id: r for r in derive_features(df).collect()}
    assert out[1].house_age == 10 and out[1].years_since_remodel == 5
    assert out[2].house_age == 0 and out[2].years_since_remodel is None
    assert out[3].house_age is None
    assert out[3].total_sf == 0.0 and out[3].total_bath == 0.0


def test_outlier_filter_keeps_null_comparisons(spark):
    df = spark.createDataFrame([(1, 5000, 100.0), (2, None, 100.0), (3, 5000, None), (4, 100, 100.0)],
                               "id int, area int, sale_price double")
    kept = sorted(r.id for r in C.remove_outliers(df, area_gt=4000, price_lt=300000).collect())
    assert kept == [2, 3, 4]
    assert C.outlier_count(df, area_gt=4000, price_lt=300000).first().n_outliers == 1


def test_correlation_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 6.0), (4.0, 8.0)], "a double, sale_price double")
    r = {x.column: x.abs_corr for x in P.target_correlation(df).collect()}
    assert r["a"] == pytest.approx(1.0)


def test_missing_profile_empty(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert P.missing_profile(df).count() == 0


def test_median_mode_scaler(spark):
    df = spark.createDataFrame([(1.0, "b", 5.0), (2.0, "a", 5.0), (10.0, "b", 5.0), (20.0, "a", 5.0),
                                (None, None, 5.0)], "x double, c string, z double")
    assert T.MedianImputer(["x"]).fit(df).medians["x"] == 6.0
    assert T.ModeImputer(["c"]).fit(df).modes["c"] == "a"  # tie → smallest
    sc = T.PopulationScaler(["z", "x"]).fit(df)
    assert list(sc.stats["z"]) == [5.0, 1.0]  # zero variance → divide by 1
    assert sc.stats["x"][1] == pytest.approx(7.628073151196179)


def test_one_hot_unseen_and_null_are_zero(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    tr = spark.createDataFrame([("a",), ("b",)], "c string")
    te = spark.createDataFrame([("a",), ("z",)], "c string")
    m = Pipeline(stages=T.one_hot_stages(["c"])).fit(tr)
    rows = m.transform(te).select(vector_to_array("c_oh").alias("v")).collect()
    assert [list(r.v) for r in rows] == [[1.0, 0.0], [0.0, 0.0]]


def test_non_finite_scores():
    assert cv_summary([float("nan"), float("inf")])[0] == float("inf")
    mu, sd = cv_summary([0.04, float("nan"), 0.09])
    assert mu == pytest.approx(0.25) and sd == pytest.approx(0.05)
    w = inverse_error_weights({"a": 0.1, "b": float("inf"), "c": 0.2, "d": float("nan")})
    assert set(w) == {"a", "c"} and sum(w.values()) == pytest.approx(1.0)
    assert pick_blend([{"w": 0.0, "rmse": 1.0}, {"w": 0.05, "rmse": 1.0}]) == (0.0, 1.0)
    assert math.isfinite(pick_blend([])[0])


def test_salted_top_k_equals_plain_window_with_a_hot_group(spark):
    """A group holding a third of the rows gets the same top-k as a plain window."""
    from pyspark.sql import Window

    from hearth.operators.ensemble import top_k_per_group
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                  .otherwise((F.col("id") % 7).cast("string")).alias("g"),
                                  ((F.col("id") * 7919) % 1009).cast("double").alias("v"))
    order = [F.desc("v"), F.asc("id")]
    got = {(r.g, r.id, r.rank) for r in top_k_per_group(df, "g", order, 5).collect()}
    w = Window.partitionBy("g").orderBy(*order)
    want = {(r.g, r.id, r.rank) for r in df.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= 5).collect()}
    assert got == want


def test_encoders_mark_levels_they_have_not_seen(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from hearth.operators import transformers as T
    tr = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    te = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert [r.k_ord for r in T.OrdinalEncoder(["k"]).fit(tr).transform(te).orderBy("k").collect()] == [0.0, -1.0, 1.0]
    hot = Pipeline(stages=T.one_hot_stages(["k"])).fit(tr.na.drop()).transform(te).orderBy("k")
    assert [list(r[0]) for r in hot.select(vector_to_array("k_oh")).collect()] == [[1, 0], [0, 0], [0, 1]]


def test_json_text_equals_json_dumps(spark):
    import json

    from hearth.functions.scalar import json_text
    texts = ["", "plain text", 'a "quoted" word', "back\\slash", "line\nfeed\r\t\b\f", "\x00\x1f\x7f", "é ß 漢字 😀", "end\n", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(json_text("t")).collect()] == [json.dumps(t) for t in texts]
