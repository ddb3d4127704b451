"""Out-of-fold table, blends, stacking, ensemble and the data products built
on them (survey J2, A12, A14–A17, L3, M12–M17, V1, V3, V6–V7, S8, S11, D1–D4, D6).

Two closed-form bases keep every number checkable in SQL: the neighbourhood
mean of log price over the other folds ("group", the tree stand-in) and the
one-feature regression on area fitted on the other folds ("area", linear).
"""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.scalar import hash_int, hash_int_sql, rnd
from ..operators import ensemble as E
from ..operators.gram import LinearCV, LinearSpec
from . import frames as fr
from .catalog import query
from .frames import with_base
from .q_models import K, folded, one_feature_ctes

B = with_base
OLS = LinearSpec("ols")
VERDICT_TOLERANCE = 0.10
PRICE_BANDS = [250000, 350000, 450000]   # segment edges of the error audit
BAND_Q = (0.05, 0.95)                    # confidence band quantiles
AREA_BIN = 500                            # drift bins
AREA_BINS = 8


def oof_frame(spark, sf, with_cv: bool = False):
    df = folded(spark, sf)
    cv = LinearCV(df, ["area"], [], "y", "fold", K)
    out = E.group_mean_oof(df.withColumn("pred_area", cv.oof_expr(OLS)), "neighborhood", "y")
    return (out, cv, df) if with_cv else out


_OOF_CTES = one_feature_ctes() + [
    "grp AS (SELECT ks.k, m.neighborhood, avg(m.y) AS gm FROM ks JOIN mf m ON m.fold <> ks.k GROUP BY 1, 2)",
    "gall AS (SELECT ks.k, avg(m.y) AS gmean FROM ks JOIN mf m ON m.fold <> ks.k GROUP BY 1)",
    """oof AS (SELECT mf.id, mf.fold, mf.neighborhood, mf.sale_price, mf.y,
                coalesce(grp.gm, gall.gmean) AS pred_group,
                st.my + (st.cxy / st.sx) * va.f AS pred_area
         FROM mf JOIN va ON va.id = mf.id JOIN st ON st.k = mf.fold JOIN gall ON gall.k = mf.fold
         LEFT JOIN grp ON grp.k = mf.fold AND grp.neighborhood = mf.neighborhood)""",
]


def OB(*extra):
    return B(*_OOF_CTES, *extra)


@query("oof_predictions", OB() + """
SELECT id, fold, round(y, 9) AS y_log, round(pred_group, 9) AS pred_group, round(pred_area, 9) AS pred_area FROM oof""")
def oof_predictions_q(spark, sf):
    return oof_frame(spark, sf).select("id", "fold", rnd("y", 9).alias("y_log"),
                                       rnd("pred_group", 9).alias("pred_group"),
                                       rnd("pred_area", 9).alias("pred_area"))


@query("oof_rmsle", OB() + """
SELECT 'group' AS model, round(sqrt(avg(power(y - pred_group, 2))), 6) AS rmse FROM oof
UNION ALL SELECT 'area', round(sqrt(avg(power(y - pred_area, 2))), 6) FROM oof""")
def oof_rmsle_q(spark, sf):
    o = oof_frame(spark, sf)
    r = o.agg(E.rmse_col("y", "pred_group").alias("group"), E.rmse_col("y", "pred_area").alias("area"))
    return r.unpivot([], ["group", "area"], "model", "rmse").select("model", rnd("rmse", 6).alias("rmse"))


_FOLD_RMSE = """fr AS (SELECT fold, sqrt(avg(power(y - pred_group, 2))) AS r_group, sqrt(avg(power(y - pred_area, 2))) AS r_area,
                    sqrt(avg(power(y - (pred_group + pred_area) / 2, 2))) AS r_mean FROM oof GROUP BY fold),
scores AS (SELECT 'group' AS model, avg(r_group) AS m, stddev_pop(r_group) AS s FROM fr
           UNION ALL SELECT 'area', avg(r_area), stddev_pop(r_area) FROM fr
           UNION ALL SELECT 'equal_blend', avg(r_mean), stddev_pop(r_mean) FROM fr)"""


def fold_scores(o):
    """mean / population std of per-fold RMSE for each base and their mean."""
    per = o.groupBy("fold").agg(E.rmse_col("y", "pred_group").alias("group"),
                                E.rmse_col("y", "pred_area").alias("area"),
                                E.rmse_col("y", (F.col("pred_group") + F.col("pred_area")) / 2).alias("equal_blend"))
    long = per.unpivot(["fold"], ["group", "area", "equal_blend"], "model", "r")
    finite = ~F.isnan("r") & (F.abs("r") < float("inf"))
    r = F.when(finite, F.col("r"))  # a model without a finite fold scores (inf, NaN)
    return long.groupBy("model").agg(F.coalesce(F.avg(r), F.lit(float("inf"))).alias("m"),
                                     F.coalesce(F.stddev_pop(r), F.lit(float("nan"))).alias("s"))


@query("cv_score", OB(_FOLD_RMSE) + """
SELECT model, round(m, 6) AS cv_rmsle_mean, round(s, 6) AS cv_rmsle_std FROM scores""")
def cv_score_q(spark, sf):
    s = fold_scores(oof_frame(spark, sf))
    return s.select("model", rnd("m", 6).alias("cv_rmsle_mean"), rnd("s", 6).alias("cv_rmsle_std"))


@query("model_comparison", OB(_FOLD_RMSE) + """
SELECT model, round(m, 6) AS cv_rmsle_mean, round(s, 6) AS cv_rmsle_std, '{}' AS best_params,
       CAST(row_number() OVER (ORDER BY CASE WHEN isfinite(m) THEN m ELSE 'inf'::DOUBLE END, model) AS INTEGER) AS rank
FROM scores""")
def model_comparison_q(spark, sf):
    """Ascending by score, non-finite scores last."""
    s = fold_scores(oof_frame(spark, sf))
    key = F.when(~F.isnan("m") & (F.abs("m") < float("inf")), F.col("m")).otherwise(F.lit(float("inf")))
    from pyspark.sql import Window
    return s.select("model", rnd("m", 6).alias("cv_rmsle_mean"), rnd("s", 6).alias("cv_rmsle_std"),
                    F.lit("{}").alias("best_params"),
                    F.row_number().over(Window.orderBy(key, "model")).cast("int").alias("rank"))


@query("best_model", OB(_FOLD_RMSE) + """
SELECT arg_min(model, CASE WHEN isfinite(m) THEN m ELSE 'inf'::DOUBLE END) AS model, round(min(m), 6) AS cv_rmsle_mean FROM scores""")
def best_model_q(spark, sf):
    s = fold_scores(oof_frame(spark, sf))
    key = F.when(~F.isnan("m") & (F.abs("m") < float("inf")), F.col("m")).otherwise(F.lit(float("inf")))
    return s.agg(F.min_by("model", key).alias("model"), rnd(F.min("m"), 6).alias("cv_rmsle_mean"))


_WEIGHTS = """top3 AS (SELECT model, m FROM scores WHERE isfinite(m) ORDER BY m, model LIMIT 3),
wts AS (SELECT model, (1 / greatest(m, 1e-6)) / sum(1 / greatest(m, 1e-6)) OVER () AS w FROM top3)"""


@query("inverse_error_weights", OB(_FOLD_RMSE, _WEIGHTS) + "SELECT model, round(w, 9) AS weight FROM wts")
def inverse_error_weights_q(spark, sf):
    s = fold_scores(oof_frame(spark, sf)).collect()  # one row per model
    w = E.inverse_error_weights({r["model"]: r["m"] for r in s})
    return spark.createDataFrame([(m, round(v, 9)) for m, v in w.items()], "model string, weight double")


@query("weighted_blend", OB(_FOLD_RMSE, _WEIGHTS) + """
SELECT id, round(greatest(exp(
    coalesce((SELECT round(w, 9) FROM wts WHERE model = 'group'), 0) * pred_group
  + coalesce((SELECT round(w, 9) FROM wts WHERE model = 'area'), 0) * pred_area
  + coalesce((SELECT round(w, 9) FROM wts WHERE model = 'equal_blend'), 0) * (pred_group + pred_area) / 2), 1), 2) AS price
FROM oof""")
def weighted_blend_q(spark, sf):
    o = oof_frame(spark, sf)
    s = fold_scores(o).collect()
    w = E.inverse_error_weights({r["model"]: r["m"] for r in s})
    preds = {"group": F.col("pred_group"), "area": F.col("pred_area"),
             "equal_blend": (F.col("pred_group") + F.col("pred_area")) / 2}
    log_pred = sum((F.lit(round(v, 9)) * preds[m] for m, v in w.items()), F.lit(0.0))
    return o.select("id", rnd(F.greatest(F.exp(log_pred), F.lit(1.0)), 2).alias("price"))


@query("equal_blend", OB() + """
SELECT id, round((pred_group + pred_area) / 2, 9) AS pred_log,
       round(greatest(exp((pred_group + pred_area) / 2), 1), 4) AS price FROM oof""")
def equal_blend_q(spark, sf):
    o = oof_frame(spark, sf)
    m = (F.col("pred_group") + F.col("pred_area")) / 2
    return o.select("id", rnd(m, 9).alias("pred_log"), rnd(F.greatest(F.exp(m), F.lit(1.0)), 4).alias("price"))


_GRID_VALUES = ", ".join(f"({w})" for w in E.BLEND_GRID)
_BLEND = f"""bg AS (SELECT CAST(w AS DOUBLE) AS w, sqrt(avg(power(y - (w * pred_area + (1 - w) * pred_group), 2))) AS rmse
         FROM (VALUES {_GRID_VALUES}) g(w), oof GROUP BY w),
best AS (SELECT w, rmse FROM bg ORDER BY rmse, w LIMIT 1)"""


@query("blend_search", OB(_BLEND) + """
SELECT w, round(rmse, 6) AS rmse, w = (SELECT w FROM best) AS is_best FROM bg""")
def blend_search_q(spark, sf):
    scores = E.blend_scores(oof_frame(spark, sf), "y", "pred_area", "pred_group").cache()
    best_w, _ = E.pick_blend(scores.collect())  # 21 rows
    return scores.select("w", rnd("rmse", 6).alias("rmse"), (F.col("w") == best_w).alias("is_best"))


@query("stacking", OB() + """
, cs AS (SELECT count(*) AS n, avg(y) AS my, avg(pred_area) AS ma, avg(pred_group) AS mg,
              covar_pop(pred_area, pred_area) * count(*) AS saa, covar_pop(pred_area, pred_group) * count(*) AS sag,
              covar_pop(pred_group, pred_group) * count(*) AS sgg, covar_pop(pred_area, y) * count(*) AS say,
              covar_pop(pred_group, y) * count(*) AS sgy FROM oof),
sol AS (SELECT *, ((sgg + 10) * say - sag * sgy) / ((saa + 10) * (sgg + 10) - sag * sag) AS wa,
               ((saa + 10) * sgy - sag * say) / ((saa + 10) * (sgg + 10) - sag * sag) AS wg FROM cs)
SELECT round(my - wa * ma - wg * mg, 6) AS intercept, round(wa, 6) AS w_area, round(wg, 6) AS w_group FROM sol""")
def stacking_q(spark, sf):
    """Meta ridge (α = 10) on the out-of-fold base predictions."""
    b0, (wa, wg) = E.ridge_meta(oof_frame(spark, sf), "y", ["pred_area", "pred_group"], 10.0)
    return spark.createDataFrame([(round(b0, 6), round(wa, 6), round(wg, 6))],
                                 "intercept double, w_area double, w_group double")


@query("ensemble_metrics_row", OB(_BLEND) + """
SELECT (SELECT w FROM best) AS blend_weight_linear,
       round(sqrt(avg(power(y - pred_area, 2))), 6) AS cv_rmsle_linear,
       round(sqrt(avg(power(y - pred_group, 2))), 6) AS cv_rmsle_catboost,
       round((SELECT rmse FROM best), 6) AS cv_rmsle_blend,
       CAST(5 AS INTEGER) AS cv_folds, CAST(1 AS INTEGER) AS n_numeric_features,
       CAST(1 AS INTEGER) AS n_categorical_features FROM oof""")
def ensemble_metrics_row_q(spark, sf):
    """One metrics record of the two-model ensemble (linear = area model,
    the second slot = neighbourhood model)."""
    o = oof_frame(spark, sf)
    best_w, best = E.pick_blend(E.blend_scores(o, "y", "pred_area", "pred_group").collect())
    r = o.agg(E.rmse_col("y", "pred_area").alias("lin"), E.rmse_col("y", "pred_group").alias("grp"))
    return r.select(F.lit(best_w).alias("blend_weight_linear"), rnd("lin", 6).alias("cv_rmsle_linear"),
                    rnd("grp", 6).alias("cv_rmsle_catboost"), F.lit(round(best, 6)).alias("cv_rmsle_blend"),
                    F.lit(K).cast("int").alias("cv_folds"), F.lit(1).cast("int").alias("n_numeric_features"),
                    F.lit(1).cast("int").alias("n_categorical_features"))


# --- scoring the held-out split -------------------------------------------------

def fitted_ensemble(spark, sf):
    """(scored test frame with pred_log, blend weight, oof frame)."""
    o, cv, train = oof_frame(spark, sf, with_cv=True)
    best_w, _ = E.pick_blend(E.blend_scores(o, "y", "pred_area", "pred_group").collect())
    score = fr.model_frame(spark, sf, "test").withColumn("pred_area", cv.full_expr(OLS))
    score = E.group_mean_full(train, score, "neighborhood", "y")
    blend = F.lit(best_w) * F.col("pred_area") + F.lit(1 - best_w) * F.col("pred_group")
    return score.withColumn("pred_log", blend), best_w, o


_FULL = """fa AS (SELECT median(area) AS med FROM model),
fs AS (SELECT avg(ln(sale_price)) AS my, covar_pop(coalesce(area, fa.med), ln(sale_price)) / var_pop(coalesce(area, fa.med)) AS slope,
              avg(coalesce(area, fa.med)) AS mx FROM model, fa GROUP BY fa.med),
fg AS (SELECT neighborhood, avg(ln(sale_price)) AS gm FROM model GROUP BY 1),
scored AS (SELECT s.*, (SELECT w FROM best) * (fs.my + fs.slope * (coalesce(s.area, fa.med) - fs.mx))
                       + (1 - (SELECT w FROM best)) * coalesce(fg.gm, fs.my) AS pred_log
           FROM scoring s CROSS JOIN fs CROSS JOIN fa LEFT JOIN fg ON fg.neighborhood = s.neighborhood)"""


@query("ensemble_predict", OB(_BLEND, _FULL) + """
SELECT id, round(greatest(exp(pred_log), 1), 4) AS price FROM scored""")
def ensemble_predict_q(spark, sf):
    s, _, _ = fitted_ensemble(spark, sf)
    return s.select("id", rnd(F.greatest(F.exp("pred_log"), F.lit(1.0)), 4).alias("price"))


@query("submission_write", OB(_BLEND, _FULL) + """
SELECT id AS "Id", round(greatest(exp(pred_log), 1), 4) AS "SalePrice" FROM scored""")
def submission_write_q(spark, sf):
    """Predictions of the held-out split written as ``Id,SalePrice`` CSV and
    read back (the id travels with the row, no positional zip)."""
    from ..session import scratch_path
    from ..sources import files as S
    from pyspark.sql import types as T
    s, _, _ = fitted_ensemble(spark, sf)
    out = s.select(F.col("id").alias("Id"), rnd(F.greatest(F.exp("pred_log"), F.lit(1.0)), 4).alias("SalePrice"))
    path = S.write_csv(out, scratch_path(spark, "submission"))
    schema = T.StructType([T.StructField("Id", T.LongType()), T.StructField("SalePrice", T.DoubleType())])
    return S.read_csv_require(spark, path, schema, required=["Id", "SalePrice"])


@query("submission_key_check", OB(_BLEND, _FULL) + """
SELECT CAST((SELECT count(*) FROM listing WHERE split = 'test') AS BIGINT) AS n_expected,
       CAST((SELECT count(*) FROM scored) AS BIGINT) AS n_predicted,
       CAST((SELECT count(*) FROM listing l WHERE split = 'test' AND NOT EXISTS (SELECT 1 FROM scored s WHERE s.id = l.id)) AS BIGINT) AS n_missing,
       CAST((SELECT count(*) FROM scored s WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE l.split = 'test' AND l.id = s.id)) AS BIGINT) AS n_extra""")
def submission_key_check_q(spark, sf):
    """Key coverage of a written submission against a submission template, both read from CSV files (anti joins both ways)."""
    from ..session import scratch_path
    from ..sources import files as S
    from pyspark.sql import types as T
    s, _, _ = fitted_ensemble(spark, sf)
    ids = fr.listing_frame(spark, sf).filter("split = 'test'").select(F.col("id").alias("Id"), F.lit(0.0).alias("SalePrice"))
    template = S.write_csv(ids, scratch_path(spark, "template"))
    submission = S.write_csv(s.select(F.col("id").alias("Id"), F.greatest(F.exp("pred_log"), F.lit(1.0)).alias("SalePrice")),
                             scratch_path(spark, "submission"))
    return S.key_coverage(spark, template, submission, T.StructField("Id", T.LongType()))


@query("rmsle_raw", OB(_BLEND, _FULL) + """
SELECT round(sqrt(avg(power(ln(1 + greatest(exp(pred_log), 1)) - ln(1 + sale_price), 2))), 6) AS rmsle FROM scored""")
def rmsle_raw_q(spark, sf):
    """RMSLE on raw prices of the held-out split (prediction floored at 1)."""
    s, _, _ = fitted_ensemble(spark, sf)
    p = F.greatest(F.exp("pred_log"), F.lit(1.0))
    return s.agg(rnd(F.sqrt(F.avg(F.pow(F.log1p(p) - F.log1p("sale_price"), 2))), 6).alias("rmsle"))


# --- data products ---------------------------------------------------------------

def _ask(col="id"):
    return F.col("sale_price") * (F.lit(0.8) + (hash_int(col, "ask") % 41) / 100)


_ASK_SQL = f"sale_price * (0.8 + ({hash_int_sql('id', 'ask')} % 41) / 100)"


@query("price_verdict", OB(_BLEND, _FULL) + f"""
SELECT id, round(ask, 4) AS ask_price, round(p, 4) AS predicted,
       CASE WHEN ask < p * {1 - VERDICT_TOLERANCE} THEN 'under' WHEN ask > p * {1 + VERDICT_TOLERANCE} THEN 'over' ELSE 'fair' END AS verdict
FROM (SELECT id, {_ASK_SQL} AS ask, greatest(exp(pred_log), 1) AS p FROM scored)""")
def price_verdict_q(spark, sf):
    s, _, _ = fitted_ensemble(spark, sf)
    t = VERDICT_TOLERANCE
    x = s.select("id", _ask().alias("ask"), F.greatest(F.exp("pred_log"), F.lit(1.0)).alias("p"))
    v = F.when(F.col("ask") < F.col("p") * (1 - t), "under").when(F.col("ask") > F.col("p") * (1 + t), "over") \
        .otherwise("fair")
    return x.select("id", rnd("ask", 4).alias("ask_price"), rnd("p", 4).alias("predicted"), v.alias("verdict"))


@query("screen_listings", OB(_BLEND, _FULL) + f"""
SELECT neighborhood, id, round(ratio, 9) AS value_ratio, CAST(rank AS INTEGER) AS rank FROM (
  SELECT neighborhood, id, ratio, row_number() OVER (PARTITION BY neighborhood ORDER BY ratio DESC, id) AS rank
  FROM (SELECT neighborhood, id, greatest(exp(pred_log), 1) / ({_ASK_SQL}) AS ratio FROM scored))
WHERE rank <= 5""")
def screen_listings_q(spark, sf):
    """Five most undervalued listings (predicted / asking price) per neighbourhood."""
    s, _, _ = fitted_ensemble(spark, sf)
    x = s.select("neighborhood", "id", (F.greatest(F.exp("pred_log"), F.lit(1.0)) / _ask()).alias("ratio"))
    top = E.top_k_per_group(x, "neighborhood", [F.desc("ratio"), F.asc("id")], 5)
    return top.select("neighborhood", "id", rnd("ratio", 9).alias("value_ratio"), F.col("rank").cast("int"))


def _segment_col(price):
    e = PRICE_BANDS
    return (F.when(price < e[0], "low").when(price < e[1], "mid").when(price < e[2], "upper").otherwise("top"))


_SEG_SQL = (f"CASE WHEN sale_price < {PRICE_BANDS[0]} THEN 'low' WHEN sale_price < {PRICE_BANDS[1]} THEN 'mid' "
            f"WHEN sale_price < {PRICE_BANDS[2]} THEN 'upper' ELSE 'top' END")


@query("error_audit", OB(_BLEND) + f"""
SELECT neighborhood, segment, CAST(count(*) AS BIGINT) AS n,
       round(sqrt(avg(power(e, 2))), 6) AS rmse, round(avg(e), 6) AS bias,
       round(avg(abs(exp(p) - sale_price) / sale_price), 6) AS mape
FROM (SELECT neighborhood, {_SEG_SQL} AS segment, y - p AS e, p, sale_price
      FROM (SELECT *, (SELECT w FROM best) * pred_area + (1 - (SELECT w FROM best)) * pred_group AS p FROM oof))
GROUP BY ROLLUP (neighborhood, segment)""")
def error_audit_q(spark, sf):
    """Out-of-fold error of the blend by neighbourhood × price segment, with
    subtotals (rollup). Segments are fixed price bands — no global sort."""
    o = oof_frame(spark, sf)
    best_w, _ = E.pick_blend(E.blend_scores(o, "y", "pred_area", "pred_group").collect())
    p = F.lit(best_w) * F.col("pred_area") + F.lit(1 - best_w) * F.col("pred_group")
    x = o.select("neighborhood", _segment_col(F.col("sale_price")).alias("segment"),
                 (F.col("y") - p).alias("e"), p.alias("p"), "sale_price")
    return x.rollup("neighborhood", "segment").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), rnd(F.sqrt(F.avg(F.col("e") ** 2)), 6).alias("rmse"),
        rnd(F.avg("e"), 6).alias("bias"),
        rnd(F.avg(F.abs(F.exp("p") - F.col("sale_price")) / F.col("sale_price")), 6).alias("mape"))


@query("confidence_band", OB(_BLEND, _FULL) + f"""
, res AS (SELECT y - ((SELECT w FROM best) * pred_area + (1 - (SELECT w FROM best)) * pred_group) AS r FROM oof),
qs AS (SELECT quantile_cont(r, {BAND_Q[0]}) AS qlo, quantile_cont(r, {BAND_Q[1]}) AS qhi FROM res)
SELECT id, round(exp(pred_log), 4) AS price, round(exp(pred_log + qlo), 4) AS price_lo,
       round(exp(pred_log + qhi), 4) AS price_hi FROM scored, qs""")
def confidence_band_q(spark, sf):
    """Band from the exact 5 % / 95 % quantiles of out-of-fold log residuals."""
    from ..operators.quantiles import exact_quantiles
    s, best_w, o = fitted_ensemble(spark, sf)
    p = F.lit(best_w) * F.col("pred_area") + F.lit(1 - best_w) * F.col("pred_group")
    lo, hi = exact_quantiles(o, F.col("y") - p, BAND_Q)
    return s.select("id", rnd(F.exp("pred_log"), 4).alias("price"),
                    rnd(F.exp(F.col("pred_log") + F.lit(lo)), 4).alias("price_lo"),
                    rnd(F.exp(F.col("pred_log") + F.lit(hi)), 4).alias("price_hi"))


@query("drift_psi", B() + f"""
, b AS (SELECT yr_sold AS period, CAST(least(floor(area / {AREA_BIN}), {AREA_BINS - 1}) AS INTEGER) AS bin
        FROM listing WHERE area IS NOT NULL),
c AS (SELECT period, bin, count(*) AS n FROM b GROUP BY 1, 2),
periods AS (SELECT DISTINCT period FROM c), bins AS (SELECT * FROM range({AREA_BINS}) t(bin)),
full_ AS (SELECT p.period, bins.bin, coalesce(c.n, 0) AS n FROM periods p CROSS JOIN bins LEFT JOIN c ON c.period = p.period AND c.bin = bins.bin),
sh AS (SELECT period, bin, greatest(n / sum(n) OVER (PARTITION BY period), 1e-4) AS s FROM full_),
ref AS (SELECT bin, s AS s0 FROM sh WHERE period = (SELECT min(period) FROM sh))
SELECT period, round(sum((s - s0) * ln(s / s0)), 6) AS psi FROM sh JOIN ref USING (bin) GROUP BY period""")
def drift_psi_q(spark, sf):
    """Population stability of the area distribution per sale year against the
    first year: shares per fixed-width bin (floored at 1e-4), PSI = Σ (s−s0)·ln(s/s0)."""
    from ..operators.products import drift_psi
    return drift_psi(fr.listing_frame(spark, sf), "yr_sold", "area", AREA_BIN, AREA_BINS)
