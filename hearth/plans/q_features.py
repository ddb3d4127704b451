"""Transformers and pre-processing pipelines (survey A8–A11, A18, T1–T14)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.scalar import rnd
from ..operators import transformers as T
from ..operators.folds import assign_folds, fold_sql
from . import frames as fr
from .catalog import query
from .frames import with_base
from .q_models import K, area_cv, one_feature_ctes

B = with_base
NUM = fr.MODEL_NUMERIC
CAT = fr.MODEL_CATEGORICAL
ENC_CATS = ["kitchen_qual", "neighborhood", "segment"]


def _q(c):
    return f'"{c}"'


def train_test(spark, sf):
    return fr.model_frame(spark, sf), fr.model_frame(spark, sf, "test")


# --- imputers and scaler -----------------------------------------------------------

_IMP = ["area", "bsmt_area", "bsmt_full_bath"]


@query("median_impute", B(*[f"m_{c} AS (SELECT median({c}) AS v FROM model)" for c in _IMP]) + f"""
SELECT s.id, {', '.join(f'round(coalesce(CAST(s.{c} AS DOUBLE), m_{c}.v), 6) AS {c}' for c in _IMP)}
FROM scoring s, {', '.join(f'm_{c}' for c in _IMP)}""")
def median_impute_q(spark, sf):
    """Median fitted on the training split, applied to the held-out split."""
    tr, te = train_test(spark, sf)
    m = T.MedianImputer(_IMP).fit(tr)
    return m.transform(te).select("id", *[rnd(c, 6).alias(c) for c in _IMP])


@query("mode_impute", B() + """
SELECT id, coalesce(pool_qual, (SELECT pool_qual FROM listing WHERE split = 'train' AND pool_qual IS NOT NULL
                                GROUP BY 1 ORDER BY count(*) DESC, pool_qual LIMIT 1)) AS pool_qual
FROM listing WHERE split = 'test'""")
def mode_impute_q(spark, sf):
    """Most frequent value (smallest on ties) of the raw, unfilled column."""
    lst = fr.listing_frame(spark, sf)
    m = T.ModeImputer(["pool_qual"]).fit(lst.filter("split = 'train'"))
    return m.transform(lst.filter("split = 'test'")).select("id", "pool_qual")


_SC = ["area", "lot_area", "year_built", "garage_cars"]


@query("standard_scale", B() + f"""
SELECT s.id, {', '.join(f'round((s.{c} - st.m_{c}) / CASE WHEN st.s_{c} > 0 THEN st.s_{c} ELSE 1 END, 9) AS {c}' for c in _SC)}
FROM scoring s, (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SC)} FROM model) st""")
def standard_scale_q(spark, sf):
    """(x − mean) / population std, fitted on train; nulls stay null."""
    tr, te = train_test(spark, sf)
    m = T.PopulationScaler(_SC).fit(tr)
    return m.transform(te).select("id", *[rnd(c, 9).alias(c) for c in _SC])


# --- encoders ----------------------------------------------------------------------

def _slot_sql(c: str) -> str:
    return (f"coalesce((SELECT CAST(count(DISTINCT t.{c}) AS INTEGER) FROM model t WHERE t.{c} < s.{c})"
            f" * CASE WHEN s.{c} IN (SELECT {c} FROM model) THEN 1 ELSE NULL END, -1)")


@query("one_hot", B() + f"""
SELECT s.id, {', '.join(f'{_slot_sql(c)} AS {c}_slot' for c in ENC_CATS)},
       CAST({' + '.join(f'CASE WHEN s.{c} IN (SELECT {c} FROM model) THEN 1 ELSE 0 END' for c in ENC_CATS)} AS DOUBLE) AS n_hot
FROM scoring s""")
def one_hot_q(spark, sf):
    """Slot of the hot bit per column (−1: unseen level → all-zero block)."""
    from pyspark.ml import Pipeline
    tr, te = train_test(spark, sf)
    model = Pipeline(stages=T.one_hot_stages(ENC_CATS)).fit(tr)
    out = model.transform(te)
    cols = {}
    for c in ENC_CATS:
        arr = vector_to_array(f"{c}_oh")
        cols[f"{c}_slot"] = (F.array_position(arr, 1.0) - 1).cast("int")
    total = sum((F.aggregate(vector_to_array(f"{c}_oh"), F.lit(0.0), lambda a, x: a + x) for c in ENC_CATS),
                F.lit(0.0))
    return out.select("id", *[v.alias(k) for k, v in cols.items()], total.alias("n_hot"))


@query("ordinal_encode", B() + f"""
SELECT s.id, {', '.join(f'CAST({_slot_sql(c)} AS DOUBLE) AS {c}_ord' for c in ENC_CATS)} FROM scoring s""")
def ordinal_encode_q(spark, sf):
    tr, te = train_test(spark, sf)
    m = T.OrdinalEncoder(ENC_CATS).fit(tr)
    return m.transform(te).select("id", *[f"{c}_ord" for c in ENC_CATS])


def _te_sql(c: str) -> str:
    return f"""te_{c} AS (
  SELECT l.lv, CASE WHEN l.n * g.gv + l.v > 0 THEN l.n * g.gv / (l.n * g.gv + l.v) ELSE 1 END * l.m
             + (1 - CASE WHEN l.n * g.gv + l.v > 0 THEN l.n * g.gv / (l.n * g.gv + l.v) ELSE 1 END) * g.gm AS enc, g.gm
  FROM (SELECT {c} AS lv, count(*) AS n, avg(ln(sale_price)) AS m, var_pop(ln(sale_price)) AS v FROM model GROUP BY 1) l,
       (SELECT avg(ln(sale_price)) AS gm, var_pop(ln(sale_price)) AS gv FROM model) g)"""


@query("target_encode", B(*[_te_sql(c) for c in ["neighborhood", "segment"]]) + """
SELECT s.id, round(coalesce(a.enc, (SELECT avg(ln(sale_price)) FROM model)), 9) AS neighborhood_te,
       round(coalesce(b.enc, (SELECT avg(ln(sale_price)) FROM model)), 9) AS segment_te
FROM scoring s LEFT JOIN te_neighborhood a ON a.lv = s.neighborhood LEFT JOIN te_segment b ON b.lv = s.segment""")
def target_encode_q(spark, sf):
    """Empirical-Bayes target encoding fitted on all training rows, applied to
    the held-out split (unseen levels get the training mean)."""
    tr, te = train_test(spark, sf)
    tr = tr.withColumn("y", F.log("sale_price"))
    m = T.TargetEncoder(["neighborhood", "segment"], "y").fit(tr)
    return m.transform(te).select("id", rnd("neighborhood_te", 9).alias("neighborhood_te"),
                                  rnd("segment_te", 9).alias("segment_te"))


_FOLD = fold_sql("id", K, fr.SEED)


@query("target_encode_oof", B(f"""mf AS (SELECT id, {_FOLD} AS fold, neighborhood, ln(sale_price) AS y FROM model)""",
                              f"ks AS (SELECT * FROM (VALUES {', '.join(f'({j})' for j in range(K))}) t(k))",
                              """lv AS (SELECT ks.k, m.neighborhood, count(*) AS n, avg(m.y) AS mm, var_pop(m.y) AS v
                                      FROM ks JOIN mf m ON m.fold <> ks.k GROUP BY 1, 2)""",
                              """gg AS (SELECT ks.k, avg(m.y) AS gm, var_pop(m.y) AS gv FROM ks JOIN mf m ON m.fold <> ks.k GROUP BY 1)""") + """
SELECT mf.id, round(CASE WHEN lv.n IS NULL THEN gg.gm ELSE
         CASE WHEN lv.n * gg.gv + lv.v > 0 THEN lv.n * gg.gv / (lv.n * gg.gv + lv.v) ELSE 1 END * lv.mm
       + (1 - CASE WHEN lv.n * gg.gv + lv.v > 0 THEN lv.n * gg.gv / (lv.n * gg.gv + lv.v) ELSE 1 END) * gg.gm END, 9) AS neighborhood_te
FROM mf JOIN gg ON gg.k = mf.fold LEFT JOIN lv ON lv.k = mf.fold AND lv.neighborhood = mf.neighborhood""")
def target_encode_oof_q(spark, sf):
    """Cross-fitted encoding of the training rows: each row is encoded with
    statistics of the other folds only."""
    df = assign_folds(fr.model_frame(spark, sf), K, fr.SEED).withColumn("y", F.log("sale_price"))
    stats = T.target_encoding_stats(df, ["neighborhood"], "y", "fold")
    s = stats.select(F.col("level").alias("neighborhood"), "fold", "enc")
    return df.join(s, ["neighborhood", "fold"], "left").select("id", rnd("enc", 9).alias("neighborhood_te"))


# --- pipelines ---------------------------------------------------------------------

def _num_stats_sql():
    parts = []
    for c in NUM:
        parts.append(f"(SELECT median({_q(c)}) FROM model) AS med_{c}")
    return "SELECT " + ", ".join(parts)


def _cat_modes_sql():
    return "SELECT " + ", ".join(
        f"(SELECT {c} FROM model WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS mode_{c}"
        for c in CAT)


def _pipeline_ctes():
    imp = ", ".join(f"coalesce(CAST(t.{_q(c)} AS DOUBLE), p.med_{c}) AS {_q(c)}" for c in NUM)
    imp_s = ", ".join(f"coalesce(CAST(s.{_q(c)} AS DOUBLE), p.med_{c}) AS {_q(c)}" for c in NUM)
    cats_s = ", ".join(f"coalesce(s.{c}, m.mode_{c}) AS {c}" for c in CAT)
    sc = ", ".join(f"avg({_q(c)}) AS mu_{c}, stddev_pop({_q(c)}) AS sd_{c}" for c in NUM)
    return [f"p AS ({_num_stats_sql()})", f"m AS ({_cat_modes_sql()})",
            f"ti AS (SELECT {imp} FROM model t, p)",
            f"sc AS (SELECT {sc} FROM ti)",
            f"si AS (SELECT s.id, {imp_s}, {cats_s} FROM scoring s, p, m)"]


def _hits_sql():
    return " + ".join(f"CASE WHEN si.{c} IN (SELECT {c} FROM model WHERE {c} IS NOT NULL) THEN 1 ELSE 0 END" for c in CAT)


def _scaled(c):
    return f"((si.{_q(c)} - sc.mu_{c}) / CASE WHEN sc.sd_{c} > 0 THEN sc.sd_{c} ELSE 1 END)"


@query("linear_features", B(*_pipeline_ctes()) + f"""
SELECT si.id, CAST({len(NUM)} + {len(CAT)} AS INTEGER) AS n_blocks,
       round({' + '.join(_scaled(c) for c in NUM)} + {_hits_sql()}, 6) AS feat_sum,
       round({' + '.join(f'power({_scaled(c)}, 2)' for c in NUM)} + {_hits_sql()}, 6) AS feat_sumsq
FROM si, sc""")
def linear_features_q(spark, sf):
    """median → population scaling ∥ mode → one-hot, fitted on train, applied
    to the held-out split; each row's vector is summarised by its sum and
    sum of squares."""
    tr, te = train_test(spark, sf)
    with fr.persisted(tr) as t:
        model = T.linear_pipeline(NUM, CAT).fit(t)
    arr = vector_to_array("features")
    return model.transform(te).select(
        "id", F.lit(len(NUM) + len(CAT)).cast("int").alias("n_blocks"),
        rnd(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 6).alias("feat_sum"),
        rnd(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x), 6).alias("feat_sumsq"))


@query("tree_features", B(*_pipeline_ctes()) + f"""
SELECT si.id, round({' + '.join(f'si.{_q(c)}' for c in NUM)} + {_hits_sql()}, 4) AS feat_sum FROM si""")
def tree_features_q(spark, sf):
    tr, te = train_test(spark, sf)
    with fr.persisted(tr) as t:
        model = T.tree_pipeline(NUM, CAT).fit(t)
    arr = vector_to_array("features")
    return model.transform(te).select("id", rnd(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 4).alias("feat_sum"))


def _ord_sql(c):
    return (f"CASE WHEN si.{c} IN (SELECT {c} FROM model) THEN "
            f"(SELECT count(DISTINCT t.{c}) FROM model t WHERE t.{c} < si.{c}) ELSE -1 END")


@query("ordinal_features", B(*_pipeline_ctes()) + f"""
SELECT si.id, round({' + '.join(f'si.{_q(c)}' for c in NUM)} + {' + '.join(_ord_sql(c) for c in CAT)}, 4) AS feat_sum FROM si""")
def ordinal_features_q(spark, sf):
    tr, te = train_test(spark, sf)
    with fr.persisted(tr) as t:
        model = T.ordinal_pipeline(NUM, CAT).fit(t)
    arr = vector_to_array("features")
    return model.transform(te).select("id", rnd(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 4).alias("feat_sum"))


@query("tree_frame", B() + """
SELECT s.id, coalesce(CAST(s.bsmt_area AS DOUBLE), (SELECT median(bsmt_area) FROM model)) AS bsmt_area,
       coalesce(CAST(s.bsmt_full_bath AS DOUBLE), (SELECT median(bsmt_full_bath) FROM model)) AS bsmt_full_bath,
       coalesce(CAST(l.pool_qual AS VARCHAR), 'Missing') AS pool_qual
FROM scoring s JOIN listing l ON l.id = s.id""")
def tree_frame_q(spark, sf):
    """Tree view: numerics coerced and filled with the *trained* median,
    categories as text with 'Missing' for null (raw, unfilled listing)."""
    from ..functions.scalar import coerce_numeric
    from ..operators.clean import fill_missing_category
    tr = fr.model_frame(spark, sf)
    raw = fr.listing_frame(spark, sf).filter("split = 'test'")
    med = T.MedianImputer(["bsmt_area", "bsmt_full_bath"]).fit(tr)
    x = raw.withColumns({c: coerce_numeric(c) for c in ["bsmt_area", "bsmt_full_bath"]})
    return fill_missing_category(med.transform(x), ["pool_qual"]).select("id", "bsmt_area", "bsmt_full_bath", "pool_qual")


@query("feature_names", B() + " UNION ALL ".join(
    [f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS name" for i, c in enumerate(NUM)]) + f"""
UNION ALL SELECT CAST({len(NUM)} + row_number() OVER (ORDER BY ord, level) - 1 AS INTEGER), col || '_oh_' || level FROM (
  {' UNION ALL '.join(f"SELECT DISTINCT {i} AS ord, '{c}' AS col, {c} AS level FROM model" for i, c in enumerate(CAT))})""")
def feature_names_q(spark, sf):
    """Slot names of the linear design, read from the vector's ML metadata."""
    tr = fr.model_frame(spark, sf)
    model = T.linear_pipeline(NUM, CAT).fit(tr)
    names = T.feature_names(model.transform(tr.limit(0)))
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


@query("fold_safe_scaling", B(*one_feature_ctes()) + """
SELECT k AS fold, round(med, 6) AS median, round(mx, 6) AS mean, round(sx, 6) AS std FROM st JOIN med USING (k)""")
def fold_safe_scaling_q(spark, sf):
    """Imputation and scaling statistics fitted inside each fold (training part only)."""
    cv = area_cv(spark, sf)
    rows = []
    for j in range(K):
        tf = cv.transform_for(j)
        rows.append((j, round(float(tf.medians["area"]), 6), round(float(tf.means["area"]), 6),
                     round(float(tf.scales["area"]), 6)))
    return spark.createDataFrame(rows, "fold int, median double, mean double, std double")
