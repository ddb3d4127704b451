"""Profiles (survey 2.5 A1–A7, A11)."""

from __future__ import annotations

from ..operators import profile as P
from . import frames as fr
from .catalog import query
from .frames import with_base

B = with_base


def _numeric_model_columns():
    return ["id"] + fr.MODEL_NUMERIC + ["sale_price"]


def _q(c: str) -> str:
    return f'"{c}"'


_corr_cols = _numeric_model_columns()
_corr_sql = B() + f"""
SELECT "column", round(abs(r), 6) AS abs_corr FROM (
  UNPIVOT (SELECT {', '.join(f'corr(CAST({_q(c)} AS DOUBLE), sale_price) AS {_q(c)}' for c in _corr_cols)} FROM model)
  ON {', '.join(_q(c) for c in _corr_cols)} INTO NAME "column" VALUE r)
WHERE r IS NOT NULL
ORDER BY abs_corr DESC, "column" LIMIT 20"""


@query("target_correlation", _corr_sql)
def target_correlation_q(spark, sf):
    return P.target_correlation(fr.model_frame(spark, sf), "sale_price", 20)


def _all_model_columns():
    return ["id"] + fr.MODEL_NUMERIC[:17] + fr.MODEL_CATEGORICAL + ["sale_price"] + fr.MODEL_NUMERIC[17:]


_miss_cols = _all_model_columns()
_miss_sql = B() + f"""
SELECT "column", CAST(missing_count AS BIGINT) AS missing_count,
       round(missing_count * 100.0 / n, 6) AS missing_percent FROM (
  UNPIVOT (SELECT count(*) AS __n, {', '.join(f'count(*) FILTER (WHERE {_q(c)} IS NULL) AS {_q(c)}' for c in _miss_cols)} FROM model)
  ON {', '.join(_q(c) for c in _miss_cols)} INTO NAME "column" VALUE missing_count) u
  CROSS JOIN (SELECT count(*) AS n FROM model) t
WHERE missing_count > 0
ORDER BY missing_count DESC, "column" LIMIT 20"""


@query("missing_profile", _miss_sql)
def missing_profile_q(spark, sf):
    return P.missing_profile(fr.model_frame(spark, sf), 20)


@query("table_shape", B() + f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST({len(_miss_cols)} AS BIGINT) AS n_columns FROM model""")
def table_shape_q(spark, sf):
    return P.table_shape(fr.model_frame(spark, sf))


@query("target_skew", B() + """
SELECT round(skewness(sale_price), 6) AS skew_raw, round(skewness(ln(sale_price)), 6) AS skew_log FROM model""")
def target_skew_q(spark, sf):
    return P.target_skew(fr.model_frame(spark, sf))


def _corr_top_sql(k: int) -> str:
    cols = _corr_cols
    return f"""top AS (
  SELECT "column" FROM (
    UNPIVOT (SELECT {', '.join(f'corr(CAST({_q(c)} AS DOUBLE), sale_price) AS {_q(c)}' for c in cols)} FROM model)
    ON {', '.join(_q(c) for c in cols)} INTO NAME "column" VALUE r)
  WHERE r IS NOT NULL ORDER BY round(abs(r), 6) DESC, "column" LIMIT {k}),
longv AS (
  UNPIVOT (SELECT id AS rid, {', '.join(f'CAST({_q(c)} AS DOUBLE) AS {_q(c)}' for c in cols)} FROM model)
  ON {', '.join(_q(c) for c in cols)} INTO NAME "column" VALUE v)"""


@query("correlation_matrix", B(_corr_top_sql(11)) + """
SELECT a."column" AS col_a, b."column" AS col_b, round(corr(a.v, b.v), 6) AS corr
FROM longv a JOIN longv b ON a.rid = b.rid
WHERE a."column" IN (SELECT "column" FROM top) AND b."column" IN (SELECT "column" FROM top)
GROUP BY 1, 2""")
def correlation_matrix_q(spark, sf):
    return P.correlation_matrix(fr.model_frame(spark, sf), "sale_price", 11)


@query("target_histogram", B() + """
, vals AS (SELECT 'raw' AS kind, CAST(sale_price AS DOUBLE) AS x FROM model
           UNION ALL SELECT 'log', ln(sale_price) FROM model),
rng AS (SELECT kind, min(x) AS lo, max(x) AS hi FROM vals GROUP BY kind)
SELECT v.kind, CAST(CASE WHEN (hi - lo) / 30 > 0 THEN least(floor((x - lo) / ((hi - lo) / 30)), 29) ELSE 0 END AS INTEGER) AS bin,
       CAST(count(*) AS BIGINT) AS n,
       round(min(lo) + CAST(CASE WHEN (hi - lo) / 30 > 0 THEN least(floor((x - lo) / ((hi - lo) / 30)), 29) ELSE 0 END AS INTEGER) * min((hi - lo) / 30), 6) AS bin_lo
FROM vals v JOIN rng r ON v.kind = r.kind GROUP BY 1, 2""")
def target_histogram_q(spark, sf):
    return P.target_histogram(fr.model_frame(spark, sf), "sale_price", 30)


@query("scatter_bins", B() + """
SELECT CAST(floor(area / 250.0) AS BIGINT) AS x_bin, CAST(floor(sale_price / 25000.0) AS BIGINT) AS y_bin,
       CAST(count(*) AS BIGINT) AS n, round(avg(overall_qual), 6) AS mean_color
FROM model WHERE area IS NOT NULL AND sale_price IS NOT NULL GROUP BY 1, 2""")
def scatter_bins_q(spark, sf):
    return P.scatter_bins(fr.model_frame(spark, sf))


_dict_cols = fr.MODEL_CATEGORICAL


@query("category_dictionary", B() + f"""
SELECT "column", level, n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY level) - 1 AS INTEGER) AS code
FROM (SELECT "column", level, CAST(count(*) AS BIGINT) AS n FROM (
        UNPIVOT (SELECT {', '.join(_dict_cols)} FROM model) ON {', '.join(_dict_cols)} INTO NAME "column" VALUE level)
      WHERE level IS NOT NULL GROUP BY 1, 2)""")
def category_dictionary_q(spark, sf):
    return P.category_dictionary(fr.model_frame(spark, sf), _dict_cols)
