"""Report tables, codebook check, step audit and result unions
(survey R1–R5, S6/J4, S12, U2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import __version__
from ..functions import scalar as X
from ..operators import profile as P
from ..sources import codebook as CB
from . import frames as fr
from .catalog import ORACLE_SQL, QUERIES, query
from .frames import with_base
from .q_functions import HASH_FIELDS, input_hash_col, input_hash_sql
from .q_oof import _BLEND, _FULL, OB, fitted_ensemble

B = with_base


@query("valuation_rows", OB(_BLEND, _FULL) + """
SELECT 'CASE-' || CAST(id AS VARCHAR) AS case_id, zone AS jurisdiction, neighborhood || ', ' || zone AS address,
       CAST(make_date(yr_sold, mo_sold, 1) AS VARCHAR) AS valuation_date,
       CASE WHEN starts_with(lower(zone), 'ind') THEN '₹' ELSE '€' END || ' ' || format('{:,.0f}', round(greatest(exp(pred_log), 1), 4)) AS money
FROM scored""")
def valuation_rows_q(spark, sf):
    s, _, _ = fitted_ensemble(spark, sf)
    price = X.rnd(F.greatest(F.exp("pred_log"), F.lit(1.0)), 4)
    return s.select(F.concat(F.lit("CASE-"), F.col("id").cast("string")).alias("case_id"),
                    F.col("zone").alias("jurisdiction"),
                    F.concat_ws(", ", "neighborhood", "zone").alias("address"),
                    F.make_date("yr_sold", "mo_sold", F.lit(1)).cast("string").alias("valuation_date"),
                    X.format_money(price, F.col("zone")).alias("money"))


@query("unpivot_inputs", B() + " UNION ALL ".join(
    f"SELECT id, '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM scoring" for c in HASH_FIELDS))
def unpivot_inputs_q(spark, sf):
    """Input appendix: each listing's fields as (field, value) text rows."""
    te = fr.model_frame(spark, sf, "test")
    return te.select("id", *[F.col(c).cast("string").alias(c) for c in HASH_FIELDS]) \
        .unpivot(["id"], HASH_FIELDS, "field", "value")


@query("audit_rows", OB(_BLEND) + f"""
SELECT s.id, '{__version__}' AS version, {input_hash_sql()} AS input_hash,
       printf('%.4f', (SELECT w FROM best)) AS blend_weight, CAST(2 AS INTEGER) AS n_features
FROM listing s WHERE s.split = 'test'""")
def audit_rows_q(spark, sf):
    """Prediction log keyed by the input hash: version, hash, blend weight and
    feature count (the generation time is left out of the checked table)."""
    from ..operators.ensemble import blend_scores, pick_blend
    from .q_oof import oof_frame
    o = oof_frame(spark, sf)
    w, _ = pick_blend(blend_scores(o, "y", "pred_area", "pred_group").collect())
    from ..operators.products import append_prediction_log
    from ..session import scratch_path
    te = fr.listing_frame(spark, sf).filter("split = 'test'")
    rows = te.select("id", F.lit(__version__).alias("version"), input_hash_col().alias("input_hash"),
                     X.fmt_fixed(F.lit(w), 4).alias("blend_weight"), F.lit(2).cast("int").alias("n_features"))
    return append_prediction_log(rows, scratch_path(spark, "prediction-log"))


# --- codebook --------------------------------------------------------------------

_CB_FIELDS = ["kitchen_qual", "exter_qual", "pool_qual", "central_air", "sale_type", "segment"]
_CB_TEXT = CB.LISTING_CODEBOOK.replace("'", "''")


@query("codebook_validate", B(f"""cbl AS (SELECT i AS line_no, line FROM (
        SELECT unnest(string_split('{_CB_TEXT}', chr(10))) AS line, generate_subscripts(string_split('{_CB_TEXT}', chr(10)), 1) AS i))""",
                              f"""cbt AS (SELECT line_no,
        CASE WHEN regexp_matches(line, '{CB.HEADER_RE}') THEN regexp_extract(line, '{CB.HEADER_RE}', 1) END AS hdr,
        CASE WHEN regexp_matches(line, '{CB.CODE_RE}') THEN trim(regexp_extract(line, '{CB.CODE_RE}', 1)) END AS code FROM cbl)""",
                              """cb AS (SELECT field, code FROM (SELECT code, last_value(hdr IGNORE NULLS) OVER (ORDER BY line_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS field FROM cbt) WHERE code IS NOT NULL)""") + f"""
SELECT field, code, CAST(count(*) AS BIGINT) AS n_rows FROM (
  UNPIVOT (SELECT {', '.join(_CB_FIELDS)} FROM listing) ON {', '.join(_CB_FIELDS)} INTO NAME field VALUE code) v
WHERE NOT EXISTS (SELECT 1 FROM cb WHERE cb.field = v.field AND cb.code = v.code)
GROUP BY field, code""")
def codebook_validate_q(spark, sf):
    """Listing codes that the codebook does not know (counts per field, code)."""
    cb = CB.parse_codebook(CB.codebook_text_frame(spark))
    return CB.validate_codes(fr.listing_frame(spark, sf), cb, _CB_FIELDS)


# --- step audit and result unions ------------------------------------------------------

def _count_sql(name: str) -> str:
    return f"SELECT CAST(count(*) AS BIGINT) FROM ({ORACLE_SQL[name]})"


@query("step_status", f"""
SELECT 'missing_profile' AS step, 'ok' AS status, ({_count_sql('missing_profile')}) AS n_rows
UNION ALL SELECT 'target_correlation', 'ok', ({_count_sql('target_correlation')})
UNION ALL SELECT 'scan_listings_csv', 'error: FileNotFoundError', CAST(0 AS BIGINT)""")
def step_status_q(spark, sf):
    """Each step runs under a guard; a failure is recorded and the run goes on."""
    from ..sources.files import read_listings_csv

    steps = {
        "missing_profile": lambda: P.missing_profile(fr.model_frame(spark, sf), 20).count(),
        "target_correlation": lambda: P.target_correlation(fr.model_frame(spark, sf)).count(),
        "scan_listings_csv": lambda: read_listings_csv(spark, f"{sf}/train.csv", f"{sf}/test.csv").count(),
    }
    rows = []
    for name, fn in steps.items():
        try:
            rows.append((name, "ok", int(fn())))
        except Exception as e:  # noqa: BLE001 - recorded, not raised
            rows.append((name, f"error: {type(e).__name__}", 0))
    return spark.createDataFrame(rows, "step string, status string, n_rows bigint")


_FITS = ["ols_fit", "ridge_fit", "lasso_fit", "elasticnet_fit"]


@query("union_results", " UNION ALL ".join(
    f"SELECT '{k}' AS model, fold, mse FROM ({ORACLE_SQL[k]})" for k in _FITS))
def union_results_q(spark, sf):
    """Result tables of several model runs concatenated by column name."""
    out = None
    for k in _FITS:
        part = QUERIES[k](spark, sf).select(F.lit(k).alias("model"), "fold", "mse")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


@query("report_tables", f"""
SELECT 'missing_values' AS report, "column" AS name, missing_percent AS value FROM ({ORACLE_SQL['missing_profile']})
UNION ALL SELECT 'correlations', "column", abs_corr FROM ({ORACLE_SQL['target_correlation']})""")
def report_tables_q(spark, sf):
    """The report's CSV files (gaps, correlations with the target), written and read back."""
    from ..session import scratch_path
    from ..sources.files import write_csv
    out = scratch_path(spark, "reports")
    parts = []
    for report, key, value in (("missing_values", "missing_profile", "missing_percent"), ("correlations", "target_correlation", "abs_corr")):
        path = write_csv(QUERIES[key](spark, sf).select(F.col("column").alias("name"), F.col(value).alias("value")).coalesce(1), f"{out}/{report}")
        back = spark.read.schema("name string, value double").option("header", True).option("enforceSchema", False).csv(path)
        parts.append(back.select(F.lit(report).alias("report"), "name", "value"))
    return parts[0].unionByName(parts[1])
