"""Scalar functions and lookups (survey 2.3, J3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as X
from ..sources.listing import CATEGORICAL_COLUMNS, NUMERIC_COLUMNS, QUALITY_SCORE
from ..sources.tables import read_table
from . import frames as fr
from .catalog import query
from .frames import with_base

B = with_base


@query("log_target", B() + "SELECT id, round(ln(sale_price), 9) AS y_log FROM model")
def log_target_q(spark, sf):
    return fr.model_frame(spark, sf).select("id", X.rnd(X.log_target("sale_price"), 9).alias("y_log"))


@query("inverse_log_floor", B() + """
SELECT id, round(CASE WHEN exp(ln(sale_price) - 12.5) IS NOT NULL
                      THEN greatest(exp(ln(sale_price) - 12.5), 1.0) END, 9) AS price_floor FROM model""")
def inverse_log_floor_q(spark, sf):
    """exp of a shifted log price, floored at 1 (the shift makes the floor bite)."""
    df = fr.model_frame(spark, sf)
    return df.select("id", X.rnd(X.inverse_log(X.log_target("sale_price") - 12.5, 1.0), 9)
                     .alias("price_floor"))


@query("log1p_roundtrip", B() + """
SELECT id, round(ln(1 + sale_price), 9) AS y_log1p, round(exp(ln(1 + sale_price)) - 1, 4) AS price_back FROM model""")
def log1p_roundtrip_q(spark, sf):
    df = fr.model_frame(spark, sf).select("id", X.log1p_target("sale_price").alias("y"))
    return df.select("id", X.rnd("y", 9).alias("y_log1p"), X.rnd(X.expm1_target("y"), 4).alias("price_back"))


@query("coerce_numeric", """
SELECT event_id,
       TRY_CAST(trim(regexp_extract(props, ':\\s*([^}]*)', 1)) AS DOUBLE) AS k_value,
       TRY_CAST(trim(props) AS DOUBLE) AS props_value,
       TRY_CAST(trim(event_type) AS DOUBLE) AS type_value
FROM events""")
def coerce_numeric_q(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "props", "event_type")
    return ev.select("event_id",
                     X.coerce_numeric(F.regexp_extract("props", r":\s*([^}]*)", 1)).alias("k_value"),
                     X.coerce_numeric("props").alias("props_value"),
                     X.coerce_numeric("event_type").alias("type_value"))


_score_case = "CASE " + " ".join(f"WHEN kitchen_qual = '{k}' THEN {v}" for k, v in QUALITY_SCORE.items()) + " END"


@query("ordinal_map", B() + f"SELECT id, CAST({_score_case} AS INTEGER) AS kitchen_score FROM listing")
def ordinal_map_q(spark, sf):
    m = F.create_map(*[x for k, v in QUALITY_SCORE.items() for x in (F.lit(k), F.lit(v))])
    return fr.listing_frame(spark, sf).select("id", m[F.col("kitchen_qual")].cast("int").alias("kitchen_score"))


@query("lookup_join", B() + f"""
SELECT l.id, CAST(k.score AS INTEGER) AS kitchen_score, CAST(e.score AS INTEGER) AS exter_score
FROM listing l
LEFT JOIN (VALUES {', '.join(f"('{k}', {v})" for k, v in QUALITY_SCORE.items())}) k(code, score) ON l.kitchen_qual = k.code
LEFT JOIN (VALUES {', '.join(f"('{k}', {v})" for k, v in QUALITY_SCORE.items())}) e(code, score) ON l.exter_qual = e.code""")
def lookup_join_q(spark, sf):
    """Category → score through a broadcast left join to a 5-row dimension
    (its size is fixed by the code list, so the broadcast is bounded)."""
    dim = spark.createDataFrame([(k, v) for k, v in QUALITY_SCORE.items()], "code string, score int")
    lst = fr.listing_frame(spark, sf).select("id", "kitchen_qual", "exter_qual")
    k = F.broadcast(dim.withColumnsRenamed({"code": "k_code", "score": "kitchen_score"}))
    e = F.broadcast(dim.withColumnsRenamed({"code": "e_code", "score": "exter_score"}))
    return (lst.join(k, lst.kitchen_qual == k.k_code, "left")
            .join(e, lst.exter_qual == e.e_code, "left")
            .select("id", "kitchen_score", "exter_score"))


@query("safe_name", """
SELECT r_name AS zone, replace(lower(r_name), ' ', '_') AS safe FROM region
UNION ALL SELECT n_name, replace(lower(n_name), ' ', '_') FROM nation""")
def safe_name_q(spark, sf):
    r = read_table(spark, sf, "region").select(F.col("r_name").alias("zone"))
    n = read_table(spark, sf, "nation").select(F.col("n_name").alias("zone"))
    return r.unionByName(n).select("zone", X.safe_name("zone").alias("safe"))


@query("format_money", B() + """
SELECT id, CASE WHEN starts_with(lower(neighborhood), 'ind') THEN '₹' ELSE '€' END || ' ' ||
           format('{:,.0f}', sale_price) AS money FROM listing""")
def format_money_q(spark, sf):
    """Jurisdiction = the listing's nation: INDIA and INDONESIA get rupees
    (the prefix rule), the rest euros."""
    return fr.listing_frame(spark, sf).select(
        "id", X.format_money("sale_price", "neighborhood").alias("money"))


HASH_FIELDS = NUMERIC_COLUMNS + CATEGORICAL_COLUMNS
_TEXT = set(CATEGORICAL_COLUMNS)


def _json_value(c: str):
    if c in _TEXT:
        return X.json_text(c)
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def _json_value_sql(c: str) -> str:
    if c in _TEXT:
        return f"coalesce('\"' || {c} || '\"', 'null')"
    return f"coalesce(CAST({c} AS VARCHAR), 'null')"


def input_hash_col():
    return X.input_hash({c: _json_value(c) for c in HASH_FIELDS})


def input_hash_sql() -> str:
    body = " || ', ' || ".join(f"'\"{c}\": ' || {_json_value_sql(c)}" for c in sorted(HASH_FIELDS))
    return f"substr(sha256('{{' || {body} || '}}'), 1, 16)"


@query("input_hash", B() + f"SELECT id, {input_hash_sql()} AS input_hash FROM listing")
def input_hash_q(spark, sf):
    return fr.listing_frame(spark, sf).select("id", input_hash_col().alias("input_hash"))
