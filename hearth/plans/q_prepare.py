"""Scans, projections, fills, outliers and derived features (survey 2.1–2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from . import frames as fr
from .catalog import query
from .frames import with_base

B = with_base


@query("derive_features", B() + """
SELECT id, total_sf, total_bath, house_age, years_since_remodel, quality_area FROM model""")
def derive_features_q(spark, sf):
    return fr.model_frame(spark, sf).select(
        "id", "total_sf", "total_bath", "house_age", "years_since_remodel", "quality_area")


@query("remove_outliers", B() + f"""
SELECT split, count(*) AS n_rows FROM listing
WHERE NOT coalesce(area > {fr.OUTLIER_AREA} AND sale_price < {fr.OUTLIER_PRICE}, false)
GROUP BY split""")
def remove_outliers_q(spark, sf):
    df = C.remove_outliers(fr.listing_frame(spark, sf), area_gt=fr.OUTLIER_AREA,
                           price_lt=fr.OUTLIER_PRICE)
    return df.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@query("outlier_count", B() + f"""
SELECT CAST(count(*) FILTER (WHERE coalesce(area > {fr.OUTLIER_AREA} AND sale_price < {fr.OUTLIER_PRICE}, false)) AS BIGINT) AS n_outliers,
       CAST(count(*) AS BIGINT) AS n_rows
FROM cleaned WHERE split = 'train'""")
def outlier_count_q(spark, sf):
    df = C.clean(fr.listing_frame(spark, sf)).filter(F.col("split") == "train")
    return C.outlier_count(df, area_gt=fr.OUTLIER_AREA, price_lt=fr.OUTLIER_PRICE)


# --- scans -----------------------------------------------------------------

from ..session import scratch_path  # noqa: E402
from ..sources import files as S  # noqa: E402
from ..sources.listing import CATEGORICAL_COLUMNS, LISTING_COLUMNS, NUMERIC_COLUMNS  # noqa: E402


@query("scan_listings", B() + "SELECT * FROM listing")
def scan_listings_q(spark, sf):
    """Round trip through the CSV sink and the schema'd CSV scan."""
    lst = fr.listing_frame(spark, sf)
    base = scratch_path(spark, "listing-csv")
    S.write_csv(lst.filter("split = 'train'").drop("split"), base + "/train")
    test = lst.filter("split = 'test'")
    # the test file has its columns in another order
    S.write_csv(test.select(*reversed([c for c in test.columns if c != "split"])), base + "/test")
    schema = S.listing_schema()
    schema = type(schema)([f for f in schema.fields if f.name != "split"])
    return S.read_listings_csv(spark, base + "/train", base + "/test", schema).select(*LISTING_COLUMNS)


@query("scan_require_target", B() + "SELECT id, sale_price FROM listing WHERE split = 'train'")
def scan_require_target_q(spark, sf):
    lst = fr.listing_frame(spark, sf).filter("split = 'train'").select("id", "sale_price")
    path = S.write_csv(lst, scratch_path(spark, "train-csv"))
    schema = type(S.listing_schema())([f for f in S.listing_schema().fields
                                       if f.name in ("id", "sale_price")])
    return S.read_csv_require(spark, path, schema, required=["sale_price"])


_JSON_FIELDS = ["area", "lot_area", "overall_qual", "overall_cond", "year_built", "year_remod",
                "bsmt_area", "garage_cars", "full_bath", "neighborhood", "kitchen_qual",
                "exter_qual", "central_air"]


@query("json_listing_parse", B() + f"SELECT id, {', '.join(_JSON_FIELDS)} FROM listing")
def json_listing_parse_q(spark, sf):
    lst = fr.listing_frame(spark, sf)
    schema = type(S.listing_schema())([f for f in S.listing_schema().fields if f.name in _JSON_FIELDS])
    text = lst.select("id", F.to_json(F.struct(*_JSON_FIELDS)).alias("listing_json"))
    return S.parse_json_listing(text, "listing_json", schema).select("id", *_JSON_FIELDS)


# --- projections and fills ---------------------------------------------------

_MODEL_COLS = ["id"] + NUMERIC_COLUMNS + CATEGORICAL_COLUMNS + ["sale_price"] + fr.MODEL_NUMERIC[17:]


@query("drop_columns", B() + "SELECT * EXCLUDE (id, sale_price) FROM model")
def drop_columns_q(spark, sf):
    return C.drop_columns(fr.model_frame(spark, sf), "id", "sale_price", "no_such_column")


@query("select_features", B() + f"SELECT {', '.join(fr.MODEL_NUMERIC + fr.MODEL_CATEGORICAL)} FROM model")
def select_features_q(spark, sf):
    return C.select_features(fr.model_frame(spark, sf), fr.MODEL_NUMERIC, fr.MODEL_CATEGORICAL)


def _roles_sql(roles: dict[str, str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{r}' AS role, CAST(count(\"{c}\") AS BIGINT) AS n_non_null FROM model"
        for c, r in roles.items())
    return B() + parts


def _roles_frame(df, roles: dict[str, str]):
    wide = df.agg(*[F.count(c).cast("bigint").alias(c) for c in roles])
    long = wide.unpivot([], list(roles), "column", "n_non_null")
    role_map = F.create_map(*[x for c, r in roles.items() for x in (F.lit(c), F.lit(r))])
    return long.select("column", role_map[F.col("column")].alias("role"), "n_non_null")


_ROLES = {c: ("categorical" if c in CATEGORICAL_COLUMNS else "numeric")
          for c in _MODEL_COLS if c not in ("id", "sale_price")}


@query("column_roles", _roles_sql(_ROLES))
def column_roles_q(spark, sf):
    df = fr.model_frame(spark, sf)
    return _roles_frame(df, C.column_roles(df))


# integer-coded categories are declared categorical by name, as the reference
# does with its list of 43 names; everything else that is not text is numeric
LISTING_KNOWN_CATEGORICAL = list(CATEGORICAL_COLUMNS) + ["mo_sold"]
_ROLES_OVR = {c: ("categorical" if c in LISTING_KNOWN_CATEGORICAL else "numeric")
              for c in _MODEL_COLS if c not in ("id", "sale_price")}


@query("column_roles_override", _roles_sql(_ROLES_OVR))
def column_roles_override_q(spark, sf):
    df = fr.model_frame(spark, sf)
    return _roles_frame(df, C.column_roles_override(df, LISTING_KNOWN_CATEGORICAL))


@query("ensure_columns", B() + "SELECT id, CAST(0 AS INTEGER) AS bsmt_area, CAST(0 AS INTEGER) AS half_bath, full_bath FROM model")
def ensure_columns_q(spark, sf):
    df = fr.model_frame(spark, sf).drop("bsmt_area", "half_bath")
    return C.ensure_columns(df, ["bsmt_area", "half_bath", "full_bath"]).select(
        "id", "bsmt_area", "half_bath", "full_bath")


@query("fill_absent_categories", B() + "SELECT id, pool_qual FROM cleaned")
def fill_absent_categories_q(spark, sf):
    return C.fill_absent_categories(fr.listing_frame(spark, sf)).select("id", "pool_qual")


@query("fill_numeric_sentinel", B() + "SELECT id, garage_year FROM cleaned")
def fill_numeric_sentinel_q(spark, sf):
    return C.fill_numeric_sentinel(fr.listing_frame(spark, sf)).select("id", "garage_year")


@query("fill_missing_category", B() + """
SELECT id, coalesce(CAST(pool_qual AS VARCHAR), 'Missing') AS pool_qual,
       coalesce(CAST(bsmt_full_bath AS VARCHAR), 'Missing') AS bsmt_full_bath FROM listing""")
def fill_missing_category_q(spark, sf):
    return C.fill_missing_category(fr.listing_frame(spark, sf), ["pool_qual", "bsmt_full_bath"]) \
        .select("id", "pool_qual", "bsmt_full_bath")


@query("clean_train_test", B() + """
SELECT split, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE pool_qual = 'None') AS BIGINT) AS n_pool_none,
       CAST(count(*) FILTER (WHERE garage_year = 0) AS BIGINT) AS n_garage_zero
FROM cleaned GROUP BY split""")
def clean_train_test_q(spark, sf):
    df = C.clean_train_test(fr.listing_frame(spark, sf))
    return df.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(F.col("pool_qual") == "None").cast("bigint").alias("n_pool_none"),
        F.count_if(F.col("garage_year") == 0).cast("bigint").alias("n_garage_zero"))


# --- synthetic listings ----------------------------------------------------------

from ..sources import synthetic as SY  # noqa: E402
from ..sources.tables import read_table  # noqa: E402


@query("synthetic_listings", SY.make_synthetic_sql("SELECT o_orderkey FROM orders", "o_orderkey", 42))
def synthetic_listings_q(spark, sf):
    """The Ames-shaped generator over every order key."""
    return SY.make_synthetic(read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 42)
