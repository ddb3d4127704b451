"""Derived features (survey P10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip_lower
from .clean import ensure_columns

DERIVED_COLUMNS = ["total_sf", "total_bath", "house_age", "years_since_remodel", "quality_area"]


def derive_features(df: DataFrame) -> DataFrame:
    """total_sf and total_bath treat null inputs as 0; the age differences are
    floored at 0 but stay null when an input is null; quality_area is a product.
    A derivation whose inputs are absent from the frame is skipped."""
    df = ensure_columns(df)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    cols = {
        "total_sf": (z("bsmt_area") + z("first_floor_area") + z("second_floor_area")).cast("double"),
        "total_bath": (z("full_bath") + z("half_bath") * 0.5 + z("bsmt_full_bath")
                       + z("bsmt_half_bath") * 0.5).cast("double"),
    }
    have = set(df.columns)
    if {"yr_sold", "year_built"} <= have:
        cols["house_age"] = clip_lower(F.col("yr_sold") - F.col("year_built"), 0).cast("bigint")
    if {"yr_sold", "year_remod"} <= have:
        cols["years_since_remodel"] = clip_lower(F.col("yr_sold") - F.col("year_remod"), 0).cast("bigint")
    if {"overall_qual", "area"} <= have:
        cols["quality_area"] = (F.col("overall_qual") * F.col("area")).cast("bigint")
    return df.withColumns(cols)
