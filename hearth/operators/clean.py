"""Cleaning: projections, fills and the outlier filter (survey 2.2).

Null rules follow pandas where the reference relies on them: a comparison
with null is *false* in a pandas mask, so the outlier filter keeps such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Categorical columns whose null means "the feature is absent".
ABSENT_CATEGORY_COLUMNS = [
    "PoolQC", "MiscFeature", "Alley", "Fence", "MasVnrType", "FireplaceQu",
    "BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2",
    "GarageType", "GarageFinish", "GarageQual", "GarageCond",
]
# The listing frame's counterparts of the names above.
LISTING_ABSENT_COLUMNS = ["pool_qual"]
LISTING_SENTINEL_COLUMNS = ["garage_year"]

# Area and bath inputs of the derived features that default to 0 when absent.
DEFAULT_ZERO_COLUMNS = ["bsmt_area", "first_floor_area", "second_floor_area", "full_bath",
                        "half_bath", "bsmt_full_bath", "bsmt_half_bath"]


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop if present (absent names are ignored)."""
    return df.drop(*cols)


def select_features(df: DataFrame, num_cols: list[str], cat_cols: list[str]) -> DataFrame:
    return df.select(*num_cols, *cat_cols)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType, T.BooleanType)


def column_roles(df: DataFrame, exclude=("id", "sale_price")) -> dict[str, str]:
    """numeric vs categorical by type (pandas ``select_dtypes``)."""
    out = {}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, _NUMERIC):
            out[f.name] = "numeric"
        elif isinstance(f.dataType, T.StringType):
            out[f.name] = "categorical"
    return out


def column_roles_override(df: DataFrame, known_categorical, exclude=("id", "sale_price")) -> dict[str, str]:
    """categorical if named in the list or of string type; everything else numeric."""
    known = set(known_categorical)
    return {f.name: ("categorical" if f.name in known or isinstance(f.dataType, T.StringType)
                     else "numeric")
            for f in df.schema.fields if f.name not in exclude}


def ensure_columns(df: DataFrame, cols=DEFAULT_ZERO_COLUMNS, value=0) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    return df.withColumns({c: F.lit(value) for c in missing}) if missing else df


def fill_absent_categories(df: DataFrame, cols=(*LISTING_ABSENT_COLUMNS, *ABSENT_CATEGORY_COLUMNS), token: str = "None") -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.fillna(token, subset=present) if present else df


def fill_numeric_sentinel(df: DataFrame, cols=LISTING_SENTINEL_COLUMNS, value=0) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.fillna(value, subset=present) if present else df


def fill_missing_category(df: DataFrame, cols, token: str = "Missing") -> DataFrame:
    """Cast to text, null → ``token`` (tree view of the categoricals)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(token))
                           for c in cols if c in df.columns})


def outlier_condition(area_col="area", price_col="sale_price", area_gt=4000, price_lt=300000):
    return (F.col(area_col) > area_gt) & (F.col(price_col) < price_lt)


def remove_outliers(df: DataFrame, area_col="area", price_col="sale_price",
                    area_gt=4000, price_lt=300000) -> DataFrame:
    """Drop large-but-cheap sales. A null comparison counts as *not* an
    outlier, as in a pandas mask, so rows with gaps are kept."""
    if not {area_col, price_col}.issubset(df.columns):
        return df
    cond = outlier_condition(area_col, price_col, area_gt, price_lt)
    return df.filter(~F.coalesce(cond, F.lit(False)))


def outlier_count(df: DataFrame, area_col="area", price_col="sale_price",
                  area_gt=4000, price_lt=300000) -> DataFrame:
    cond = outlier_condition(area_col, price_col, area_gt, price_lt)
    return df.agg(F.count_if(F.coalesce(cond, F.lit(False))).cast("bigint").alias("n_outliers"),
                  F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def clean(df: DataFrame) -> DataFrame:
    return fill_numeric_sentinel(fill_absent_categories(df))


def clean_train_test(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Train and test get the same cleaning; both live in one frame tagged by
    ``split`` so the rule is declared once and runs in one scan."""
    return clean(df)
