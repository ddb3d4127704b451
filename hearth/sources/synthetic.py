"""Ames-shaped listings drawn from seeded hashes of a key column (survey S3/S4).

The reference generates a small table with a price recipe that carries real
signal. Here the rows are those of an existing key column (e.g. the order
keys), so the table grows with the data and every draw is a pure function of
(key, seed): no driver-side random state, identical on every executor, and
reproducible in SQL. Noise is an integer Irwin–Hall sum of four uniforms with
standard deviation ≈ 12,000.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hash_int, hash_int_sql

# Fixed values of the reference's generator: neighbourhoods and their price
# effects, quality codes and scores, attribute ranges, recipe weights.
NEIGHBORHOODS = ["NAmes", "CollgCr", "OldTown", "Edwards", "Somerst", "Gilbert"]
NEIGHBORHOOD_EFFECT = {"NAmes": 0, "CollgCr": 18000, "OldTown": -8000, "Edwards": -5000,
                       "Somerst": 22000, "Gilbert": 12000}
QUALITIES = ["Ex", "Gd", "TA", "Fa", "Po"]
QUALITY_SCORE = {"Ex": 5, "Gd": 4, "TA": 3, "Fa": 2, "Po": 1}
RANGES = {  # column: (low, high exclusive)
    "GrLivArea": (700, 3500), "LotArea": (2000, 20000), "OverallQual": (3, 11), "OverallCond": (2, 10),
    "YearBuilt": (1920, 2011), "YearRemodAdd": (1950, 2011), "TotalBsmtSF": (0, 2000),
    "GarageCars": (0, 4), "FullBath": (0, 4), "BedroomAbvGr": (1, 6),
}
WEIGHTS = {"GrLivArea": 55, "LotArea": 1.5, "OverallQual": 12000, "OverallCond": 4500, "TotalBsmtSF": 25,
           "GarageCars": 8000, "FullBath": 6000}
BASE_PRICE, YEAR_BUILT_W, YEAR_REMOD_W = 45000, 250, 150
KITCHEN_W, EXTER_W, CENTRAL_AIR_W = 9000, 6000, 5000
CENTRAL_AIR_Y_PERCENT = 93
PRICE_FLOOR = 35000
NOISE_MOD = 20785  # four uniforms on [0, 20784]: std 2·20785/√12 ≈ 12,000

COLUMNS = ["Id", *RANGES, "Neighborhood", "KitchenQual", "ExterQual", "CentralAir", "SalePrice"]


def _choice(h: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (h % len(values) + 1).cast("int"))


def _lookup(c: Column, mapping: dict) -> Column:
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])[c]


def make_synthetic(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    h = lambda name: hash_int(F.col(key), f"{name}{seed}")
    cols = {"Id": F.col(key).cast("bigint")}
    for c, (lo, hi) in RANGES.items():
        cols[c] = (F.lit(lo) + h(c) % (hi - lo)).cast("int")
    cols["Neighborhood"] = _choice(h("Neighborhood"), NEIGHBORHOODS)
    cols["KitchenQual"] = _choice(h("KitchenQual"), QUALITIES)
    cols["ExterQual"] = _choice(h("ExterQual"), QUALITIES)
    cols["CentralAir"] = F.when(h("CentralAir") % 100 < CENTRAL_AIR_Y_PERCENT, "Y").otherwise("N")
    cols["noise"] = sum((h(f"noise{i}") % NOISE_MOD for i in range(4)), F.lit(0)) - 2 * (NOISE_MOD - 1)
    df = keys.select(*[v.alias(k) for k, v in cols.items()])
    price = F.lit(float(BASE_PRICE))
    for c, w in WEIGHTS.items():
        price = price + F.col(c) * w
    price = (price + (F.col("YearBuilt") - 1900) * YEAR_BUILT_W + (F.col("YearRemodAdd") - 1900) * YEAR_REMOD_W
             + _lookup(F.col("KitchenQual"), QUALITY_SCORE) * KITCHEN_W
             + _lookup(F.col("ExterQual"), QUALITY_SCORE) * EXTER_W
             + _lookup(F.col("Neighborhood"), NEIGHBORHOOD_EFFECT)
             + F.when(F.col("CentralAir") == "Y", CENTRAL_AIR_W).otherwise(0) + F.col("noise"))
    return df.withColumn("SalePrice", F.floor(F.greatest(price, F.lit(float(PRICE_FLOOR)))).cast("int")) \
        .select(*COLUMNS)


def make_synthetic_sql(keys_sql: str, key: str, seed: int = 42) -> str:
    def h(name):
        return hash_int_sql(key, f"{name}{seed}")

    def choice(name, values):
        arr = ", ".join(f"'{v}'" for v in values)
        return f"([{arr}])[({h(name)}) % {len(values)} + 1]"

    def lookup(col, mapping):
        return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in mapping.items()) + " END"

    rng = ", ".join(f"CAST({lo} + {h(c)} % {hi - lo} AS INTEGER) AS {c}" for c, (lo, hi) in RANGES.items())
    noise = " + ".join(f"{h(f'noise{i}')} % {NOISE_MOD}" for i in range(4)) + f" - {2 * (NOISE_MOD - 1)}"
    price = f"CAST({BASE_PRICE} AS DOUBLE) + " + " + ".join(f"{c} * {w}" for c, w in WEIGHTS.items())
    price += (f" + (YearBuilt - 1900) * {YEAR_BUILT_W} + (YearRemodAdd - 1900) * {YEAR_REMOD_W}"
              f" + ({lookup('KitchenQual', QUALITY_SCORE)}) * {KITCHEN_W} + ({lookup('ExterQual', QUALITY_SCORE)}) * {EXTER_W}"
              f" + ({lookup('Neighborhood', NEIGHBORHOOD_EFFECT)})"
              f" + CASE WHEN CentralAir = 'Y' THEN {CENTRAL_AIR_W} ELSE 0 END + noise")
    return f"""SELECT {', '.join(COLUMNS[:-1])}, CAST(floor(greatest({price}, {PRICE_FLOOR}.0)) AS INTEGER) AS SalePrice FROM (
  SELECT CAST({key} AS BIGINT) AS Id, {rng},
         {choice('Neighborhood', NEIGHBORHOODS)} AS Neighborhood, {choice('KitchenQual', QUALITIES)} AS KitchenQual,
         {choice('ExterQual', QUALITIES)} AS ExterQual,
         CASE WHEN {h('CentralAir')} % 100 < {CENTRAL_AIR_Y_PERCENT} THEN 'Y' ELSE 'N' END AS CentralAir,
         {noise} AS noise
  FROM ({keys_sql}))"""


def load(spark, source: str | None = None, keys: DataFrame | None = None, key: str = "o_orderkey"):
    """Source dispatch: a CSV path with a required target column, otherwise
    the generator over ``keys``."""
    if source is not None:
        from pyspark.sql import types as T

        from .files import read_csv_require
        schema = T.StructType([T.StructField(c, T.StringType() if c in ("Neighborhood", "KitchenQual", "ExterQual",
                                                                          "CentralAir") else T.LongType())
                               for c in COLUMNS])
        return read_csv_require(spark, source, schema, required=["SalePrice"])
    if keys is None:
        raise ValueError("either a source path or a key frame is needed")
    return make_synthetic(keys, key)
