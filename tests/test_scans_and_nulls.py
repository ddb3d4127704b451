"""Scans by name, null groups, codes with blanks, number texts, quantiles, checkpoint folder."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth import session
from hearth.functions.scalar import coerce_numeric
from hearth.operators.ensemble import group_mean_full, group_mean_oof, pick_blend, top_k_per_group
from hearth.operators.products import drift_psi
from hearth.operators.quantiles import exact_quantiles
from hearth.operators.transformers import PopulationScaler
from hearth.sources import codebook, files

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("area", T.IntegerType()),
                       T.StructField("sale_price", T.DoubleType())])


def csv(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    train = csv(tmp_path, "train.csv", "sale_price,extra,id,area\n100.5,x,1,NA\n")
    test = csv(tmp_path, "test.csv", "area,id\n1500,2\n")
    got = {r.id: r for r in files.read_listings_csv(spark, train, test, SCHEMA).collect()}
    assert (got[1].area, got[1].sale_price, got[1].split) == (None, 100.5, "train")
    assert (got[2].area, got[2].sale_price, got[2].split) == (1500, None, "test")


def test_csv_requires_columns_of_the_file(spark, tmp_path):
    path = csv(tmp_path, "no_target.csv", "id,area\n1,2\n")
    with pytest.raises(ValueError, match="sale_price"):
        files.read_csv_require(spark, path, SCHEMA)
    with pytest.raises(ValueError, match="sale_price"):
        files.read_listings_csv(spark, path, path, SCHEMA)


def test_csv_bad_value_fails(spark, tmp_path):
    path = csv(tmp_path, "bad.csv", "id,area,sale_price\n1,abc,2.0\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv_require(spark, path, SCHEMA).collect()


def test_null_group_has_an_out_of_fold_mean(spark):
    rows = [(None, 0, 1.0), (None, 1, 3.0), ("a", 0, 10.0), ("a", 1, 20.0)]
    df = spark.createDataFrame(rows, "g string, fold int, y double")
    got = {(r.g, r.fold): r.pred_group for r in group_mean_oof(df, "g", "y").collect()}
    assert got == {(None, 0): 3.0, (None, 1): 1.0, ("a", 0): 20.0, ("a", 1): 10.0}
    full = {r.g: r.pred_group for r in group_mean_full(df, df.select("g").distinct(), "g", "y").collect()}
    assert full == {None: 2.0, "a": 15.0}


def test_codes_with_blanks(spark):
    text = "SaleType: kind\n\n       WD \tWarranty\n       Wd Sdng\tWood\n       NA \tNone\n"
    got = [r.code for r in codebook.parse_codebook(codebook.codebook_text_frame(spark, text)).collect()]
    assert sorted(got) == ["NA", "WD", "Wd Sdng"]


def test_number_texts(spark):
    texts = ["1d", "2f", "3.5D", "1e3f", "1e3", " 7 ", "-.5", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(coerce_numeric("t").alias("n")).collect()] == [None, None, None, None, 1000.0, 7.0, -0.5, None, None]


def test_exact_quantiles(spark):
    import numpy as np
    x = np.random.default_rng(0).normal(size=5001)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(7)
    assert exact_quantiles(df, "v", [0.0, 0.05, 0.5, 0.951, 1.0]) == pytest.approx(list(np.quantile(x, [0.0, 0.05, 0.5, 0.951, 1.0])))
    assert exact_quantiles(df.filter("v is null"), "v", [0.5]) == [None]


def test_values_below_the_first_bin_count(spark):
    df = spark.createDataFrame([(2000, 5.0), (2000, 15.0), (2001, -5.0), (2001, 15.0)], "p int, v double")
    assert {r.period: r.psi for r in drift_psi(df, "p", "v", 10.0, 2).collect()} == {2000: 0.0, 2001: 0.0}


def test_all_null_column_is_left_out_of_scaling(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = PopulationScaler(["a", "b"]).fit(df).transform(df).collect()
    assert all(r.b is None for r in got)


def test_pick_blend_and_top_k(spark):
    assert pick_blend([{"w": 0.5, "rmse": 1.0}, {"w": 0.0, "rmse": 1.0}, {"w": 1.0, "rmse": float("nan")}]) == (0.0, 1.0)
    assert pick_blend([])[0] == 0.5
    df = spark.range(1000).select(F.lit("hot").alias("g"), "id")
    assert {r.id for r in top_k_per_group(df, "g", [F.desc("id")], 3).collect()} == {999, 998, 997}


def test_no_machine_local_folder_on_a_cluster():
    assert session.is_local("local") and session.is_local("local[8]")
    assert not session.is_local("local-cluster[3,2,1024]") and not session.is_local("spark://host:7077")

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
