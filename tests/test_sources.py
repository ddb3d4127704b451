"""File sources and the codebook parser."""

import json
import os
import tempfile

import pytest
from pyspark.sql import types as T

from hearth.sources import codebook as CB
from hearth.sources import files as S


def test_missing_files_are_listed(spark):
    with pytest.raises(FileNotFoundError) as e:
        S.read_listings_csv(spark, "/nonexistent/train.csv", "/nonexistent/test.csv")
    assert "train.csv" in str(e.value) and "test.csv" in str(e.value)


def test_required_target(spark):
    d = tempfile.mkdtemp(prefix="hearth-test-")
    path = os.path.join(d, "t.csv")
    with open(path, "w") as f:
        f.write("id,area\n1,NA\n2,1500\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("area", T.IntegerType())])
    with pytest.raises(ValueError):
        S.read_csv_require(spark, path, schema, required=["sale_price"])
    rows = S.read_csv_require(spark, path, schema, required=["area"]).orderBy("id").collect()
    assert rows[0].area is None and rows[1].area == 1500  # NA → null


def test_json_listing_scan(spark):
    d = tempfile.mkdtemp(prefix="hearth-test-")
    with open(os.path.join(d, "one.json"), "w") as f:
        json.dump({"area": 1710, "neighborhood": "NAmes", "central_air": "Y"}, f, indent=2)
    schema = T.StructType([T.StructField("area", T.IntegerType()), T.StructField("neighborhood", T.StringType()),
                           T.StructField("central_air", T.StringType())])
    r = S.read_json_listings(spark, d, schema).first()
    assert (r.area, r.neighborhood, r.central_air) == (1710, "NAmes", "Y")


def test_codebook_parse(spark):
    cb = CB.parse_codebook(CB.codebook_text_frame(spark)).collect()
    got = {(r.field, r.code) for r in cb}
    assert ("kitchen_qual", "TA") in got and ("pool_qual", "NA") in got and ("pool_qual", "Po") not in got
    assert {f for f, _ in got} == {"kitchen_qual", "exter_qual", "pool_qual", "central_air", "sale_type", "segment"}


def test_codebook_from_a_file(spark):
    path = tempfile.mkdtemp(prefix="hearth-codebook-") + "/codes.txt"
    with open(path, "w") as f:
        f.write("roof: Kind of roof\n\n       Fl\tFlat\n       WD \tWood, with a blank in its code\n\nyard: Yard\n\n       NA\tNone\n")
    cb = {(r.field, r.code): r.label for r in CB.parse_codebook(CB.read_codebook_file(spark, path)).collect()}
    assert cb == {("roof", "Fl"): "Flat", ("roof", "WD"): "Wood, with a blank in its code", ("yard", "NA"): "None"}


def test_folder_of_csv_files_with_other_headers_fails(spark):
    d = tempfile.mkdtemp(prefix="hearth-csv-")
    for name, text in (("a.csv", "id,area\n1,1500\n"), ("b.csv", "area,id\n1600,2\n")):
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("area", T.IntegerType())])
    with pytest.raises(Exception, match="header"):
        S.read_csv_by_name(spark, d, schema).collect()


def test_absent_categories_are_filled_by_their_usual_names(spark):
    from hearth.operators.clean import fill_absent_categories
    r = fill_absent_categories(spark.createDataFrame([(None, None, None)], "PoolQC string, Fence string, other string")).first()
    assert (r.PoolQC, r.Fence, r.other) == ("None", "None", None)


def test_prediction_log_appends(spark):
    from hearth.operators.products import append_prediction_log
    path = tempfile.mkdtemp(prefix="hearth-log-") + "/log"
    rows = spark.createDataFrame([(1, "0.1.0", "abcd")], "id long, version string, input_hash string")
    append_prediction_log(rows, path, with_time=True)
    log = append_prediction_log(rows, path, with_time=True).collect()
    assert len(log) == 2 and all(r.generated_at and r.generated_at.endswith("Z") for r in log)


def test_a_run_is_logged_once_and_data_versions_ignore_order(spark):
    from pyspark.sql import functions as F

    from hearth.operators.products import append_run, table_fingerprint
    path = tempfile.mkdtemp(prefix="hearth-log-") + "/log"
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert append_run(rows.filter("id = 1"), path, "r1").count() == 1
    assert append_run(rows, path, "r1").count() == 2  # the rest of a run that stopped
    assert append_run(rows, path, "r1").count() == 2
    log = append_run(rows, path, "r2").collect()
    assert len(log) == 4 and all(r.generated_at.endswith("Z") for r in log)
    one = table_fingerprint(rows)
    assert one == table_fingerprint(rows.orderBy(F.desc("id")).repartition(3).select("v", "id"))
    assert one != table_fingerprint(rows.union(rows.limit(1))) != table_fingerprint(rows.withColumn("v", F.upper("v")))
