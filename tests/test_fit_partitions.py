"""Partitions of the rows that a boosted fit goes over."""

from pyspark.sql import functions as F

from hearth.operators import trees as TR


def test_a_fit_reads_small_partitions_of_a_large_table(spark, monkeypatch):
    df = spark.range(400, numPartitions=1).select((F.col("id") % 7).cast("double").alias("y"), (F.col("id") % 5).cast("double").alias("x"),
                                                  F.concat(F.lit("l"), F.col("id") % 3).alias("c"))
    rows = TR.Pipeline(stages=TR.categorical_view_stages(["x"], ["c"])).fit(df).transform(df).select("y", "features")
    assert TR.spread(rows).rdd.getNumPartitions() == 1
    monkeypatch.setattr(TR, "PARTITION_CELLS", 100)
    some = TR.spread(rows)
    assert some.rdd.getNumPartitions() == 8 and max(len(p) for p in some.rdd.glom().collect()) < 100
    assert sorted(map(str, some.collect())) == sorted(map(str, rows.collect()))
