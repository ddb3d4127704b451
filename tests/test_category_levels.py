"""Tree families on categories with many levels."""

from pyspark.sql import functions as F

from hearth.operators import trees as TR


def test_categorical_gbt_takes_a_category_of_any_size(spark):
    df = spark.range(600).select("id", (F.col("id") % 7).cast("double").alias("x"), F.concat(F.lit("c"), (F.col("id") % 100).cast("string")).alias("c"),
                                 (F.col("id") % 100 / 10).alias("y"))
    model = TR.gbt_categorical_pipeline(["x"], ["c"], max_iter=5, step=0.5, depth=3).fit(df)
    assert model.stages[-1].getMaxBins() >= 100
    rmse = model.transform(df).agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    assert rmse < 1.0  # the standard deviation of y is 2.9
