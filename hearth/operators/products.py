"""Monitoring products (survey D4)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import rnd
from ..session import written


def drift_psi(df: DataFrame, period: str, value: str, width: float, bins: int,
              floor_share: float = 1e-4) -> DataFrame:
    """PSI of each period's binned distribution against the earliest period.
    Counts are one grouped aggregate; the (period × bin) grid is tiny."""
    b = df.filter(F.col(value).isNotNull()).select(
        F.col(period).alias("period"),
        # the outer bins are open: values below 0 count in the first
        F.greatest(F.least(F.floor(F.col(value) / width), F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin"))
    c = b.groupBy("period", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = c.select("period").distinct().select(
        "period", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(c, ["period", "bin"], "left").fillna(0, subset=["n"])
    sh = full.withColumn("s", F.greatest(F.col("n") / F.sum("n").over(Window.partitionBy("period")),
                                         F.lit(floor_share)))
    first = sh.agg(F.min("period")).first()[0]
    ref = sh.filter(F.col("period") == first).select("bin", F.col("s").alias("s0"))
    return sh.join(F.broadcast(ref), "bin").groupBy("period").agg(
        rnd(F.sum((F.col("s") - F.col("s0")) * F.log(F.col("s") / F.col("s0"))), 6).alias("psi"))


def table_fingerprint(df: DataFrame) -> str:
    """The version of a table's contents: number of rows, sum and xor of row hashes, whatever their order or files.

    Columns count by name, in order of their names; two equal rows count twice.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    text = F.xxhash64(F.lit("again"), row)  # a second hash, for the xor
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(text).alias("x")).first()
    return hashlib.sha256(f"{sorted(df.columns)}|{r['n']}|{r['s']}|{r['x']}".encode()).hexdigest()[:16]


def append_run(rows: DataFrame, path: str, run_id: str, key: str = "id") -> DataFrame:
    """Appends the rows of a run with their run id and UTC time to the log at ``path``; rows of ``run_id`` whose key the
    log already has are left out, so that a job that is run again adds nothing. Returns the log."""
    spark = rows.sparkSession
    new = rows.withColumn("run_id", F.lit(run_id)).withColumn(
        "generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p):
        have = spark.read.schema(new.schema).parquet(path).filter(F.col("run_id") == run_id).select(key)
        new = new.join(have, key, "left_anti").select(*new.columns)
    written(new, "log-rows").write.mode("append").parquet(path)
    return spark.read.schema(new.schema).parquet(path)


def append_prediction_log(rows: DataFrame, path: str, with_time: bool = False) -> DataFrame:
    """Append audit rows (model version, input hash, blend weight, feature
    count[, UTC generation time]) to the prediction-log table at ``path``."""
    out = rows.withColumn("generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")) \
        if with_time else rows
    out.write.mode("append").parquet(path)
    return rows.sparkSession.read.parquet(path)
