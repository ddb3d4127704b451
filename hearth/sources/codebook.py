"""Codebook: ``Field: description`` header lines followed by indented
``code<TAB>label`` lines. Parsed with Spark: split into numbered lines,
regex-extract headers and codes, forward-fill the field over the line order.
The codebook is a fixed, small asset, so its one ordered window is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Codes of the listing's coded fields (the pool field lists NA and no Po).
LISTING_CODES = {
    "kitchen_qual": "Ex Gd TA Fa Po",
    "exter_qual": "Ex Gd TA Fa Po",
    "pool_qual": "Ex Gd TA Fa NA",
    "central_air": "N Y",
    "sale_type": "F O",
    "segment": "AUTOMOBILE BUILDING FURNITURE HOUSEHOLD MACHINERY",
}


def codebook_text(codes: dict[str, str]) -> str:
    """Fields and their codes (without labels) in the codebook's layout."""
    return "\n".join(line for field, words in codes.items() for line in (f"{field}:", "", *[f"       {c}\t" for c in words.split()], ""))


LISTING_CODEBOOK = codebook_text(LISTING_CODES)

HEADER_RE = r"^(\S+):\s*(.*)$"
# a code may hold blanks or end in one
CODE_RE = r"^\s+([^\t]+)\t(.*)$"


def codebook_text_frame(spark: SparkSession, text: str = LISTING_CODEBOOK) -> DataFrame:
    return spark.createDataFrame([(text,)], "value string")


def read_codebook_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def parse_codebook(text_df: DataFrame) -> DataFrame:
    lines = text_df.select(F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    tagged = lines.select(
        "line_no",
        F.when(F.col("line").rlike(HEADER_RE), F.regexp_extract("line", HEADER_RE, 1)).alias("hdr"),
        F.when(F.col("line").rlike(CODE_RE), F.trim(F.regexp_extract("line", CODE_RE, 1))).alias("code"),
        F.when(F.col("line").rlike(CODE_RE), F.trim(F.regexp_extract("line", CODE_RE, 2))).alias("label"))
    w = Window.orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    filled = tagged.withColumn("field", F.last("hdr", ignorenulls=True).over(w))
    return filled.filter(F.col("code").isNotNull()).select("field", "code", "label")


def validate_codes(df: DataFrame, codebook: DataFrame, fields: list[str]) -> DataFrame:
    """(field, code, n_rows) for values absent from the codebook (anti join;
    the codebook side is broadcast — it is a fixed asset). Nulls are skipped."""
    long = df.select(*fields).unpivot([], fields, "field", "code").filter(F.col("code").isNotNull())
    bad = long.join(F.broadcast(codebook.select("field", "code")), ["field", "code"], "left_anti")
    return bad.groupBy("field", "code").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
