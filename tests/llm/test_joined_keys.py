"""Keys that are joined to ordinary text."""

from pyspark.sql import functions as F

from hearth.llm import secrets
from tests.conftest import SF_SMALL

KEY, OTHER = "Zk3vQ9xL7pTbR2nW8yHd", "q7Jx9ZkLw2Rv8TnB4cYp1MdH6sGf"
WAY = "/the/other/then/here/reads/that/"


def test_keys_joined_to_ordinary_text_are_found(spark):
    texts = [WAY + KEY, f"see {WAY * 5}{KEY}{WAY * 5}end", f"x {WAY}{KEY}{WAY}{OTHER}{WAY}", f"url={WAY[1:-1].replace('/', '-')}-{KEY}", WAY * 4,
             "the_ordinary-identifier/of_words=andMoreOfThem" * 3]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    df = docs.union(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got = {-1 - r.doc_id: r.text for r in secrets.redact(df).filter(F.col("doc_id") < 0).collect()}
    assert [got[i] for i in range(len(texts))] == [t.replace(KEY, "[SECRET]").replace(OTHER, "[SECRET]") for t in texts]
