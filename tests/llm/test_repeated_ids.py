"""Rows that repeat an id with different contents."""

from hearth.llm import minhash


def test_dedup_judges_each_text_of_a_repeated_id(spark):
    x, y = "one two three four five six seven", "quite another text of some other words"
    rows = [(3, x), (5, x), (5, y), (5, y), (6, y), (7, None), (7, x)]
    got = minhash.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == [(3, x), (5, y), (7, None)]
