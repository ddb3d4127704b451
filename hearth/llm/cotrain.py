"""Quality classifier by co-training (operator 10).

Two views of a document are learnt apart: its text (rates of characters, words and
lines, hashed word shares) and its metadata (source, language, length).  In every
round each view's classifier labels the pool documents that it is surest of, and these
pseudo-labels join the training rows of the *other* view.  At the end both views are
calibrated together on labelled rows that no round has seen, and every document gets
the calibrated score.

The fits (MLlib logistic regression) run on a bounded sample: at most ``LABELLED``
labelled and ``POOL`` unlabelled documents, those with the smallest hashes.  Features
and scores cover all documents, each from its whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import written

LABELLED = 20_000
POOL = 20_000
ROUNDS = 3
#: Pool rows that each view labels per round and class, as a share of the labelled rows of that class.
GROWTH = 0.1
#: Least probability of a pseudo-label.
SURE = 0.9
THRESHOLD = 0.5
SOURCES, LANGS, WORD_BUCKETS = 32, 8, 32

_SYMBOL = re.compile(r"[#*$%&|<>]")


def text_features(text: str | None) -> list[float]:
    """Rates of a text; all 0 without words."""
    t = text or ""
    w = t.split()
    if not w:
        return [0.0] * (12 + WORD_BUCKETS)
    n = len(w)
    lower = [x.lower().strip(".,;:!?") for x in w]
    distinct = len(set(lower))
    lines = [x for x in t.split("\n") if x.strip()]
    grams = list(zip(lower, lower[1:], lower[2:]))
    letters = sum(map(str.isalpha, t))
    share = np.zeros(WORD_BUCKETS)
    for x in lower:  # a stable hash: sum of the characters' codes
        share[sum(x.encode()[:4]) % WORD_BUCKETS] += 1
    base = [np.log1p(n), len(t) / n, sum(map(len, w)) / n / 10, sum(map(str.isupper, t)) / max(1, letters),
            sum(map(str.isdigit, t)) / len(t), len(_SYMBOL.findall(t)) / n, t.count("!") / n, t.count("|") / n,
            distinct / n, distinct / n ** 0.7, len(set(lines)) / max(1, len(lines)), len(set(grams)) / max(1, len(grams))]
    return [float(x) for x in base] + (share / n).tolist()


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, text_view, meta_view) of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                b = batch.slice(part, 500)
                rows = [text_features(t) for t in b.column(1).to_pylist()]
                yield pa.record_batch([*(b.column(i) for i in (0, 2)), pa.array(rows, pa.list_(pa.float64()))],
                                      names=["doc_id", "meta_view", "text_view"])

    def one_hot(c: Column, n: int) -> Column:
        at = F.pmod(F.xxhash64(F.coalesce(c.cast("string"), F.lit(""))), F.lit(n))
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i == at, 1.0).otherwise(0.0))

    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.log1p(F.length(t).cast("double"))
    meta = F.concat(F.array(size, size * size / 10, F.log1p(F.length(t) / F.size(F.split(t, "\n")))),
                    one_hot(F.col("source"), SOURCES), one_hot(F.col("lang"), LANGS))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       meta.alias("meta_view")).mapInArrow(run, "doc_id long, meta_view array<double>, text_view array<double>")


def _smallest(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    lr = LogisticRegression(featuresCol="v", labelCol="y", weightCol="weight", regParam=0.01, maxIter=30)
    return lr.fit(rows.select(array_to_vector(view).alias("v"), "y", "weight"))


def _logit(model: LogisticRegressionModel, view: str) -> Column:
    """The model's linear score as a column: the fitted numbers are literals."""
    w = F.array(*[F.lit(float(x)) for x in model.coefficients])
    dot = F.aggregate(F.zip_with(F.col(view), w, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return dot + F.lit(float(model.intercept))


def _balanced(rows: DataFrame) -> DataFrame:
    """Weights that give both classes half of the total."""
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    total = sum(n.values())
    w = F.when(F.col("y") == 1, total / (2 * n.get(1.0, 1))).otherwise(total / (2 * n.get(0.0, 1)))
    return rows.withColumn("weight", w)


def train(table: DataFrame, labels: DataFrame, rounds: int = ROUNDS, labelled: int = LABELLED, pool: int = POOL) -> Column | None:
    """The calibrated score as a column over a feature table; None without labels of both classes."""
    y = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    known = written(_smallest(table.join(y, "doc_id"), labelled), "cotrain-labelled")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 0
    base, calibration = known.filter(~held).drop("weight"), known.filter(held)
    for part in (base, calibration):
        if part.select("y").distinct().count() < 2:
            return None
    free = written(_smallest(table.join(y, "doc_id", "left_anti"), pool), "cotrain-pool")
    views = ("text_view", "meta_view")
    added = {v: None for v in views}
    per_class = {r["y"]: max(1, int(GROWTH * r["count"])) for r in base.groupBy("y").count().collect()}
    models = {}
    for k in range(rounds + 1):
        for v in views:
            rows = base.select("doc_id", *views, "y")
            if added[v] is not None:
                rows = rows.unionByName(added[v])
            models[v] = _fit(_balanced(rows), v)
        if k == rounds:
            break
        for v, other in (views, views[::-1]):
            p = 1 / (1 + F.exp(-_logit(models[v], v)))
            seen = free.withColumn("p", p)
            if added[other] is not None:
                seen = seen.join(added[other].select("doc_id"), "doc_id", "left_anti")
            sure = [seen.withColumn("q", F.col("p") if c else 1 - F.col("p")).filter(F.col("q") >= SURE)
                    .orderBy(F.desc("q"), "doc_id").limit(n).select("doc_id", *views, F.lit(c).alias("y"))
                    for c, n in per_class.items()]
            new = sure[0]
            for s in sure[1:]:
                new = new.unionByName(s)
            new = new if added[other] is None else added[other].unionByName(new)
            added[other] = written(new.dropDuplicates(["doc_id"]), "cotrain-pseudo")
    both = F.array(*[_logit(models[v], v) for v in views])
    stack = LogisticRegression(featuresCol="v", labelCol="y", regParam=0.001, maxIter=50).fit(
        calibration.select(array_to_vector(both).alias("v"), "y"))
    a = [float(x) for x in stack.coefficients]
    z = F.lit(float(stack.intercept))
    for c, v in zip(a, views):
        z = z + F.lit(c) * _logit(models[v], v)
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, kept) of every row of ``docs``: calibrated probability of quality 1.

    Null text counts as empty, null source and language as a value of their own;
    rows without doc_id are scored too.  Without labels of both classes the score is
    null and every row is kept.
    """
    table = written(features(docs), "cotrain-features")
    p = train(table, labels, rounds)
    p = F.lit(None).cast("double") if p is None else p
    return table.select("doc_id", p.alias("score")).withColumn("kept", F.coalesce(F.col("score") >= threshold, F.lit(True)))
