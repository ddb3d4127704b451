"""Quality rules with host verdicts (operator 5; DataFrame functions only).

Every document gets counts and rule verdicts of its own.  Rule failures are then
summed by host, the failure rates are shrunk with a beta prior fitted to the hosts
(empirical Bayes, by moments), and the host's verdict goes back to its documents:
on a bad host a document must also be free of mild failures, on a hopeless one
nothing is kept.

The features are written once (numbers only, no text).  Host sums are partial on
the map side; the join back is left to the planner, which broadcasts the host
table when its measured size allows and splits skewed hosts otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import SPACE_CLASS, WORD, let, words, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
WINDOW = 5
#: Shrunk share of failing documents from which a host counts as bad, and as hopeless.
BAD_HOST = 0.5
HOPELESS_HOST = 0.9

SYMBOLS = r"[#*$%&|<>]"


def _windows(w: Column, size: int) -> Column:
    """64-bit hashes of all windows of ``size`` words, in order."""
    return F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)),
                       lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(size)]))


def _twins(pairs: Column, key: str) -> Column:
    """Of an array sorted by ``key``, the entries whose key a neighbour shares."""
    return F.filter(pairs, lambda p, k: ((k > 0) & (F.get(pairs, k - 1)[key] == p[key]))
                    | (F.get(pairs, k + 1)[key] == p[key]).eqNullSafe(True))


def _repeated_words(w: Column, h: Column, size: int) -> Column:
    """Words covered by windows that occur twice or more (first included); ``h`` has a repeated hash.

    Windows whose hash repeats are compared as texts, so that no collision counts.
    """
    hashed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), (i + 1).cast("int").alias("i"))))

    def places(twins: Column) -> Column:
        texts = F.sort_array(F.transform(twins, lambda p: F.struct(
            F.concat_ws(" ", F.slice(w, p["i"], size)).alias("t"), p["i"].alias("i"))))  # words hold no space
        return let(texts, lambda s: F.array_sort(F.transform(_twins(s, "t"), lambda p: p["i"])))

    def covered(starts: Column) -> Column:  # each window adds its words from the end of the one before it on
        new = F.transform(starts, lambda i, k: F.when(
            k > 0, F.least(F.lit(size), i - F.get(starts, k - 1))).otherwise(F.lit(size)))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(hashed, lambda p: let(_twins(p, "h"), lambda t: let(places(t), covered)))


def features(docs: DataFrame, host: str = "source", carry: bool = False) -> DataFrame:
    """doc_id, host and the counts of every row of ``docs`` (null text: no words); with ``carry`` also the row itself."""
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = [F.struct(*docs.columns).alias("row")] if carry else []
    base = docs.select("doc_id", F.col(host).alias("host"), t.alias("t"), words(F.col("text")).alias("w"), *row)
    h = let(F.col("w"), lambda w: F.when(F.size(w) >= WINDOW, _windows(w, WINDOW)).otherwise(F.array().cast("array<bigint>")))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    f = base.withColumn("h", h).withColumn("l", lines)
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    return f.select(
        "doc_id", "host",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", f"[{SPACE_CLASS}]+", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS + "+", ""))).cast("long").alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, let(F.col("w"), lambda w: _repeated_words(w, F.col("h"), WINDOW)))
         .otherwise(F.lit(0)).cast("long").alias("n_repeat_words"), *(["row"] if carry else []))


def host_table(judged: DataFrame) -> DataFrame:
    """host, n, failed, rate: the failure rate shrunk towards the prior fitted to all hosts."""
    per = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    per = written(per, "rules-hosts")
    p = F.col("failed") / F.col("n")
    r = per.agg(F.avg(p).alias("m"), F.var_pop(p).alias("v"), F.avg(p * (1 - p) / F.col("n")).alias("s")).first()
    mean = r["m"] if r["m"] is not None else 0.5
    # variance between hosts = that of the rates less what sampling alone explains
    between = max((r["v"] or 0.0) - (r["s"] or 0.0), 1e-6)
    strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e4)
    a, n = F.lit(mean * strength), F.lit(strength)
    return per.withColumn("rate", (F.col("failed") + a) / (F.col("n") + n))


def judge(docs: DataFrame, host: str = "source", carry: bool = False) -> DataFrame:
    """Features and verdicts of every row: doc_id, counts, base_failed, mild, host_rate, kept.

    A null host is a host of its own.  Repeated rows are judged alike, once per row.
    An empty table gives no rows.
    """
    f = features(docs, host, carry)
    n = F.col("n_words")
    f = f.withColumn("base_failed", (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n))
    f = f.withColumn("mild", (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
                     | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")))
    judged = written(f, "rules-features")
    hosts = host_table(judged).select(F.col("host").alias("_h"), F.col("rate").alias("host_rate"))
    j = judged.join(hosts, F.col("host").eqNullSafe(F.col("_h")), "left").drop("_h")
    bad = (F.col("host_rate") >= HOPELESS_HOST) | ((F.col("host_rate") >= BAD_HOST) & F.col("mild"))
    return j.withColumn("kept", ~(F.col("base_failed") | bad))


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged."""
    return judge(docs, host, carry=True).filter("kept").select("row.*")
