"""Secret scans (operator 3; DataFrame functions only).

Rules find assigned values, access keys and long hexadecimal runs.  Other strings
of key characters are scored by two character Markov models, one of random strings
and one of ordinary identifiers: a string whose log-likelihood ratio is high enough
is reported as well, and if the whole is not random enough, the high-scoring segments in
it: keys joined to ordinary text.  The models are trained here from labelled samples: random
strings spelled from SHA-256 digests, and words of the corpus joined the way
identifiers are.  They are two tables of bigram counts over a fixed alphabet, the
only thing that reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import RUN, WORD, let, prefix_maxima, prefix_sums

#: Fixed rules: kind, pattern, group that is measured, its least length.  Either case means ASCII letters.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
RULES = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))

#: Strings that the Markov models judge, and their alphabet.
MIN_LENGTH = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Training sample: documents (those of the smallest hashes) and random strings of each spelling.
SAMPLE_DOCS = 400
SAMPLE_RANDOM = 4000
#: Least log-likelihood ratio of a whole string, and per bigram (nats).
MIN_RATIO = 15.0
MIN_MEAN_RATIO = 0.6

SPAN = "array<struct<s:bigint,k:int,e:bigint,kind:string>>"


def matches(text: Column, pattern: str, kind: str, order: int, group: int = 0, least: int = 1) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` has ``least`` characters or more.

    The pieces between matches and the matches themselves give the places: both are
    summed up (code points).
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(m: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(m)), lambda x: F.length(x))
        ends = prefix_sums(F.zip_with(gaps, m, lambda gap, x: gap + F.length(x)))
        size = (lambda x: F.length(F.regexp_extract(x, pattern, group))) if group else F.length
        all_ = F.zip_with(m, ends, lambda x, e: F.when(size(x) >= least, F.struct(
            (e - F.length(x)).cast("bigint").alias("s"), F.lit(order).alias("k"), e.cast("bigint").alias("e"), F.lit(kind).alias("kind"))))
        return F.array_compact(all_)

    return let(found, lambda m: F.when(F.size(m) > 0, spans(m)).otherwise(F.array().cast(SPAN)))


def base_spans(text: Column) -> Column:
    """All spans of the rules, by start, then rule."""
    none = F.array().cast(SPAN)
    per = [F.when(text.rlike(quick), matches(text, p, kind, i, group, least)).otherwise(none)
           for i, ((kind, p, group, least), quick) in enumerate(zip(RULES, (ASSIGN, "AKIA[A-Z0-9]{16}", "[0-9a-f]{24}")))]
    return F.sort_array(F.concat(*per))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["s"].cast("string"), s["e"].cast("string"))), ",")


def training_sample(docs: DataFrame, n_docs: int = SAMPLE_DOCS, n_random: int = SAMPLE_RANDOM) -> DataFrame:
    """(label, string): 1 random, 0 ordinary; bounded by the two parameters."""
    spark = docs.sparkSession
    d = F.sha2(F.concat(F.lit("markov"), F.col("id").cast("string")), 256)
    raw = F.unhex(d)
    rand = spark.range(n_random).select(F.explode(F.array(
        d, F.substring(d, 1, 40), F.regexp_replace(F.base64(raw), "=", ""),
        F.translate(F.regexp_replace(F.base64(raw), "=", ""), "+/", "-_"),
        F.upper(F.regexp_replace(F.base64(raw), "[^A-Za-z0-9]", "")))).alias("string")).select(F.lit(1).alias("label"), "string")
    text = docs.select(F.col("text").cast("string").alias("text")).filter("text is not null")
    hashed = text.withColumn("h", F.xxhash64("text"))
    # n_docs numbers go to the driver; copies of a text have one number
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(n_docs).collect()]
    few = hashed.filter(F.col("h").isin(least)).dropDuplicates(["h"]).select("text")
    w = few.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"))
    w = w.filter(F.col("w").rlike("^[A-Za-z][A-Za-z.,-]*$")).select(F.regexp_replace("w", "[.,]", "").alias("w"))
    lo = F.lower("w")
    cap = F.concat(F.upper(F.substring("w", 1, 1)), F.expr("substring(lower(w), 2)"))
    ordinary = w.select(F.explode(F.array(
        lo, F.upper("w"), cap, F.concat(lo, lo), F.concat(lo, F.lit("_"), lo), F.concat(lo, cap), F.concat(lo, F.lit("-"), lo),
        F.concat(F.upper("w"), F.lit("_"), F.upper("w")), F.concat(lo, F.lit("/"), lo),
        F.concat(lo, F.lit("_"), (F.length("w") % 10).cast("string")))).alias("string")).select(F.lit(0).alias("label"), "string")
    return rand.union(ordinary)


def train(sample: DataFrame) -> list[float]:
    """Log-likelihood ratios log P(b|a, random) - log P(b|a, ordinary), row by row of the alphabet.

    Add-one smoothing; a sample without strings gives ratios of 0.
    """
    grams = sample.select("label", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("string") - 1, F.lit(1))),
        lambda i: F.substring(F.col("string"), i, F.lit(2)))).alias("g")).filter(F.length("g") == 2)
    n = len(ALPHABET)
    count = {0: [[1.0] * n for _ in range(n)], 1: [[1.0] * n for _ in range(n)]}
    place = {c: i for i, c in enumerate(ALPHABET)}
    for r in grams.groupBy("label", "g").count().collect():  # at most 2 * 67 * 67 known bigrams
        a, b = place.get(r["g"][0]), place.get(r["g"][1])
        if a is not None and b is not None:
            count[r["label"]][a][b] += r["count"]
    out = []
    for a in range(n):
        s0, s1 = sum(count[0][a]), sum(count[1][a])
        out += [math.log(count[1][a][b] / s1) - math.log(count[0][a][b] / s0) for b in range(n)]
    return [round(x, 6) for x in out]


def score(string: Column, ratios: Column) -> Column:
    """Sum of the log-likelihood ratios of the bigrams of ``string`` (over ``ALPHABET``)."""
    n = len(ALPHABET)
    codes = F.transform(F.sequence(F.lit(1), F.length(string)),
                        lambda i: F.position(F.substring(string, i, F.lit(1)), F.lit(ALPHABET)))
    start = F.struct(F.lit(0).alias("p"), F.lit(0.0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        r = F.when(acc["p"] > 0, F.element_at(ratios, (acc["p"] - 1) * n + c)).otherwise(F.lit(0.0))
        return F.struct(c.alias("p"), (acc["sum"] + r).alias("sum"))

    return F.aggregate(codes, start, step)["sum"]


def segments(string: Column, ratios: Column) -> Column:
    """Segments (s, e, sum) of ``string`` whose bigrams' ratios sum to ``MIN_RATIO``: from where the sum
    rises above 0 to its peak, ended where it falls to 0 or by ``MIN_RATIO`` from the peak."""
    n = len(ALPHABET)
    codes = F.transform(F.sequence(F.lit(1), F.length(string)),
                        lambda i: F.position(F.substring(string, i, F.lit(1)), F.lit(ALPHABET)))
    none = F.array().cast("array<struct<s:int,e:int,sum:double>>")
    no_runs = F.array().cast("array<array<struct<s:int,e:int,sum:double>>>")
    start = F.struct(F.lit(0).alias("p"), F.lit(0).alias("i"), F.lit(0.0).alias("sum"), F.lit(0).alias("at"),
                     F.lit(0.0).alias("best"), F.lit(0).alias("s"), F.lit(0).alias("e"), none.alias("out"), no_runs.alias("runs"))

    def found(a: Column) -> Column:  # the run that is being filled
        seg = F.array(F.struct(a["s"].alias("s"), a["e"].alias("e"), a["best"].alias("sum")))
        return F.when(a["best"] >= MIN_RATIO, F.when(F.size(a["out"]) < RUN, F.concat(a["out"], seg)).otherwise(seg)).otherwise(a["out"])

    def full(a: Column) -> Column:  # the runs that are
        return F.when((a["best"] >= MIN_RATIO) & (F.size(a["out"]) >= RUN), F.concat(a["runs"], F.array(a["out"]))).otherwise(a["runs"])

    def step(acc: Column, c: Column) -> Column:
        r = F.when(acc["p"] > 0, F.element_at(ratios, (acc["p"] - 1) * n + c)).otherwise(F.lit(0.0))
        on = acc["sum"] > 0
        grown = F.struct((F.when(on, acc["sum"]).otherwise(F.lit(0.0)) + r).alias("sum"),
                         F.when(on, acc["at"]).otherwise(F.greatest(acc["i"] - 1, F.lit(0))).alias("at"))

        def peak(g: Column) -> Column:
            top = g["sum"] > acc["best"]
            ends = (g["sum"] <= 0) | (g["sum"] <= acc["best"] - MIN_RATIO)
            zero = F.lit(0.0)
            return F.struct(
                c.alias("p"), (acc["i"] + 1).alias("i"), F.when(ends, zero).otherwise(g["sum"]).alias("sum"), g["at"].alias("at"),
                F.when(ends, zero).when(top, g["sum"]).otherwise(acc["best"]).alias("best"),
                F.when(top, g["at"]).otherwise(acc["s"]).alias("s"), F.when(top, acc["i"] + 1).otherwise(acc["e"]).alias("e"),
                F.when(ends, found(acc)).otherwise(acc["out"]).alias("out"), F.when(ends, full(acc)).otherwise(acc["runs"]).alias("runs"))
        return let(grown, peak)

    return F.aggregate(codes, start, step, lambda a: F.flatten(F.concat(full(a), F.array(found(a)))))


def pieces(string: Column, ratios: Column) -> Column:
    """Places (s, e) of random-looking pieces of ``string``: segments, with edges at separators."""
    dense = F.filter(segments(string, ratios), lambda g: g["sum"] >= MIN_MEAN_RATIO * (g["e"] - g["s"] - 1))

    def edges(g: Column) -> Column:
        """A piece that the segment cuts is taken whole, or left out if the segment has three characters of it at most."""
        inside = F.substring(string, g["s"] + 1, g["e"] - g["s"])
        back = F.length(F.regexp_extract(F.substring(string, F.lit(1), g["s"]), "[^/_=-]*$", 0))
        ahead = F.length(F.regexp_extract(F.substring(string, g["e"] + 1, F.length(string)), "^[^/_=-]*", 0))
        head = F.length(F.regexp_extract(inside, "^[^/_=-]{0,3}[/_=-]", 0))
        tail = F.length(F.regexp_extract(inside, "[/_=-][^/_=-]{0,3}$", 0))
        return F.struct((g["s"] + F.when((back > 0) & (head > 0), head).otherwise(-back)).alias("s"),
                        (g["e"] - F.when((ahead > 0) & (tail > 0), tail).otherwise(-ahead)).alias("e"))

    wide = F.transform(dense, edges)
    return F.array_distinct(F.filter(wide, lambda g: g["e"] - g["s"] >= MIN_LENGTH))


def _apart(found: Column, base: Column) -> Column:
    """The spans of ``found`` that overlap none of ``base``: in order of the starts, no base span before one reaches
    into it, and the next base span does not begin inside it."""
    low = -(1 << 62)

    def tagged(spans: Column, own: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(s["s"].alias("s"), F.lit(own).alias("own"), s.alias("x")))

    def clear(merged: Column) -> Column:
        reach = prefix_maxima(F.transform(merged, lambda m: F.when(m["own"], F.lit(low)).otherwise(m["x"]["e"])))
        following = F.reverse(prefix_maxima(F.reverse(F.transform(
            merged, lambda m: F.when(m["own"], F.lit(low)).otherwise(-m["x"]["s"])))))
        seen = F.zip_with(merged, F.arrays_zip(reach.alias("reach"), following.alias("following")), lambda m, p: F.when(
            m["own"] & (p["reach"] <= m["x"]["s"]) & (-p["following"] >= m["x"]["e"]), m["x"]))
        return F.array_compact(seen)

    return let(F.sort_array(F.concat(tagged(found, True), tagged(base, False))), clear)


def markov_spans(text: Column, base: Column, ratios: Column) -> Column:
    """Spans of random-looking strings that no rule has found."""
    whole = F.array(F.struct(F.lit(0).alias("s"), F.lit(None).cast("int").alias("e")))

    def random(m: Column) -> Column:
        return let(score(m, ratios), lambda x: F.when(
            (x >= MIN_RATIO) & (x >= MIN_MEAN_RATIO * (F.length(m) - 1)), whole).otherwise(pieces(m, ratios)))

    none = F.array().cast(SPAN)
    flags = F.transform(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), random)

    def spans(good: Column) -> Column:
        return F.flatten(F.zip_with(
            matches(text, CANDIDATE, "markov", len(RULES)), good, lambda s, g: F.transform(g, lambda p: F.struct(
                (s["s"] + p["s"]).alias("s"), s["k"].alias("k"), F.coalesce(s["s"] + p["e"], s["e"]).alias("e"), s["kind"].alias("kind")))))

    def new(found: Column) -> Column:
        return F.when(F.size(base) == 0, found).otherwise(_apart(found, base))

    return F.when(text.rlike(CANDIDATE), let(flags, lambda g: F.when(
        F.exists(g, lambda x: F.size(x) > 0), let(spans(g), new)).otherwise(none))).otherwise(none)


def scan(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(row, base, spans) of every row of ``docs``: the row as one struct, and arrays of (s, k, e, kind), by start, then kind.

    Places are code points, ends exclusive.  Null text is empty; every row is kept, and
    columns of any name may stand in it.
    """
    ratios = F.array(*[F.lit(x) for x in train(training_sample(docs, sample_docs))])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    t = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    found = rows.withColumn("base", base_spans(t))
    return found.withColumn("spans", F.sort_array(F.concat("base", markov_spans(t, F.col("base"), ratios))))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, numbers of rule matches, digest of the rule matches and all spans as text."""
    f = scan(docs.select("doc_id", "text"))

    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return f.select("row.doc_id", n("assign"), n("access"), n("hex"),
                    F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


#: Texts are cut from pieces of this many characters: a place far on in a long text is not searched from its start.
PIECE = 4096


def _cut(parts: Column, a: Column, b: Column) -> Column:
    """Characters ``a`` to ``b`` (exclusive) of a text in pieces of ``PIECE``."""
    def between(first: Column, last: Column) -> Column:
        inner = F.array_join(F.slice(parts, first + 2, last - first - 1), "")
        return F.concat(F.substring(F.get(parts, first), (a % PIECE + 1).cast("int"), F.lit(PIECE)), inner,
                        F.coalesce(F.substring(F.get(parts, last), F.lit(1), (b % PIECE).cast("int")), F.lit("")))

    first, last = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
    return F.when(a >= b, F.lit("")).when(first == last, F.substring(
        F.get(parts, first), (a % PIECE + 1).cast("int"), (b - a).cast("int"))).otherwise(between(first, last))


def replaced(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with ``mark`` for every span; a span that starts inside the one before it joins it."""
    # how far the spans before each one reach: a running maximum, as spans in order of their starts may lie in one another
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"),
                     F.array().cast("array<array<bigint>>").alias("runs"))

    def step(acc: Column, s: Column) -> Column:
        room = F.size(acc["out"]) < RUN
        return F.struct(F.greatest(acc["at"], s["e"]).alias("at"),
                        F.when(room, F.concat(acc["out"], F.array(acc["at"]))).otherwise(F.array(acc["at"])).alias("out"),
                        F.when(room, acc["runs"]).otherwise(F.concat(acc["runs"], F.array(acc["out"]))).alias("runs"))

    reach = F.aggregate(spans, start, step, lambda a: F.struct(F.flatten(F.concat(a["runs"], F.array(a["out"]))).alias("before"), a["at"].alias("end")))
    parts = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))

    def build(p: Column) -> Column:
        return let(reach, lambda r: F.concat(F.array_join(F.zip_with(spans, r["before"], lambda s, at: F.when(
            s["s"] >= at, F.concat(_cut(p, at, s["s"]), F.lit(mark))).otherwise(F.lit(""))), ""),
            _cut(p, r["end"], F.length(text).cast("bigint"))))

    return let(parts, build)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` and ``n_chars`` (if present) brought up to date.

    Texts without a find, null ones too, stay as they are, and so does every other column, whatever its name.
    """
    f = scan(docs)
    found = F.size("spans") > 0
    f = f.withColumn("clean", F.when(found, replaced(F.col("row.text"), F.col("spans"), mark)).otherwise(F.col("row.text")))
    out = {c: F.col("row")[c].alias(c) for c in docs.columns}
    out["text"] = F.col("clean").alias("text")
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(found, F.length("clean").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("row")["n_chars"]).alias("n_chars")
    return f.select(*[out[c] for c in docs.columns])
