"""Filter interaction audit on sorted posting lists (operator 12).

Every filter's failing rows are kept as sorted posting lists, one per part, block of row
numbers and filter; a block spans at most ``BLOCK`` numbers, so no list grows with its part.
Inside a block all unions of filters and their differences are computed by galloping k-way
merges (the shorter list leaps through the longer by batched binary search); the sizes are
then summed over the blocks.  From these sums follows every order in which the filters can
be applied: what a step removes is one difference, what is kept one union.

The lists are a written table, so that a further audit (other parts, other flags) can read them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import words, written
from hearth.llm.skew import join_groups

FILTERS = "ABCDE"
#: Row numbers a block spans; bounds a posting list and the memory of a merge.
BLOCK = 1 << 15
#: Lists that are no filters: all rows of the block, and flags whose losses are counted.
ALL, GOOD, TOXIC = "all", "good", "toxic"

MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
SYMBOLS = r"[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# ---------------------------------------------------------------- sorted lists

def gallop_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Members of sorted ``a`` that sorted ``b`` does not hold; the shorter list leaps through the longer."""
    if not len(a) or not len(b):
        return a
    if len(a) <= len(b):
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        return a[b[at] != a]
    at = np.searchsorted(a, b)
    at = at[at < len(a)] if at[-1] == len(a) else at
    hit = at[a[at] == b[:len(at)]]
    return np.delete(a, hit)


def gallop_union(lists: Sequence[np.ndarray]) -> np.ndarray:
    """Sorted union of sorted lists without repeats: the longest takes in the others, shortest first."""
    lists = sorted((x for x in lists if len(x)), key=len)
    if not lists:
        return np.empty(0, np.int64)
    out = lists[-1]
    for x in lists[:-1]:
        new = gallop_difference(x, out)
        if len(new):
            out = np.insert(out, np.searchsorted(out, new), new)
    return out


def block_sizes(lists: dict[str, np.ndarray], filters: str = FILTERS) -> Iterator[tuple[int, str, int, int, int]]:
    """(set, filter, removed, good, toxic) of one block, where any is above 0.

    ``set`` is a bit mask of filters that went before; ``removed`` counts the rows that ``filter`` fails and
    no filter of the set does.  A set without a following filter (empty string) stands for its union.
    """
    none = np.empty(0, np.int64)
    fails = [lists.get(f, none) for f in filters]
    good, toxic = lists.get(GOOD, none), lists.get(TOXIC, none)
    present = sum(1 << k for k, x in enumerate(fails) if len(x))
    unions: dict[int, np.ndarray] = {}
    for mask in range(1 << len(filters)):
        held = mask & present  # filters without a failing row here change no union
        if held not in unions:
            unions[held] = gallop_union([x for k, x in enumerate(fails) if held >> k & 1])
        union = unions[held]
        if len(union):
            yield mask, "", len(union), 0, 0
        for k, f in enumerate(filters):
            if mask >> k & 1 or not len(fails[k]):
                continue
            lost = gallop_difference(fails[k], union)
            if len(lost):
                yield (mask, f, len(lost), len(lost) - len(gallop_difference(lost, good)),
                       len(lost) - len(gallop_difference(lost, toxic)))


# ---------------------------------------------------------------- posting lists

def failures(docs: DataFrame) -> DataFrame:
    """part, doc_id, text digest and the conditions A to D of every row (null text: empty)."""
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "doc_id", t.alias("t"), words(t).alias("w"))
    n, distinct = F.size("w"), F.size(F.array_distinct("w"))
    chars = F.char_length("t")
    upper = chars - F.char_length(F.translate("t", UPPER, ""))
    return d.select("part", "doc_id", F.sha2("t", 256).alias("digest"),
                    (n < MIN_WORDS).alias("A"), (100 * distinct < MIN_DISTINCT_PERCENT * n).alias("B"),
                    (100 * upper > MAX_UPPER_PERCENT * chars).alias("C"), F.col("t").rlike(SYMBOLS).alias("D"))


def with_copies(rows: DataFrame) -> DataFrame:
    """Adds E: the text is that of a smaller doc_id.  A null doc_id is not smaller than any and has no smaller one."""
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    j = join_groups(rows, written(groups, "audit-digests"), "digest", "copies")
    return j.withColumn("E", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))).drop("digest", "least", "copies")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds good (quality = 1) and toxic (toxic = 1); without a label both are false, of repeated labels any counts."""
    one = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).eqNullSafe(True)).alias(GOOD), F.max((F.col("toxic") == 1).eqNullSafe(True)).alias(TOXIC))
    # rows without an id cannot match; kept out of the exchange, where they would all meet in one task
    j = rows.filter(F.col("doc_id").isNotNull()).join(one.filter(f"{GOOD} or {TOXIC}"), "doc_id", "left")
    no_id = rows.filter(F.col("doc_id").isNull()).withColumns({c: F.lit(False) for c in (GOOD, TOXIC)})
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in (GOOD, TOXIC)}).unionByName(no_id)


def posting_lists(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, block, list, ids): sorted row numbers per part, block and list, written.

    ``rows`` has ``row`` (unique), ``part``, a boolean per filter, ``good`` and ``toxic``.
    Lists without a member are left out; ``all`` names every row of the block.
    """
    names = [*filters, GOOD, TOXIC]
    member = F.array(F.lit(ALL), *[F.when(F.col(c), F.lit(c)) for c in names])
    long = rows.select("part", F.shiftright("row", BLOCK.bit_length() - 1).alias("block"), "row",
                       F.explode(F.array_compact(member)).alias("list"))
    lists = long.groupBy("part", "block", "list").agg(F.sort_array(F.collect_list("row")).alias("ids"))
    return written(lists, "posting-lists")


SIZES = "part string, mask int, filter string, removed long, good long, toxic long"


def list_sizes(lists: DataFrame, filters: str = FILTERS) -> DataFrame:
    """part, mask, filter, removed, good, toxic: sizes of all differences and unions, summed over the blocks."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            parts, names, ids = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            for k, part in enumerate(parts):
                held = {n: np.asarray(x.values) for n, x in zip(names[k].as_py(), ids[k])}
                for row in block_sizes(held, filters):
                    for c, v in zip(cols, (part, *row)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                names=["part", "mask", "filter", "removed", "good", "toxic"])

    blocks = lists.filter(F.col("list") != ALL).groupBy("part", "block").agg(
        F.collect_list(F.struct("list", "ids")).alias("lists"))
    blocks = blocks.select("part", F.col("lists.list").alias("names"), F.col("lists.ids").alias("ids"))
    return blocks.mapInArrow(merge, SIZES).groupBy("part", "mask", "filter").agg(
        *[F.sum(c).alias(c) for c in ("removed", "good", "toxic")])


# ---------------------------------------------------------------- orders

def _orders(filters: str) -> Column:
    """Constant array of all (order, step, filter, mask before it)."""
    rows = []
    for order in permutations(filters):
        mask = 0
        for step, f in enumerate(order, 1):
            rows.append(("".join(order), step, f, mask))
            mask |= 1 << filters.index(f)
    text = ", ".join(f"struct('{o}' AS filter_order, {s} AS step, '{f}' AS filter, {m} AS mask)" for o, s, f, m in rows)
    return F.expr(f"array({text})")


def audit(lists: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of the step (zeros included)."""
    n = len(filters)
    # one row a part: at most 2^n * (n + 1) sums, found by set and filter
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("removed", "good", "toxic")])
    totals = lists.filter(F.col("list") == ALL).groupBy("part").agg(F.sum(F.size("ids").cast("long")).alias("rows"))
    sizes = list_sizes(lists, filters).groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("|", "mask", "filter").alias("k"), F.struct("removed", "good", "toxic").alias("v")))).alias("sums"))
    per_part = totals.join(sizes, "part", "left")

    def sums(mask: Column, f: Column) -> Column:
        return F.coalesce(F.try_element_at("sums", F.concat_ws("|", mask, f)), zero)

    out = per_part.withColumn("o", F.explode(_orders(filters))).select("part", "rows", "sums", "o.*")
    bit = F.element_at(F.create_map(*[x for k, f in enumerate(filters) for x in (F.lit(f), F.lit(1 << k))]), F.col("filter"))
    out = out.withColumn("bit", bit).withColumn("s", sums(F.col("mask"), F.col("filter")))
    all_fails = sums(F.lit(0), F.col("filter"))["removed"]
    # of all orders, |S|! (n - 1 - |S|)! put exactly the set S before a filter
    fact = [1]
    for k in range(1, n + 1):
        fact.append(fact[-1] * k)
    shapley = sum(
        (F.when(F.col("bit").bitwiseAND(F.lit(m)) == 0,
                sums(F.lit(m), F.col("filter"))["removed"] * (fact[bin(m).count("1")] * fact[n - 1 - bin(m).count("1")])).otherwise(F.lit(0))
         for m in range(1 << n)), F.lit(0).cast("long"))
    return out.select(
        "part", "filter_order", "step",
        (F.col("rows") - sums(F.col("mask").bitwiseOR(F.col("bit")), F.lit(""))["removed"]).alias("kept"),
        F.col("s.removed").alias("removed"), (all_fails - F.col("s.removed")).alias("redundant"),
        sums(F.lit((1 << n) - 1) - F.col("bit"), F.col("filter"))["removed"].alias("unique_fails"),
        F.col("s.good").alias("good_lost"), F.col("s.toxic").alias("toxic_lost"), shapley.cast("long").alias("shapley"))


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Written rows (row, part, doc_id, A to E, good, toxic) of every document; ``row`` is unique."""
    rows = with_labels(with_copies(written(failures(docs), "audit-fails")), labels)
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "audit-rows")


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``, per source.

    Null texts are empty texts, a null source is the empty string; every row counts, repeated
    rows and rows without doc_id too (the latter never fail E and have no labels).  Sources of an
    empty table: none, so no rows.  Columns of other names are not read.
    """
    return audit(posting_lists(flagged(docs.select("doc_id", "source", "text"), labels.select("doc_id", "quality", "toxic"))))
